"""The corpus pipeline: language, shared lines, near copies, source mix, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe import bpe_encode
from tagloom.llm.common import settled, table, unused
from tagloom.llm.jaccard_join import drop_near_copies
from tagloom.llm.language import UNKNOWN, fit_language_model, predict_language
from tagloom.llm.line_dedup import line_dedup
from tagloom.llm.mixing import mix_sources

#: A document goes if no language has at least this chance. Clean texts, also of a few words, are far above it.
LEAST_SCORE = 0.4
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach. A null label becomes the predicted language."""
    language, score = unused(docs, "_language"), unused(docs, "_score")
    found = predict_language(docs, fit_language_model(docs), out_column=language, score_column=score)
    kept = found.where((F.col(language) != UNKNOWN) & (F.col(score) >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", language)).select(docs.columns)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others share."""
    return line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_sources(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every row, without the text."""
    coded = bpe_encode(docs, VOCABULARY)
    return coded.withColumn("n_tokens", F.size("ids").cast("long")).select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids")


STAGES = [
    ("language ID", language),
    ("line dedup", shared_lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", source_mix),
    ("BPE encoding", token_ids),
]

#: SQL has neither the network, nor the rounding, nor the tokenizer; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs
