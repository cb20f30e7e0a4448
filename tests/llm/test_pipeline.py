"""The pipeline, stage by stage and whole, against plain versions of its stages."""

import collections

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tagloom.llm import mixing as mx
from tests.llm.test_jaccard_join import brute
from tests.llm.test_native import deduped, targets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The rows after each stage, the documents first."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(9001, None, "en", "src0", 0), (9002, "", "de", None, 0), (9003, "12 34 !", None, "src1", 7),
             (9004, "The and of them.", None, None, 16), (9005, "The and of them.", "en", "src1", 16)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(cp.settled(stage(spark, out[-1], sf)))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_columns_and_names(stages):
    assert [len(cp.STAGES), cp.STAGES[0][0]] == [5, "language ID"]
    assert all(df.columns == COLUMNS for df in stages[:-1])
    assert stages[-1].columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"]


def test_language_stage(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages[:2])
    gone = set(before) - set(after)
    assert {9001, 9002, 9003} <= gone and len(gone) < 0.02 * len(before) and 9004 in after
    for key, r in after.items():
        assert (r.text, r.source) == (before[key].text, before[key].source)
        assert r.lang == (before[key].lang or "en")


def test_line_stage(stages):
    assert sorted(rows(stages[2]), key=repr) == sorted(((k, t) for k, t, _, _ in deduped(rows(stages[1]))), key=repr)
    assert stages[2].where(F.col("n_chars") != F.length("text")).count() == 0


def test_near_copy_stage(stages):
    kept = {k: t for k, t in rows(stages[3])}
    assert sorted(kept) == sorted(k for k, name, _, _ in brute(rows(stages[2])) if k == name)
    assert kept.items() <= dict(rows(stages[2])).items() and stages[3].count() == len(kept)


def test_mix_stage(stages):
    before = stages[3].select("doc_id", "source", "text").collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in before:
        sizes[r.source] += len(r.text.split())
    largest = max(len(r.text.split()) for r in before)
    copies = collections.Counter(r.doc_id for r in stages[4].select("doc_id").collect())
    for r in stages[4].select("source", "text").collect():
        taken[r.source] += len(r.text.split())
    assert max(copies.values()) <= mx.MAX_REPEATS and set(copies) <= {r.doc_id for r in before}
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= largest
    assert set(stages[4].select("doc_id", "text").collect()) <= set(stages[3].select("doc_id", "text").collect())


def test_token_stage(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    coded = stages[5].collect()
    assert len(coded) == stages[4].count()
    for r in coded:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_whole_run_and_rerun(spark, sf):
    first = sorted(map(repr, cp.run(spark, sf).drop("ids").collect()))
    assert first and first == sorted(map(repr, cp.run(spark, sf).drop("ids").collect()))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_entry_lists_it(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names}
