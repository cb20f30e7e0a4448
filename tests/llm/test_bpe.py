"""Forced-cut BPE against the tokenizers library on whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read())


def check(codec, library, texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    ids, at = codec.encode(np.frombuffer(b"".join(raw), np.uint8) if any(raw) else np.zeros(0, np.uint8), offsets)
    data, ends = codec.decode(ids, at)
    for i, t in enumerate(texts):
        expected = library.encode(t, add_special_tokens=False).ids
        assert ids[at[i] : at[i + 1]].tolist() == expected, repr(t)
        assert data[ends[i] : ends[i + 1]].decode() == library.decode(expected, skip_special_tokens=False) == t


PIECES = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "the", "The", "'", "'s", "'ll", "don't", "''s", "\"'s", ".", "...", "!!", "###", "%%%",
    "1", "2024", "é", "É", "ß", "ñ", " ", " ", "　", "\u0085", " ", "漢字", "🙂", "é", "<|endoftext|>", "<|", "|>",
    "endoftext", "-", "_", "=", "\x00", "\x1c", "\x7f", "x'", "¿", "«", "Ā", "and ", " of", ",",
]


def test_texts_of_awkward_pieces(codec, library):
    r = random.Random(1)
    check(codec, library, ["".join(r.choices(PIECES, k=r.randint(0, 12))) for _ in range(20_000)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"])), max_size=4))
def test_any_text(codec, library, texts):
    check(codec, library, texts)


def test_long_text_and_long_fragment(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "_SLICE", 7)
    check(codec, library, ["the thin end of it " * 500, "", "a" * 5000, " " * 3000 + "x", "\n" * 999])


def test_forgetting_changes_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 600)
    monkeypatch.setattr(bpe, "_SLICE", 5)
    check(codec, library, ["one two three four five six seven", "one two", "", "seven six five"])


SCRIPTS = {
    "English": ("The quick brown fox reads a plain text every day, and then it sleeps. ", 8),
    "Russian": ("Это простой текст на русском языке, который мы читаем каждый день. ", 8),
    "Chinese": ("这是一个简单的中文文本，我们每天都在阅读它。它由许多汉字组成，没有空格。", 4),
    "Japanese": ("これは日本語の簡単な文章です。毎日読んでいます。漢字とひらがなとカタカナ。", 4),
    "Arabic": ("هذا نص بسيط باللغة العربية نقرأه كل يوم. يتكون من كلمات كثيرة. ", 8),
    "Hindi": ("यह हिंदी में एक सरल पाठ है जिसे हम हर दिन पढ़ते हैं। ", 8),
}


@pytest.mark.parametrize("name", SCRIPTS)
def test_texts_of_all_scripts_are_cut(codec, library, name):
    """At least once in so many characters, and the ids are the library's."""
    text, characters = SCRIPTS[name]
    text *= 30
    check(codec, library, [text, text[1:]])
    raw = text.encode()
    assert len(codec.cuts(np.frombuffer(raw, np.uint8), raw)) >= len(text) / characters


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aé日本語русскийعربيह\u0300\u200d'stlv \u00a0\u3000\u2003\u0085\n。、!1२", max_size=30), max_size=4))
def test_mixed_scripts(codec, library, texts):
    check(codec, library, texts)


def test_memory_is_bounded_in_bytes(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 100_000)
    monkeypatch.setattr(codec, "known", {})
    monkeypatch.setattr(codec, "known_bytes", 0)
    r = random.Random(3)
    for _ in range(20):
        check(codec, library, [" ".join("".join(r.choices("abcdefghij", k=r.randint(3, 90))) for _ in range(300))])
        held = sum(bpe._ENTRY + len(k) + len(v) for k, v in codec.known.items())
        assert held == codec.known_bytes <= 100_000
        assert max(map(len, codec.known), default=0) <= bpe.KEPT_LENGTH


def test_added_tokens_that_strip_are_refused():
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError, match="white space"):
        bpe.Codec(json.dumps(spec))


def test_frames(spark, library):
    texts = [None, "", "A <|endoftext|> b", "é" * 40, "same", "same"]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string")
    df = df.repartition(3)
    out = bpe.bpe_round_trip(df, PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for row in out.collect():
        text = texts[row.doc_id] or ""
        assert row.text == texts[row.doc_id] and row.decoded == text
        assert row.ids == library.encode(text, add_special_tokens=False).ids
    parts = bpe.bpe_decode(bpe.bpe_encode(df, PATH).withColumn("ids", F.col("ids")), PATH)
    assert {tuple(map(str, r)) for r in parts.collect()} == {tuple(map(str, r)) for r in out.select(parts.columns).collect()}
    assert bpe.bpe_round_trip(df.limit(0), PATH).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [-1, 99_999_999, None, 64]), (4, [11976])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.bpe_decode(odd, PATH).orderBy("doc_id").collect()][:3] == ["", "", "a"]


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.Codec(f.read())


def test_query(spark, sf, library):
    import hashlib

    from tagloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op6_bpe"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
