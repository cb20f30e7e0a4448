"""Fingerprints against brute force on characters."""

import hashlib
import random

import numpy as np
import pytest

from tagloom.llm import fingerprints as fp
from tagloom.llm.queries import QUERIES


def test_spans_and_extensions():
    r = random.Random(3)
    for _ in range(300):
        a = "".join(r.choices("ab🙂é", k=r.randint(0, 40)))
        b = a[: r.randint(0, len(a))] + "".join(r.choices("ab🙂é", k=r.randint(0, 40)))
        x, y = (fp.hashed(fp.code_points(t)) for t in (a, b))
        i, j = r.randint(0, len(a)), r.randint(0, len(b))
        for n in range(min(len(a) - i, len(b) - j) + 1):
            assert fp.spans_equal(x, i, y, j, n) == (a[i : i + n] == b[j : j + n])
        common = next((k for k, (p, q) in enumerate(zip(a[i:], b[j:])) if p != q), min(len(a) - i, len(b) - j))
        assert fp.common_extension(x, i, y, j) == common
        w = x[0].windows(3).tolist()
        assert all((w[p] == w[q]) == (a[p : p + 3] == a[q : q + 3]) for p in range(len(w)) for q in range(len(w)))


def test_extensions_do_not_rest_on_one_hash():
    """Two texts whose hashes agree for the first base alone: the second tells them apart."""
    x, y = (fp.hashed(np.array(p, np.uint32)) for p in ([fp.BASES[0] + 5, 7], [5, 8]))
    assert x[0].hashes[2] == y[0].hashes[2] and x[1].hashes[2] != y[1].hashes[2]
    assert not fp.spans_equal(x, 0, y, 0, 2) and fp.common_extension(x, 0, y, 0) == 0


def test_pieces_do_not_matter(monkeypatch):
    text = "".join(random.Random(7).choices("abc é漢🙂", k=5000))
    whole = fp.Text(text)
    monkeypatch.setattr(fp, "_PIECE", 64)
    monkeypatch.setattr(fp, "POWERS", [fp.Powers(b) for b in fp.BASES])
    monkeypatch.setattr(fp, "INVERSES", [fp.Powers(pow(b, -1, fp.PRIME)) for b in fp.BASES])
    again = fp.Text(text)
    assert all((a.hashes == b.hashes).all() for a, b in zip(whole.prefix, again.prefix)) and str(whole.fingerprint) == str(again.fingerprint)


def test_memory_of_long_texts():
    """As the docstring says: some 20 bytes for each code point, and the powers."""
    import tracemalloc

    n = 2_000_000
    text = "abcdefgh" * (n // 8)
    tracemalloc.start()
    one = fp.Text(text)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(one.points) == n and held < 45 * n and peak < 60 * n


def test_seam_equals_hashing_the_whole():
    r = random.Random(4)
    for _ in range(300):
        a, b = ("".join(r.choices("abcdef ", k=r.choice([0, 1, 5, 23, 24, 25, 60, 300]))) for _ in range(2))
        keep, take = r.randint(0, len(a)), r.randint(0, len(b))
        assert str(fp.Text(a).followed_by(keep, fp.Text(b), take)) == str(fp.Text(a[:keep] + b[:take]).fingerprint)


def test_smallest_and_likeness():
    r = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 600, 5000):
        h = r.integers(0, fp.PRIME, n)
        assert fp._smallest(h, 64).tolist() == sorted(set(h.tolist()))[:64]
    base = "".join(random.Random(6).choices("abcdefgh ", k=20_000))
    half = fp.Text(base[:10_000] + base[:10_000][::-1]).fingerprint
    assert 0.15 < fp.Text(base).fingerprint.likeness(half) < 0.55  # a third of all windows are common
    assert fp.Text(base).fingerprint.likeness(fp.Text(base).fingerprint) == 1.0
    assert fp.Text(base).fingerprint.likeness(fp.Text(base[::-1]).fingerprint) < 0.1
    assert fp.Text("").fingerprint.likeness(fp.Text("a").fingerprint) == 0.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = {}
    for (key, text), (_, after) in zip(rows, [*rows[1:], rows[0]] if rows else []):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = (fp.Text(t).fingerprint for t in (text, edited, after))
        prefix = next((i for i, (p, q) in enumerate(zip(text, edited)) if p != q), min(len(text), len(edited)))
        out[key] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), str(own), str(other), own.likeness(other), own.likeness(following), prefix,
        )
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_chain(spark, parts):
    r = random.Random(7)
    rows = [(i * 3, "".join(r.choices("abcd é🙂\n", k=r.choice([0, 1, 2, 30, 200])))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, "x" * 30_000), (203, "x" * 30_000), (None, "the end")]
    r.shuffle(rows)
    df = spark.createDataFrame([(k, t, "_", 1) for k, t in rows], "doc_id long, text string, _id string, fingerprint int").repartition(parts)
    got = {row[0]: tuple(row)[1:] for row in fp.fingerprint_chain(df).collect()}
    assert got == brute(rows)


def test_ties_and_empty_table(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other"), (None, "same")], "doc_id long, text string")
    out = fp.fingerprint_chain(df).collect()
    assert len(out) == 4 and len({r.fingerprint for r in out}) == 2
    assert fp.fingerprint_chain(df.limit(0)).collect() == []
    alone = fp.fingerprint_chain(df.limit(1)).collect()[0]
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"sasa").hexdigest()


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_fingerprints"](spark, sf).collect()} == brute(rows)
