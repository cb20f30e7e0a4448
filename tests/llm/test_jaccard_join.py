"""The similarity join, its shingles and components against brute force."""

import random
import re

import numpy as np
import pytest

from tagloom.llm import jaccard_join as jj
from tagloom.llm import shingles
from tagloom.llm.components import components
from tagloom.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, n=5):
    w = words_of(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def roots(count, edges):
    up = list(range(count))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(count)]


def brute(rows, similarity=0.8):
    """Rows of (id, text) in id order to (id, class, class size, links)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [shingle_set(t) for _, t in rows]
    holders, edges = {}, set()
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in holders.setdefault(x, []):
                near[j] = near.get(j, 0) + 1
            holders[x].append(i)
        edges |= {(j, i) for j, c in near.items() if c >= similarity * (len(s) + len(sets[j]) - c) - 1e-9}
    empty = [i for i, s in enumerate(sets) if not s]
    edges |= {(a, b) for a in empty for b in empty if a < b}
    root = roots(len(rows), edges)
    links = [sum(i in e for e in edges) for i in range(len(rows))]
    return sorted(((rows[i][0], rows[root[i]][0], root.count(root[i]), links[i]) for i in range(len(rows))), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, groups=12, singles=40):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghijk", k=r.randint(1, 7))) for _ in range(400)]
    passage = r.choices(vocabulary, k=20)
    texts = [" ".join(r.choices(vocabulary, k=r.randint(0, 120)) + (passage if r.random() < 0.5 else [])) for _ in range(singles)]
    for _ in range(groups):
        base = r.choices(vocabulary, k=r.choice([3, 5, 6, 10, 60, 200]))
        for _ in range(r.randint(2, 8)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(r.choice([" ", "\n", "  "]).join(copy))
    r.shuffle(texts)
    return texts


def test_shingles_are_those_of_the_words():
    r = random.Random(2)
    for _ in range(200):
        texts = ["".join(r.choices("ab \n\té ", k=r.randint(0, 40))) for _ in range(5)]
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8) if any(raw) else np.zeros(0, np.uint8)
        sets, ends = shingles.shingle_sets(data, np.cumsum([0, *map(len, raw)]))
        hashed, real = [set(sets[a:b].tolist()) for a, b in zip(ends, ends[1:])], [shingle_set(t) for t in texts]
        for i in range(5):
            for j in range(5):
                assert len(hashed[i] & hashed[j]) == len(real[i] & real[j])


def test_common_counts(monkeypatch):
    r = random.Random(3)
    for n in (1, 2, 3, 40):
        lists = [r.sample(range(60), r.randint(0, 50)) for _ in range(n)]
        counts = jj.common_counts(np.array([x for s in lists for x in s], np.int64), np.cumsum([0, *map(len, lists)]))
        assert [[int(c) for c in row] for row in counts] == [[len(set(a) & set(b)) for b in lists] for a in lists]


@pytest.mark.parametrize("small", [False, True])
def test_join_equals_brute_force(spark, monkeypatch, small):
    if small:  # buckets are split by further tokens, and compared in many blocks
        monkeypatch.setattr(jj, "BUCKET", 6)
        monkeypatch.setattr(jj, "BLOCK_SETS", 3)
    rows = list(enumerate(corpus(5)))
    rows += [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (903, "one two"), (904, "one  two"), (905, "two one")]
    rows += [(906, rows[3][1])] * 30
    df = spark.createDataFrame([(k, t, "_", b"x") for k, t in rows], "doc_id long, text string, _id string, _key binary").repartition(4)
    assert got(jj.jaccard_classes(df, recall=0.9999)) == brute(rows)


def test_links_count_once_where_blocks_are_empty(spark, monkeypatch):
    """A few sets over as many blocks, as very long near copies have."""
    monkeypatch.setattr(jj, "BLOCK_TOKENS", 1)
    rows = list(enumerate(corpus(6, groups=20, singles=5)))
    assert got(jj.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)


def test_pairs_at_exactly_the_least_similarity(spark):
    """Sets of 9 k shingles of which 8 k are common, in a group that is compared as a matrix."""
    assert jj._near(np.array([[0, 800], [800, 0]]), np.array([900, 900]), 0.8)[0, 1]
    for c in [1, 2, 3, 7, 60, 333, 1000]:
        near = jj._near(jj.common_counts(np.tile(np.arange(8 * c), 3), np.arange(4) * 8 * c), np.full(3, 9 * c), 0.8)
        assert near.all()
        assert not jj._near(np.array([[8 * c - 1]]), np.array([9 * c]), 0.8).any()


def test_recall_in_buckets_split_to_the_last_level():
    """Pairs at exactly the least similarity that no run samples on all levels."""
    pairs, r = 40_000, np.random.default_rng(7)
    both, one = r.integers(1, 2**63, (pairs, 80), dtype=np.uint64), r.integers(1, 2**63, (2, pairs, 10), dtype=np.uint64)
    runs, names = jj.runs_for(jj.RECALL), []
    for x in one:
        picks, lengths = jj._sampled(np.hstack([both, x]).ravel(), np.arange(pairs + 1) * 90, jj.SIMILARITY, runs)
        place = np.repeat(np.arange(len(lengths)), lengths)  # pair, run and level
        names.append(place * 2**32 + picks.view(np.uint32))
    shared = np.zeros(pairs * runs * jj.LEVELS, bool)
    shared[np.intersect1d(*names) >> 32] = True
    found = shared.reshape(pairs, runs, jj.LEVELS).all(2).any(1)
    assert (~found).sum() <= 2 * (1 - jj.RECALL) * pairs


def test_recall_in_large_classes(spark, monkeypatch):
    """Some thousand different near copies, in buckets that are split up to the last level."""
    monkeypatch.setattr(jj, "BUCKET", 30)
    r, texts = random.Random(4), []
    for group in range(20):
        base = [f"w{group}x{i}" for i in range(96)]
        for i in range(150):
            copy = list(base)
            copy[r.randrange(96)] = f"other{group}x{i}"
            texts.append(" ".join(copy))
    links = 0
    for group in range(20):
        sets = [shingle_set(t) for t in texts[group * 150 : group * 150 + 150]]
        names = {x: i for i, x in enumerate(set().union(*sets))}
        has = np.zeros((150, len(names)))
        for i, s in enumerate(sets):
            has[i, [names[x] for x in s]] = 1
        common, size = has @ has.T, has.sum(1)
        links += (common / (size[:, None] + size[None, :] - common) >= 0.8 - 1e-9).sum() - 150
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    found = sum(row.n_links for row in jj.jaccard_classes(df).select("n_links").collect())
    assert links > 400_000 and links * 0.9995 <= found <= links


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert got(jj.jaccard_classes(df)) == [(1, 1, 1, 0)]
    assert got(jj.jaccard_classes(df.limit(0))) == []


def test_components(spark):
    r = random.Random(8)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(400, i) for i in range(401, 440)]
    found = dict(got(components(spark.createDataFrame(edges, "a long, b long"), "a", "b")))
    root = roots(500, edges)
    assert found == {x: root[x] for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long"), "a", "b").collect() == []


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op5_jaccard_join"](spark, sf)) == brute(rows)
