"""Near vectors, product codes and hard negatives against brute force, and the edge cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import hard_negatives as hn
from tagloom.llm import near_vectors as nv
from tagloom.llm import vector_codes as vc
from tagloom.llm import vectors as vs

SCHEMA = "vec_id long, embedding array<float>, label int, _id string, _key int, code long"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], SCHEMA).repartition(parts)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v)


def doubles(v):
    return np.array([np.float32(x) for x in v], np.float64)


def clustered(seed, count, length=24, labels=4):
    """Vectors with near copies at all distances, exact copies, scaled copies, and rows that no operator can use."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, length))
    rows = []
    for i in range(count):
        v = centres[r.integers(6)] + r.normal(size=length) * r.choice([0.05, 0.2, 0.3, 0.5, 1.0])
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(r.integers(labels))))
    hot = rows[0][1]
    rows += [(count + i, hot, 1) for i in range(40)] + [(count + 50 + i, [2 * x for x in hot], 1) for i in range(3)]
    bad = [None, [], [0.0] * length, [None, *hot[1:]], [float("nan"), *hot[1:]], [float("inf"), *hot[1:]], [1.0, 2.0], [1.0, 2.0], [-0.0, 1.0], [0.0, 1.0]]
    rows += [(2000 + i, v, 1) for i, v in enumerate(bad)] + [(3000, hot, None), (3001, hot, None), (None, hot, 1), (None, None, None)]
    return [*rows, rows[5], rows[5], (rows[7][0], rows[8][1], rows[8][2])]


# Near vectors


def linked_by_all_pairs(rows, threshold):
    unit = []
    for _, v, label in rows:
        good = usable(v) and label is not None and np.any(doubles(v))
        unit.append(doubles(v) / np.sqrt(doubles(v) @ doubles(v)) if good else None)
    links = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
                continue
            if (rows[i][1] == rows[j][1]) or a @ b >= threshold:
                links[i].add(j)
                links[j].add(i)
    out, component = [], {}
    for i in range(len(rows)):
        if i in component:
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        component.update(dict.fromkeys(seen, least))
    for i, (key, _, _) in enumerate(rows):
        out.append((key, len(links[i]), component[i], key is not None and key == component[i]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("threshold", [0.93, 0.5])
def test_near_vectors_equal_all_pairs(spark, monkeypatch, threshold):
    monkeypatch.setattr(nv, "BLOCK_BYTES", 3000)  # many tiles of a cell
    monkeypatch.setattr(nv, "SQUARE", 7)
    rows = clustered(1, 260)
    out = nv.near_vectors(frame(spark, rows), threshold=threshold)
    assert out.columns == ["vec_id", "label", "n_links", "component_id", "kept"]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=repr)
    want = linked_by_all_pairs(rows, threshold)
    assert got == want and max(w[1] for w in want) > 40 and len({w[2] for w in want}) > 20


def test_few_axes_give_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(nv, "AXES", 5)
    rows = clustered(2, 80)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in nv.near_vectors(frame(spark, rows)).collect()), key=repr)
    assert got == linked_by_all_pairs(rows, 0.93)


def test_near_vectors_of_nothing(spark):
    df = frame(spark, [(1, [1.0, 0.0], 1)])
    assert nv.near_vectors(df.limit(0)).collect() == []
    assert [tuple(r) for r in nv.near_vectors(df).collect()] == [(1, 1, 0, 1, True)]
    nothing = frame(spark, [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0], None)])
    assert sorted(tuple(r)[2:] for r in nv.near_vectors(nothing).collect()) == [(0, 1, True), (0, 2, True), (0, 3, True)]


def test_bounds_lose_no_pair():
    r = np.random.default_rng(3)
    for length in (1, 5, 8, 9, 40):
        a, b = (r.normal(size=(n, length)) * (0.6 ** np.arange(length)) for n in (60, 45))
        a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
        rest = lambda x: np.sqrt(np.concatenate([np.cumsum((x * x)[:, ::-1], 1)[:, ::-1], np.zeros((len(x), 1))], 1))
        for threshold in (0.3, 0.93, 0.999):
            i, j = nv.linked(a, rest(a), b, rest(b), threshold)
            assert set(zip(i.tolist(), j.tolist())) == {tuple(p) for p in np.argwhere(a @ b.T >= threshold).tolist()}


def test_linked_vectors_are_in_neighbouring_cells(spark):
    rows = [(i, v, 1) for i, v, _ in clustered(4, 200) if usable(v) and i is not None and len(v) > 2 and np.any(v)]
    made = nv.near_vectors(frame(spark, rows), threshold=0.8)
    assert sorted(((r.vec_id, r.n_links) for r in made.collect())) == sorted((k, n) for k, n, _, _ in linked_by_all_pairs(rows, 0.8))


def test_a_forest_joins_what_links_join():
    r = np.random.default_rng(5)
    for _ in range(50):
        n = 30
        forest, root = nv._Forest(n), list(range(n))
        for _ in range(3):
            i, j = r.integers(0, n, 12), r.integers(0, n, 12)
            forest.add(i, j)
            for a, b in zip(i, j):
                x, y = root[a], root[b]
                root = [x if k == y else k for k in root]
        for a in range(n):
            for b in range(n):
                assert (forest.find(a) == forest.find(b)) == (root[a] == root[b])
        assert len(forest.links) == n - len(set(root))


# Product codes


@pytest.mark.parametrize("most", [3, 300, 1 << 23])
def test_orchard_search_equals_looking_at_all(most):
    r = np.random.default_rng(6)
    for count, width in ((1, 3), (2, 1), (40, 4), (256, 16)):
        entries = r.integers(-most, most + 1, (count, width))
        entries[count // 2] = entries[0]  # equal entries: the lower index counts
        vectors = np.concatenate([r.integers(-most, most + 1, (300, width)), entries, entries + 1])
        search = vc.Orchard(entries)
        chosen, apart = search.nearest(vectors)
        all_ = ((vectors[:, None, :] - entries[None]) ** 2).sum(2)
        assert chosen.tolist() == all_.argmin(1).tolist() and apart.tolist() == all_.min(1).tolist()


def test_orchard_search_stops_early():
    """In close groups most entries are never looked at."""
    r = np.random.default_rng(7)
    centres = r.integers(-100_000, 100_000, (256, 16))
    search = vc.Orchard(centres)
    vectors = centres[r.integers(0, 256, 2000)] + r.integers(-50, 51, (2000, 16))
    chosen, _ = search.nearest(vectors)
    assert (np.abs(centres[chosen] - vectors).max(1) <= 50).all() and search.looked_at < 0.5 * 256 * 2000


def coded(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, label, [int(np.floor(x * scale)) for x in doubles(v)]) for i, v, label in rows if usable(v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], np.int32).tobytes()))
    length = len(order[0][2]) if order else 0
    kept = [r for r in kept if len(r[2]) == length]
    order = [r for r in order if len(r[2]) == length]
    bounds = vc.part_bounds(length, parts)
    books = [[r[2][a:b] for r in order[:entries]] for a, b in bounds]

    def nearest(p, r):
        a, b = bounds[p]
        return min((sum((x - y) ** 2 for x, y in zip(r[2][a:b], e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p, (a, b) in enumerate(bounds):
            mine = {}
            for r in kept:
                mine.setdefault(nearest(p, r)[1], []).append(r[2][a:b])
            for n, members in mine.items():
                new[p][n] = [sum(c) // len(members) for c in zip(*members)]
        books = new
    out = []
    for r in kept:
        found = [nearest(p, r) for p in range(parts)]
        out.append((r[0], r[1], "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found)))
    total = {}
    for _, label, _, error in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((*o, total[o[1]]) for o in out), key=repr), digest


@pytest.mark.parametrize("entries,length", [(16, 24), (256, 10)])
def test_codes_equal_brute_force(spark, entries, length):
    rows = clustered(8, 150, length)
    out, books = vc.compress_vectors(frame(spark, rows), entries=entries)
    want, digest = coded(rows, entries=entries)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want and vc.codebooks_digest(books) == digest


def test_codes_of_nothing_and_of_little(spark):
    df = frame(spark, [(3, [0.5, -0.25, 1.0], None), (4, None, 1), (5, [1.0], 1)])
    out, books = vc.compress_vectors(df.limit(0))
    assert out.collect() == [] and [len(b) for b in books] == [0] * 4
    out, books = vc.compress_vectors(df)
    assert [tuple(r) for r in out.collect()] == [(3, None, "00000000", 0, 0)] and [b.shape for b in books] == [(1, 1), (1, 1), (1, 1), (1, 0)]
    huge = frame(spark, [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1)])
    out, books = vc.compress_vectors(huge)
    assert {r.code for r in out.collect()} == {"00000000", "01010101"} and int(books[0][0][0]) == vc.LIMIT


# Hard negatives


def mined(rows, every=5, positives=5, negatives=3, scale=256):
    one = {}
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            x = np.floor(doubles(v) * scale).astype(np.int64)
            row = (str(label), len(x), x.astype(np.int32).tobytes(), x)
            if i not in one or row[:3] < one[i][:3]:
                one[i] = row
    out = []
    for a, (label, length, _, x) in one.items():
        if a % every:
            continue
        scores = sorted((-int(x @ y), i, other) for i, (other, n, _, y) in one.items() if n == length and i != a)
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            p = -p
            fit = [(i2, -n) for n, i2, other in scores if other != label and 50 * p <= -100 * n <= 95 * p]
            out += [(a, i, rank, i2, p, n) for rank, (i2, n) in enumerate(fit[:negatives], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,cluster", [(1 << 20, 512), (2000, 7)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, cluster):
    monkeypatch.setattr(hn, "BLOCK_BYTES", block)
    monkeypatch.setattr(hn, "CLUSTER", cluster)
    monkeypatch.setattr(hn, "STEP", 16)
    rows = clustered(9, 400)
    out = hn.mine_hard_negatives(frame(spark, rows), lambda i: i % 5 == 0)
    want = mined(rows)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in out.collect()) == want and len(want) > 500
    assert dict(out.dtypes)["rank"] == "int"


def test_negatives_of_nothing(spark):
    df = frame(spark, [(5, [1.0, 0.0], 1), (6, [0.9, 0.0], 1), (7, [0.7, 0.0], 2)])
    assert hn.mine_hard_negatives(df.limit(0), lambda i: i % 5 == 0).collect() == []
    assert hn.mine_hard_negatives(df, lambda i: i < 0).collect() == []
    assert hn.mine_hard_negatives(df.where("label = 1"), lambda i: i % 5 == 0).collect() == []
    got = hn.mine_hard_negatives(df, lambda i: i % 5 == 0).collect()
    assert [tuple(r) for r in got] == [(5, 6, 1, 7, 256 * 230, 256 * 179)]


def test_a_walk_stops_when_nothing_better_can_come():
    """Candidates far from the cluster are never scored, and the result is that of scoring all."""
    r = np.random.default_rng(10)
    axis = np.zeros(16)
    axis[0] = 1
    near, far = (np.floor(256 * x).astype(np.int32) for x in (axis + r.normal(size=(200, 16)) * 0.1, -axis + r.normal(size=(5000, 16)) * 0.1))
    rows, members = np.concatenate([far, near]), near[:20]
    ids, labels = np.arange(len(rows)), np.array(["a", "b"] * (len(rows) // 2), object)
    member_ids, member_labels = ids[5000:5020], labels[5000:5020]
    slots = hn._slots([[(None, None)]] * 20)
    slot, found, score, need, scored = hn.walk(members, member_ids, member_labels, hn._centre(members), slots, rows, ids, labels, True, 5)
    assert scored < 0.2 * 20 * len(rows)
    products = members.astype(np.int64) @ rows.T
    for m in range(20):
        best = sorted((-products[m, i], i) for i in range(len(rows)) if labels[i] == member_labels[m] and i != member_ids[m])[:5]
        assert [(-s, i) for s, i in zip(score[slot == m], found[slot == m])] == best and need[m] == -best[-1][0]


# Columns of vectors


def test_vectors_by_length():
    import pyarrow as pa

    column = pa.array([[9.0], [1.0, None], None, [], [1.0, 2.0], [3.0, float("inf")], [5.0, 6.0]], pa.list_(pa.float32()))
    for shift in (0, 1):  # a slice has an offset
        got = {m.shape[1]: (at.tolist(), m.tolist()) for at, m in vs.vectors_by_length(column.slice(shift))}
        assert got[2] == ([4 - shift, 6 - shift], [[1.0, 2.0], [5.0, 6.0]]) and (1 in got) == (shift == 0)
    assert list(vs.vectors_by_length(pa.array([None, []], pa.list_(pa.float32())))) == []
    matrix = np.arange(12, dtype=np.int32).reshape(3, 4)
    assert (vs.matrix_rows(vs.binary_rows(matrix), np.int32, 4) == matrix).all()


def test_blocks_are_dealt_evenly(spark):
    rows = spark.range(20_000).select(F.col("id").alias("_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("_cell"))
    sizes = vs.dealt(rows, ["_cell"], F.col("_id"), F.lit(500)).groupBy("_cell", "_part").count().collect()
    assert sum(r["count"] for r in sizes) == 20_000 and max(r["count"] for r in sizes) < 650
