"""Hard negatives of anchors: shared candidate lists for clusters of anchors, walked as far as an angular bound demands."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, settled, uniform
from tagloom.llm.vectors import BLOCK_BYTES, dealt, exact, matrix_rows, whole_vectors

POSITIVES, NEGATIVES = 5, 3
#: A negative has at least and at most so many hundredths of the positive's score.
BAND = (50, 95)
SCALE = 256
#: Whole numbers stay below this, that is components below 4,096: then products of up to 4,096 components are exact doubles.
LIMIT = 1 << 20
#: Anchors of a cluster, at most about, and candidates of a list that are scored at once.
CLUSTER, STEP = 512, 256
#: The centres of cells are fitted on about so many anchors; they decide where rows are looked for first, never what is found.
SAMPLE, MOST_CELLS, PASSES = 4096, 256, 6


def _angles(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of vectors and their angles to a centre of length 1; a zero vector has angle 0."""
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    cosine = np.divide(vectors @ centre, norms, out=np.ones(len(vectors)), where=norms > 0)
    return norms, np.arccos(np.clip(cosine, -1, 1))


def _centre(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1, keepdims=True))
    mean = np.divide(vectors, norms, out=np.zeros(vectors.shape), where=norms > 0).sum(0)
    size = np.sqrt((mean * mean).sum())
    if size > 1e-9:
        return mean / size
    first = np.zeros(vectors.shape[1])
    first[0] = 1.0
    return first


def fit_cells(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of length 1 by spherical k-means from evenly spread rows of the sample; at most ``cells`` of them."""
    norms = np.sqrt((sample.astype(np.float64) ** 2).sum(1, keepdims=True))
    unit = sample[norms[:, 0] > 0] / norms[norms[:, 0] > 0]
    centres = np.unique(unit[np.linspace(0, max(0, len(unit) - 1), min(cells, len(unit))).astype(int)], axis=0) if len(unit) else unit
    for _ in range(PASSES):
        if len(centres) < 2:
            break
        nearest = (unit @ centres.T).argmax(1)
        for c in range(len(centres)):
            if (nearest == c).any():
                centres[c] = _centre(unit[nearest == c])
    return centres


@dataclass
class Slots:
    """What is looked for: for each member and band the best scores from ``low`` to ``high``, above ``start`` or equal."""

    low: np.ndarray
    high: np.ndarray
    start: np.ndarray


def walk(
    members: np.ndarray, member_ids: np.ndarray, member_labels: np.ndarray, centre: np.ndarray, slots: Slots,
    rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, same_label: bool, count: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The best ``count`` rows of each slot: slot numbers, ids and scores in order, each slot's last score, rows scored.

    The rows are sorted once for all members by ``|x| cos(max(0, angle(x, centre) - widest))``, where ``widest`` is
    the largest angle of a member to the centre: times the member's length, no score of that row or of a later one
    is higher. A member stops as soon as that is below what every slot of it needs: the score of its
    last place, or its lower end. Rows with a score equal to the last place are still looked at, for their ids.
    """
    bands = slots.low.shape[1]
    sizes, angles = _angles(members, centre)
    norms, apart = _angles(rows, centre)
    widest = angles.max(initial=0.0)
    bound = norms * np.cos(np.maximum(0.0, apart - widest - 1e-6))
    order = np.argsort(-bound, kind="stable")
    bound = bound[order]
    kind = np.float64 if float(np.abs(members).max(initial=0)) * float(np.abs(rows).max(initial=0)) * members.shape[1] < 2.0**53 else np.int64
    x, y = members.astype(kind), rows[order].astype(kind)
    ids, labels = ids[order], labels[order]
    need = np.maximum(slots.start, slots.low).reshape(-1)
    slot, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    scored = 0
    for i in range(0, len(y), STEP):
        # Roundings of the bound are far below one part in 10^9.
        reach = sizes * bound[i] + np.abs(sizes * bound[i]) * 1e-9 + 1e-3
        active = np.flatnonzero(reach >= need.reshape(-1, bands).min(1))
        if not len(active):
            break
        block = slice(i, i + STEP)
        product = (x[active] @ y[block].T).astype(np.float64)
        scored += product.size
        equal = member_labels[active][:, None] == labels[block][None, :]
        allowed = (equal if same_label else ~equal) & (member_ids[active][:, None] != ids[block][None, :])
        for band in range(bands):
            own = active * bands + band
            m, n = np.nonzero(allowed & (product >= need[own][:, None]) & (product <= slots.high[active, band][:, None]))
            if not len(m):
                continue
            slot, found, score = (np.concatenate(p) for p in ((slot, own[m]), (found, ids[block][n]), (score, product[m, n])))
            sort = np.lexsort((found, -score, slot))
            slot, found, score = slot[sort], found[sort], score[sort]
            place = np.arange(len(slot)) - np.searchsorted(slot, slot)
            keep = place < count
            slot, found, score, place = slot[keep], found[keep], score[keep], place[keep]
            full = place == count - 1
            need[slot[full]] = np.maximum(need[slot[full]], score[full])
    return slot, found, score, need, scored


_ROWS = "array<struct<_id:bigint,_label:string,_whole:binary>>"


def _matrix(rows, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = matrix_rows(rows.field("_whole"), np.int32, length)
    return whole, rows.field("_id").to_numpy(zero_copy_only=False), np.array(rows.field("_label").to_pylist(), object)


def _in_cells(rows: DataFrame, centres: np.ndarray, length: int) -> DataFrame:
    """``rows`` with ``_cell``, the nearest centre; vectors of another length than the centres' are cell 0."""
    fields = [*rows.schema.fields, T.StructField("_cell", T.IntegerType())]
    whole, lengths = rows.columns.index("_whole"), rows.columns.index("_length")

    def place(batches):
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int32)
            at = np.flatnonzero(batch.column(lengths).to_numpy() == length)
            if len(at) and len(centres):
                cells[at] = (matrix_rows(batch.column(whole).take(pa.array(at)), np.int32, length) @ centres.T).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[f.name for f in fields])

    return in_batches(rows, place, T.StructType(fields))


def _blocks(rows: DataFrame, columns: list[str], most: Column) -> DataFrame:
    """``(_length, _cell, _part, _rows)``: the rows of a cell in blocks, dealt by the hash of the id."""
    cell = ["_length", "_cell"]
    placed = dealt(rows, cell, F.col("_id"), most)
    # Dealt by cell and part; the rows may come from the join by cell, where a hot cell is one task.
    return placed.repartition(*cell, "_part").groupBy(*cell, "_part").agg(F.collect_list(F.struct(*columns)).alias("_rows"))


_KEY = ["_length", "_cell", "_part"]


def _lists(rows: DataFrame, centres: np.ndarray, length: int) -> DataFrame:
    """All rows in blocks of about a megabyte with what bounds their scores: centre, widest angle, largest length."""
    most = F.greatest(F.lit(32), F.floor(F.lit(BLOCK_BYTES) / (4 * F.col("_length"))))
    blocks = _blocks(_in_cells(rows, centres, length), ["_id", "_label", "_whole"], most)

    def bounds(batches):
        for batch in batches:
            out = []
            for n in range(batch.num_rows):
                whole, _, _ = _matrix(batch.column(3)[n].values, batch.column(0)[n].as_py())
                centre = _centre(whole)
                norms, angles = _angles(whole, centre)
                out.append((centre.tolist(), float(angles.max()), float(norms.max())))
            made = [pa.array([o[0] for o in out], pa.list_(pa.float64())), *[pa.array([o[i] for o in out], pa.float64()) for i in (1, 2)]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "_centre", "_angle", "_norm"])

    schema = T.StructType([*blocks.schema.fields, *T._parse_datatype_string("_centre array<double>, _angle double, _norm double").fields])
    return settled(in_batches(blocks, bounds, schema))


def _slots(bands: list, start: list | None = None) -> Slots:
    """Bands ``[(low, high), ...]`` of all members, one list each, filled up with empty ones."""
    most = max(map(len, bands))
    low, high = np.full((len(bands), most), np.inf), np.full((len(bands), most), -np.inf)
    for i, b in enumerate(bands):
        for j, (x, y) in enumerate(b):
            low[i, j], high[i, j] = (-np.inf if x is None else x), (np.inf if y is None else y)
    return Slots(low, high, low.copy() if start is None else np.array(start).reshape(low.shape))


def _clusters(anchors: DataFrame, centres: np.ndarray, length: int, same_label: bool, count: int) -> DataFrame:
    """The anchors in clusters, with what the lists need: centre, widest angle, longest, and what every band starts from.

    A cluster's own anchors are rows too, so the last place among them is a score that no band ends below.
    """
    blocks = _blocks(_in_cells(anchors, centres, length), ["_id", "_label", "_whole", "_bands"], F.lit(CLUSTER))
    extra = "_centre array<double>, _angle double, _norm double, _start array<double>, _least double"

    def bounds(batches):
        for batch in batches:
            out = []
            for n in range(batch.num_rows):
                rows = batch.column(3)[n].values
                whole, ids, labels = _matrix(rows, batch.column(0)[n].as_py())
                centre = _centre(whole)
                norms, angles = _angles(whole, centre)
                slots = _slots([[(b["low"], b["high"]) for b in m] for m in rows.field("_bands").to_pylist()])
                need = walk(whole, ids, labels, centre, slots, whole, ids, labels, same_label, count)[3]
                out.append((centre.tolist(), float(angles.max()), float(norms.max()), need.tolist(), float(need.min())))
            types = [pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.float64()]
            made = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f.split()[0] for f in extra.split(", ")]])

    schema = T.StructType([*blocks.schema.fields, *T._parse_datatype_string(extra).fields])
    return settled(in_batches(blocks, bounds, schema))


_FOUND = "_anchor bigint, _band int, _id bigint, _score bigint"


def _search(clusters: DataFrame, lists: DataFrame, same_label: bool, count: int) -> DataFrame:
    """``(_anchor, _band, _id, _score, _rank)``: the best ``count`` rows of every band over all lists.

    Which cluster meets which list is decided on their bounds alone: no member can find in the list what it needs if
    the angles leave no score that high. Every cluster that remains walks the list.
    """
    # The bounds of all lists go to every slice of the clusters; there are never more slices than clusters.
    slices = max(1, min(int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions")), clusters.count()))
    slice_of = F.pmod(F.hash("_cell", "_part"), F.lit(slices)).alias("_slice")
    few = clusters.select(
        "_length", F.col("_cell").alias("_a_cell"), F.col("_part").alias("_a_part"), F.col("_centre").alias("_a_centre"),
        F.col("_angle").alias("_a_angle"), F.col("_norm").alias("_a_norm"), "_least", slice_of,
    )
    many = lists.select(*_KEY, "_centre", "_angle", "_norm", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"))
    met = many.join(few, ["_length", "_slice"])
    product = F.aggregate(F.zip_with("_centre", "_a_centre", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product))) - F.col("_angle") - F.col("_a_angle") - 1e-6
    reach = F.greatest(F.lit(0.0), F.cos(F.greatest(F.lit(0.0), angle))) * F.col("_norm") * F.col("_a_norm") * (1 + 1e-9) + 1e-3
    met = met.where(reach >= F.col("_least")).select(*_KEY, "_a_cell", "_a_part")
    met = met.join(lists.select(*_KEY, F.col("_rows").alias("_list")), _KEY)
    anchors = clusters.select(
        "_length", F.col("_cell").alias("_a_cell"), F.col("_part").alias("_a_part"), F.col("_rows").alias("_members"), "_centre", "_start"
    )
    met = met.join(anchors, ["_length", "_a_cell", "_a_part"]).select("_length", "_members", "_centre", "_start", "_list")

    def search(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                length = batch.column(0)[n].as_py()
                members = batch.column(1)[n].values
                whole, ids, labels = _matrix(members, length)
                slots = _slots([[(b["low"], b["high"]) for b in m] for m in members.field("_bands").to_pylist()], batch.column(3)[n].as_py())
                rows, row_ids, row_labels = _matrix(batch.column(4)[n].values, length)
                centre = np.array(batch.column(2)[n].as_py())
                slot, found, score, _, _ = walk(whole, ids, labels, centre, slots, rows, row_ids, row_labels, same_label, count)
                bands = slots.low.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[slot // bands]), pa.array((slot % bands).astype(np.int32)), pa.array(found), pa.array(score.astype(np.int64))],
                    names=["_anchor", "_band", "_id", "_score"],
                )

    best = W.partitionBy("_anchor", "_band").orderBy(F.desc("_score"), "_id")
    found = in_batches(met, search, _FOUND).withColumn("_rank", F.row_number().over(best))
    return found.where(F.col("_rank") <= count)


def _sample(anchors: DataFrame, total: int) -> tuple[int, np.ndarray]:
    """About `SAMPLE` anchors of the most frequent length, chosen by the hash of their id."""
    length = anchors.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_length").first()[0]
    some = anchors.where((F.col("_length") == length) & (uniform(F.col("_id")) < min(1.0, 1.2 * SAMPLE / total)))
    rows = some.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE).select("_whole").collect()
    return length, np.array([np.frombuffer(r[0], np.int32) for r in rows]).reshape(-1, length)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor: Callable[[Column], Column],
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    scale: int = SCALE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` says of an id whether its row is an anchor. Components become whole numbers ``floor(scale * x)``; a row's
    score is its inner product with the anchor. Positives are the best ``positives`` other rows with the anchor's
    label; of each, the best ``negatives`` rows of other labels whose score is within ``band`` hundredths of the
    positive's. Equal scores go by the smaller id. Negative positive scores have no such row.

    No part take rows without id or label, and vectors that are null, empty, or hold a null or a component that is
    not finite. Vectors of different lengths are never compared. Of rows with one id, the smallest by label (as text)
    and vector counts. Components beyond 4,096 count as that. Ids are whole numbers. An empty table, or one
    without anchors, gives an empty result.

    All rows are in lists of a megabyte, all anchors in clusters of about 512; each cluster meets each list whose bound
    leaves room for a result, so the work is the anchors times all rows at most. A cluster and a list
    give the best few rows of each anchor only.
    """
    usable = whole_vectors(vectors, id_column, vector_column, label_column, scale, LIMIT)
    usable = usable.where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
    one = F.min(F.struct(F.col("_label").cast("string").alias("_label"), "_length", "_whole")).alias("_row")
    rows = settled(usable.select(F.col("_id").cast("bigint").alias("_id"), "_label", "_length", "_whole").groupBy("_id").agg(one).select("_id", "_row.*"))
    anchors = rows.where(anchor(F.col("_id")))
    total, every = anchors.count(), rows.count()
    if not total:
        nothing = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], nothing)
    length, sample = _sample(anchors, total)
    in_list = max(32, BLOCK_BYTES // (4 * length))
    lists = _lists(rows, fit_cells(sample, min(MOST_CELLS, -(-every // in_list))), length)
    centres = fit_cells(sample, min(MOST_CELLS, -(-total // CLUSTER)))
    bands = T._parse_datatype_string("array<struct<low:double,high:double>>")
    everything = F.array(F.struct(F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))).cast(bands)
    clusters = _clusters(anchors.withColumn("_bands", everything), centres, length, True, positives)
    best = settled(
        _search(clusters, lists, True, positives).select(
            "_anchor", F.col("_rank").alias("_place"), F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score")
        )
    )
    low, high = band
    # Whole numbers n with low * p <= 100 * n <= high * p.
    from_, to = F.ceil(low * F.col("positive_score") / 100), F.floor(high * F.col("positive_score") / 100)
    of_anchor = best.groupBy(F.col("_anchor").alias("_id")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_place", from_.cast("double").alias("low"), to.cast("double").alias("high")))),
            lambda b: F.struct(b["low"].alias("low"), b["high"].alias("high")),
        ).cast(bands).alias("_bands")
    )
    clusters = _clusters(anchors.join(of_anchor, "_id"), centres, length, False, negatives)
    found = _search(clusters, lists, False, negatives)
    out = found.withColumn("_place", F.col("_band") + 1).join(best, ["_anchor", "_place"])
    return out.select(
        F.col("_anchor").alias("anchor_id"), "positive_id", F.col("_rank").alias("rank"), F.col("_id").alias("negative_id"),
        "positive_score", F.col("_score").alias("negative_score"),
    )
