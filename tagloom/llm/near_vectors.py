"""Near duplicates of embeddings: tiles compared along principal axes, with bounds from the rest of each vector."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, same, settled
from tagloom.llm.components import components
from tagloom.llm.vectors import BLOCK_BYTES, binary_rows, dealt, matrix_rows, vectors_by_length

THRESHOLD = 0.93
#: Products are accumulated over the first 8 axes, then up to axis 16, 32, ...
FIRST_AXES = 8
#: Principal axes are those of so many components at most, so that the driver's matrix is bounded; others stay as they are.
AXES = 1024
#: Cells of a label are cut along so many of the first axes.
CELL_AXES = 2
#: Rows of two tiles are compared so many at once.
SQUARE = 512
#: Roundings of rotated products are far below this; pairs as close to the threshold are added up once more, in one fixed order.
_ROUNDING = 1e-9
_LAST_ID = 2**63 - 1


def _directions(vectors: DataFrame) -> DataFrame:
    """All rows with ``_key`` and ``_unit`` beside ``_id`` and ``_label``; both are null where no link is possible.

    ``_unit`` is the vector at length 1 in doubles, ``_key`` a digest of label, length and the vector as given.
    """
    schema = T.StructType(
        [vectors.schema["_id"], *[T.StructField(n, t) for n, t in
         (("_label", T.StringType()), ("_length", T.IntegerType()), ("_key", T.BinaryType()), ("_unit", T.BinaryType()))]]
    )

    def convert(batches):
        for batch in batches:
            labels = batch.column(1).to_pylist()
            rest = np.ones(batch.num_rows, bool)
            for at, matrix in vectors_by_length(batch.column(2)):
                # Scaled by the largest component first, so that squares neither overflow nor vanish.
                largest = np.abs(matrix).max(1)
                usable = (largest > 0) & np.array([labels[i] is not None for i in at])
                at, matrix, largest = at[usable], matrix[usable], largest[usable]
                if not len(at):
                    continue
                rest[at] = False
                scaled = matrix / largest[:, None]
                unit = scaled / np.sqrt((scaled * scaled).sum(1))[:, None]
                names = [f"{labels[i]}\0{matrix.shape[1]}\0".encode() for i in at]
                matrix = matrix + 0.0  # -0.0 becomes 0.0
                keys = [hashlib.blake2b(n + v.tobytes(), digest_size=16).digest() for n, v in zip(names, matrix)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                     pa.array(np.full(len(at), matrix.shape[1], np.int32)), pa.array(keys, pa.binary()), binary_rows(unit)],
                    names=schema.names,
                )
            at = pa.array(np.flatnonzero(rest))
            nothing = [pa.nulls(len(at), t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *nothing], names=schema.names)

    return in_batches(vectors, convert, schema)


def principal_axes(groups: DataFrame) -> tuple[int, np.ndarray]:
    """The most frequent length of the vectors and its principal axes, the one with the largest sum of squares first.

    Sums of products cover all vectors: a task sends its own sum, one row for each axis, and Spark adds them up. The
    driver gets one square matrix, of the first `AXES` components. Any rotation gives the same links; this one makes
    the bounds tight early.
    """
    lengths = groups.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_length").first()
    if lengths is None:
        return 0, np.zeros((0, 0))
    length = lengths[0]
    turned = min(length, AXES)

    def products(batches):
        total = np.zeros((turned, turned))
        for batch in batches:
            unit = matrix_rows(batch.column(0), np.float64, length)[:, :turned]
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(turned, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["_axis", "_sums"]
        )

    of_tasks = in_batches(groups.where(F.col("_length") == length).select("_unit"), products, "_axis int, _sums array<double>")
    flat = of_tasks.select("_axis", F.posexplode("_sums").alias("_other", "_sum"))
    gram = np.zeros((turned, turned))
    for r in flat.groupBy("_axis", "_other").agg(F.sum("_sum").alias("s")).collect():
        gram[r["_axis"], r["_other"]] = r["s"]
    return length, np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def _celled(groups: DataFrame, length: int, axes: np.ndarray, threshold: float) -> DataFrame:
    """The groups with their vectors turned to the axes, and the cell of each: two linked vectors are less than a
    cell's width apart along every axis, so they are in the same cell or in neighbouring ones."""
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    names = [*groups.columns[:-1], "_cells", "_turned"]

    def turn(batches):
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                part = batch.take(pa.array(at))
                unit = matrix_rows(part.column(part.num_columns - 1), np.float64, int(n))
                turned = unit.copy()
                if n == length:
                    turned[:, : len(axes)] = unit[:, : len(axes)] @ axes
                lead = np.zeros((len(turned), CELL_AXES))
                lead[:, : min(n, CELL_AXES)] = turned[:, :CELL_AXES]
                cells = np.floor(lead / width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(list(cells), pa.list_(pa.int32())), binary_rows(turned)], names=names
                )

    fields = [*groups.schema.fields[:-1], T.StructField("_cells", T.ArrayType(T.IntegerType())), T.StructField("_turned", T.BinaryType())]
    return in_batches(groups, turn, T.StructType(fields))


def tiles(groups: DataFrame, length: int, axes: np.ndarray, threshold: float) -> DataFrame:
    """``(_label, _length, _cells, _part, _rows)``: the groups of a cell in tiles of about a megabyte.

    Rows are dealt to the tiles of their cell by hash, so tiles are even however large a label or a cell is.
    """
    celled = settled(_celled(groups, length, axes, threshold))
    cell = ["_label", "_length", "_cells"]
    most = F.greatest(F.lit(32), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("_length"))))
    placed = dealt(celled, cell, F.col("_key"), most)
    row = F.struct("_id", "_key", "_size", "_turned")
    # Dealt by cell and part; the rows may come from the join by cell, where a hot cell is one task.
    return placed.repartition(*cell, "_part").groupBy(*cell, "_part").agg(F.collect_list(row).alias("_rows"))


def _tile_pairs(keys: DataFrame) -> DataFrame:
    """The pairs of tiles that can hold links: tiles of one cell, and of neighbouring cells once."""
    steps = [(0, 0)]
    steps += [(a, b) for a in (0, 1) for b in (-1, 0, 1) if (a, b) > (0, 0)]
    step = F.explode(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in steps])).alias("_step")
    left = keys.select("*", step).select(
        "_label", "_length", F.zip_with("_cells", "_step", lambda c, s: c + s).alias("_cells"),
        F.col("_cells").alias("_a_cells"), F.col("_part").alias("_a_part"),
    )
    pairs = left.join(keys, ["_label", "_length", "_cells"])
    return pairs.where((F.col("_cells") != F.col("_a_cells")) | (F.col("_a_part") <= F.col("_part")))


class _Tile:
    def __init__(self, rows, length: int) -> None:
        self.ids = rows.field("_id").to_numpy(zero_copy_only=False)
        self.keys = rows.field("_key")
        self.sizes = rows.field("_size").to_numpy()
        self.turned = matrix_rows(rows.field("_turned"), np.float64, length)
        squares = np.cumsum((self.turned * self.turned)[:, ::-1], axis=1)[:, ::-1]
        self.rest = np.sqrt(np.concatenate([squares, np.zeros((len(squares), 1))], axis=1))  # of axis i and all after it


def linked(a: np.ndarray, a_rest: np.ndarray, b: np.ndarray, b_rest: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows whose product reaches the threshold, as two arrays of row numbers.

    Products are accumulated along the leading axes of all pairs; a pair goes as soon as its product so far and the
    product of the lengths of both rests are below the threshold. While many pairs are left all are carried on
    together, then only those that are left.
    """
    length = a.shape[1]
    least = threshold - _ROUNDING
    until = min(FIRST_AXES, length)
    product = a[:, :until] @ b[:, :until].T
    while True:
        open_ = product + np.outer(a_rest[:, until], b_rest[:, until]) >= least
        if until == length or np.count_nonzero(open_) * 16 < open_.size:
            break
        after = min(2 * until, length)
        product += a[:, until:after] @ b[:, until:after].T
        until = after
    i, j = np.nonzero(open_)
    product = product[i, j]
    while until < length and len(i):
        after = min(2 * until, length)
        product += np.einsum("ij,ij->i", a[i, until:after], b[j, until:after])
        until = after
        left = product + a_rest[i, until] * b_rest[j, until] >= least
        i, j, product = i[left], j[left], product[left]
    # All axes are in the products now; roundings decide only next to the threshold.
    close = np.abs(product - threshold) <= _ROUNDING
    keep = product >= threshold
    for n in np.flatnonzero(close):
        keep[n] = float(np.sum(np.sort(a[i[n]] * b[j[n]]))) >= threshold
    return i[keep], j[keep]


class _Forest:
    """Which rows of two tiles hang together, and a tree of links for each such set."""

    def __init__(self, count: int) -> None:
        self.root = np.arange(count)
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            flat = self.root
            while True:  # every row's root at once
                up = flat[flat]
                if (up == flat).all():
                    break
                flat = up
            self.root = flat
            a, b = flat[i], flat[j]
            apart = np.flatnonzero(a != b)
            if not len(apart):
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            # One link for every root on the left; what these do not join is looked at again.
            _, first = np.unique(a, return_index=True)
            for n in first:
                x, y = self.find(int(a[n])), self.find(int(b[n]))
                if x != y:
                    self.root[max(x, y)] = min(x, y)
                    self.links.append((int(i[n]), int(j[n])))


_FOUND = "_id bigint, _key binary, _n bigint, _to_id bigint, _to_key binary"


def _compare(threshold: float):
    """For a pair of tiles: each row's number of links, and links that hold together what the tiles' links join."""

    def compare(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                length = batch.column(0)[n].as_py()
                a, b = (_Tile(batch.column(c)[n].values, length) for c in (1, 2))
                own = batch.column(3)[n].as_py()
                counts = [np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)]
                forest = _Forest(len(a.ids) + len(b.ids))
                for x in range(0, len(a.ids), SQUARE):
                    for y in range(x if own else 0, len(b.ids), SQUARE):
                        i, j = linked(a.turned[x : x + SQUARE], a.rest[x : x + SQUARE], b.turned[y : y + SQUARE], b.rest[y : y + SQUARE], threshold)
                        i, j = i + x, j + y
                        if own:  # a tile with itself: each pair once
                            i, j = i[i < j], j[i < j]
                        np.add.at(counts[0], i, b.sizes[j])
                        np.add.at(counts[0 if own else 1], j, a.sizes[i])
                        forest.add(i, j if own else j + len(a.ids))
                both = pa.chunked_array([a.keys, b.keys]).combine_chunks()
                ids = np.concatenate([a.ids, b.ids])
                number = np.concatenate(counts)
                at = np.flatnonzero(number)
                tree = np.array(forest.links, np.int64).reshape(-1, 2)
                nothing = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[at], ids[tree[:, 0]]])),
                     pa.concat_arrays([both.take(pa.array(at)), both.take(pa.array(tree[:, 0]))]),
                     pa.concat_arrays([pa.array(number[at]), pa.nulls(len(tree), pa.int64())]),
                     pa.concat_arrays([pa.nulls(nothing, pa.int64()), pa.array(ids[tree[:, 1]])]),
                     pa.concat_arrays([pa.nulls(nothing, pa.binary()), both.take(pa.array(tree[:, 1]))])],
                    names=["_id", "_key", "_n", "_to_id", "_to_key"],
                )

    return compare


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``vectors``: ``(id_column, label_column, n_links, component_id, kept)``.

    Vectors of equal, not null label and equal length link when their cosine is at least ``threshold`` (above 0).
    ``n_links`` counts a vector's links, ``component_id`` is the smallest id reached by links, the own
    included, and ``kept`` says that it is the own. Ids are whole numbers.

    Vectors that are null, empty, zero, or hold a null or a component that is not finite link with nothing, nor do
    those without a label. Rows that repeat, with the same id or not, are vectors of their own that link; equal
    vectors always link. A vector without id counts as a link of others; its component is the smallest
    id it reaches, null if there is none, and it is not kept. An empty table gives an empty result.

    Equal vectors become one group first, so copies of one vector cost nothing more. Groups of a label are cut into
    cells along two principal axes and into tiles of a megabyte; only tiles of the same or neighbouring cells
    meet. A pair of tiles returns a number for each row and a tree of links, never its pairs. All vectors of a label
    that lie in neighbouring cells are compared, which is their number squared, cut short by the bounds.
    """
    rows = settled(
        _directions(vectors.select(
            F.col(f"`{id_column}`").cast("bigint").alias("_id"), F.col(f"`{label_column}`").cast("string").alias("_label"),
            F.col(f"`{vector_column}`").alias("_vector"),
        ))
    )
    usable = rows.where(F.col("_key").isNotNull())
    # A null id is the largest number in the groups; null again in the result.
    groups = settled(
        usable.groupBy("_label", "_length", "_key").agg(
            F.coalesce(F.min("_id"), F.lit(_LAST_ID)).alias("_id"), F.count(F.lit(1)).alias("_size"), F.first("_unit").alias("_unit")
        )
    )
    length, axes = principal_axes(groups)
    made = settled(tiles(groups, length, axes, threshold))
    tile = ["_label", "_length", "_cells", "_part"]
    pairs = _tile_pairs(made.select(*tile))
    # The keys of pairs are few; each side's rows join them by tile.
    sides = pairs.join(made.select(*tile, F.col("_rows").alias("_b")), tile)
    of_a = made.select("_label", "_length", F.col("_cells").alias("_a_cells"), F.col("_part").alias("_a_part"), F.col("_rows").alias("_a"))
    sides = sides.join(of_a, ["_label", "_length", "_a_cells", "_a_part"])
    own = (F.col("_cells") == F.col("_a_cells")) & (F.col("_part") == F.col("_a_part"))
    found = settled(in_batches(sides.select("_length", "_a", "_b", own.alias("_own")), _compare(threshold), _FOUND))
    counts = found.where(F.col("_n").isNotNull()).groupBy("_key").agg(F.sum("_n").alias("_n"))
    node = F.struct(F.col("_id").alias("id"), F.col("_key").alias("key")).alias("a")
    edges = found.where(F.col("_n").isNull()).select(node, F.struct(F.col("_to_id").alias("id"), F.col("_to_key").alias("key")).alias("b"))
    roots = components(edges, "a", "b").select(F.col("node.key").alias("_key"), F.col("root.id").alias("_root")).distinct()
    state = groups.select("_key", "_size", "_id").join(counts, "_key", "left").join(roots, "_key", "left").select(
        F.col("_key").alias("_of"),
        (F.col("_size") - 1 + F.coalesce("_n", F.lit(0))).alias("n_links"),
        F.nullif(F.least("_id", "_root"), F.lit(_LAST_ID)).alias("_component"),
    )
    component = F.coalesce("_component", F.when(F.col("_of").isNull(), F.col("_id")))
    out = rows.select("_id", "_label", "_key").join(state, F.col("_key") == F.col("_of"), "left")
    return out.select(
        F.col("_id").alias(id_column),
        F.col("_label").cast(vectors.schema[label_column].dataType).alias(label_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component.isNotNull() & same(F.col("_id"), component)).alias("kept"),
    )
