"""Product codes of vectors: codebooks by k-means on whole numbers, nearest entries by Orchard's search."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, same, settled
from tagloom.llm.vectors import exact, matrix_rows, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Whole numbers stay below this, that is components below 8,192: then distances of up to 4,096 components fit a long.
LIMIT = 1 << 23
#: So many entries of a list are looked at in one step; vectors walk together as long as a step has so many components.
STEP, COMPONENTS = 16, 1 << 20


class Orchard:
    """Nearest entries of one codebook, by lists of all entries in the order of their distance to each entry.

    A vector holds a current entry and walks that entry's list. An entry that is nearer, or as near with a lower
    index, becomes the current one and the walk goes on in its list; what was visited before is not looked at again.
    Entries further from the current one than twice the vector's distance to it are further from the vector too,
    by the triangle inequality, so the walk ends there. An entry as near as the current one is never beyond.
    """

    def __init__(self, entries: np.ndarray, largest: int = LIMIT) -> None:
        self.entries = exact(entries, 4.0 * (2.0 * largest) ** 2 * max(1, entries.shape[1]))
        apart = np.stack([((self.entries - e) ** 2).sum(1) for e in self.entries])
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.radii = np.take_along_axis(apart, self.lists, 1)
        self.norms = (self.entries * self.entries).sum(1)
        self.sums = self.entries.sum(1)
        self.by_sum = np.argsort(self.sums, kind="stable")
        self.looked_at = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to each vector's nearest entry; of equally near ones the lowest index."""
        together = max(64, COMPONENTS // (STEP * max(1, vectors.shape[1])))
        found = [self._walk(vectors[i : i + together].astype(self.entries.dtype)) for i in range(0, len(vectors), together)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]).astype(np.int64)

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(self.entries)
        # Any start is right; the entry with the nearest sum of components is a cheap good one.
        current = self.by_sum[np.minimum(np.searchsorted(self.sums[self.by_sum], x.sum(1)), count - 1)]
        norms = (x * x).sum(1)
        best = ((x - self.entries[current]) ** 2).sum(1)
        far = np.inf if x.dtype == np.float64 else np.iinfo(np.int64).max
        seen = np.zeros((len(x), count), bool)
        seen[np.arange(len(x)), current] = True
        at = np.zeros(len(x), np.int64)
        walking = np.arange(len(x))
        while len(walking):
            places = at[walking, None] + np.arange(STEP)
            inside = places < count
            places = np.minimum(places, count - 1)
            held, owner = current[walking], walking[:, None]
            entries = self.lists[held[:, None], places]
            within = inside & (self.radii[held[:, None], places] <= 4 * best[owner])
            new = within & ~seen[owner, entries]
            seen[owner, entries] |= new
            self.looked_at += np.count_nonzero(new)
            # |x - e|^2 as |x|^2 - 2 x e + |e|^2, all of whole numbers.
            product = np.einsum("nd,nkd->nk", x[walking], self.entries[entries])
            near = np.where(new, norms[owner] - 2 * product + self.norms[entries], far)
            least = near.min(1)
            lowest = np.where(near == least[:, None], entries, count).min(1)
            better = (least < best[walking]) | ((least == best[walking]) & (lowest < held))
            better &= new.any(1)
            moved = walking[better]
            current[moved], best[moved], at[moved] = lowest[better], least[better], 0
            at[walking[~better]] += STEP
            walking = walking[better | within[:, -1]]
        return current, best


def part_bounds(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Consecutive parts; if they cannot be equal, the first ones have a component more."""
    cuts = [0, *np.cumsum([len(p) for p in np.array_split(np.arange(length), parts)]).tolist()]
    return list(zip(cuts[:-1], cuts[1:]))


def first_entries(rows: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """The vectors of the smallest ids, at most ``entries``, null ids last; equal ids are ordered by vector.

    All have the length of the first. The ids are found alone, so that few vectors travel.
    """
    order = [F.col("_id").asc_nulls_last(), F.col("_whole")]
    first = rows.orderBy(*order).select("_length").first()
    if first is None:
        return np.zeros((0, 0), np.int32)
    rows = rows.where(F.col("_length") == first[0])
    ids = [r[0] for r in rows.select("_id").orderBy(order[0]).limit(entries).collect()]
    if len(ids) == entries and ids[-1] is not None:
        rows = rows.where(F.col("_id") <= F.lit(ids[-1]))
    found = rows.orderBy(*order).limit(entries).select("_whole").collect()
    return np.stack([np.frombuffer(r[0], np.int32) for r in found])


def fit_codebooks(rows: DataFrame, first: np.ndarray, parts: int = PARTS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part after ``rounds`` of assigning all parts and replacing entries by their means.

    Every round reads all rows once. A task adds up its own parts for each entry and sends one row for each; the
    sums of all tasks are aggregated by Spark, and the driver gets ``parts * entries`` rows.
    """
    length = first.shape[1]
    bounds = part_bounds(length, parts)
    books = [first[:, i:j].astype(np.int64) for i, j in bounds]
    widest = max(j - i for i, j in bounds)
    schema = "_part int, _entry int, _count bigint, _sums array<bigint>"
    for _ in range(rounds):

        def add_up(batches, books=books):
            searches = [Orchard(b) for b in books]
            counts = [np.zeros(len(b), np.int64) for b in books]
            sums = [np.zeros((len(b), widest), np.int64) for b in books]
            for batch in batches:
                whole = matrix_rows(batch.column(0), np.int32, length)
                for p, (i, j) in enumerate(bounds):
                    chosen, _ = searches[p].nearest(whole[:, i:j])
                    counts[p] += np.bincount(chosen, minlength=len(books[p]))
                    for c in range(i, j):  # exact: a batch has far fewer than 2^30 rows
                        sums[p][:, c - i] += np.bincount(chosen, whole[:, c], len(books[p])).astype(np.int64)
            for p, n in enumerate(counts):
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(n[used]),
                     pa.array(list(sums[p][used]), pa.list_(pa.int64()))],
                    names=["_part", "_entry", "_count", "_sums"],
                )

        of_tasks = in_batches(rows.select("_whole"), add_up, schema)
        # A decimal, as the sum of all rows may exceed a long.
        totals = [F.sum(F.get("_sums", F.lit(c)).cast("decimal(38,0)")) for c in range(widest)]
        totals = of_tasks.groupBy("_part", "_entry").agg(F.sum("_count").alias("_count"), F.array(*totals).alias("_sums")).collect()
        books = [b.copy() for b in books]
        for r in totals:
            book = books[r["_part"]]
            book[r["_entry"]] = [int(s) // r["_count"] for s in r["_sums"][: book.shape[1]]]
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``(_id, _label, code, error)`` of the rows of `whole_vectors`: nearest entries and their squared distances' sum."""
    bounds = part_bounds(sum(b.shape[1] for b in books), len(books))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def assign(batches):
        searches = None
        for batch in batches:
            searches = searches or [Orchard(b) for b in books]
            whole = matrix_rows(batch.column(2), np.int32, bounds[-1][1])
            codes, error = np.zeros((len(whole), len(books)), np.uint8), np.zeros(len(whole), np.int64)
            for p, (i, j) in enumerate(bounds):
                chosen, apart = searches[p].nearest(whole[:, i:j])
                codes[:, p] = chosen
                error += apart
            texts = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, pa.array(error)], names=schema.names)

    return in_batches(rows.select("_id", "_label", "_whole"), assign, schema)


def compress_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(id_column, label_column, code, error, label_error)`` for every usable vector, and the codebooks.

    A vector is cut into ``parts`` consecutive parts of whole numbers ``floor(scale * x)``; its code has two hex
    digits for the nearest entry of each part's codebook, ties to the lower index. Codebooks start as the parts of
    the smallest ids (null ids last, equal ids by vector) and are replaced ``rounds`` times by floored means;
    entries that are nobody's nearest stay. ``label_error`` is the error summed over equal labels, nulls together.

    Left out: vectors that are null, empty, hold a null or a component that is not finite, or have another length
    than the smallest kept id's. Rows that repeat are coded each. With fewer rows than entries the codebooks
    have as many entries as rows; without any row the result and the codebooks are empty. Components
    beyond 8,192 count as that. Sums of errors beyond a long are the largest long. ``entries`` is at most 256.
    """
    if not 0 < entries <= 256:
        raise ValueError(f"a code of two hex digits needs 1 to 256 entries, not {entries}")
    rows = settled(whole_vectors(vectors, id_column, vector_column, label_column, scale, LIMIT))
    first = first_entries(rows, entries)
    rows = rows.where(F.col("_length") == first.shape[1])
    books = fit_codebooks(rows, first, parts, rounds) if len(first) else [np.zeros((0, 0), np.int64)] * parts
    coded = settled(encode(rows, books))
    return with_label_error(coded).select(
        F.col("_id").alias(id_column), F.col("_label").alias(label_column), "code", "error", "label_error"
    ), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """One aggregate by label, joined back; a hot label's rows are split by adaptive execution or meet a small table."""
    total: Column = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    by_label = coded.groupBy(F.col("_label").alias("_of")).agg(total.alias("label_error"))
    return coded.join(by_label, same(F.col("_label"), F.col("_of"))).drop("_of")
