"""Jaccard similarity join on word shingles by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, packed, same, settled, utf8
from tagloom.llm.components import components
from tagloom.llm.shingles import WORDS, mixed, shingle_sets, text_parts

SIMILARITY, RECALL = 0.8, 0.9999
BRANCHING = 2.0  # shared tokens that a run samples, on average, of two sets at the least similarity
LEVELS = 3  # tokens a path can have
BUCKET = 2000  # a bucket with more sets is split by the next token of the paths, up to the last level
SKETCH, SKETCH_COMMON = 48, 0.55
BLOCK_SETS, BLOCK_TOKENS = 1000, 1 << 21

_ODD = np.random.default_rng(5).integers(1, 2**62, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs_for(recall: float) -> int:
    """How many runs find a pair at the least similarity with this probability.

    Such a pair shares at least `BRANCHING` sampled tokens on a level of a run on average, so none with a chance of
    exp(-`BRANCHING`) at most. In buckets that are split up to the last level it must share one on every level, and
    as samples do not depend on the path, no other path makes up for a level without one.
    """
    found = (1 - math.exp(-BRANCHING)) ** LEVELS
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


HASHED = T.StructType(
    [
        T.StructField("_key", T.BinaryType()),
        T.StructField("_size", T.LongType()),
        T.StructField("_picks", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("_sketch", T.ArrayType(T.IntegerType())),
    ]
)


def _sampled(sets: np.ndarray, ends: np.ndarray, similarity: float, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text, run and level the tokens whose hash is below a bound that depends on the set's size.

    The bound is the same function of the token for all sets, so sets share samples as they share tokens. Samples are
    named by 32 bits: two tokens of one name only put more sets in a bucket.
    """
    sizes = np.diff(ends)
    of = np.repeat(np.arange(len(sizes)), sizes)
    bound = np.minimum(BRANCHING / (similarity * np.maximum(sizes, 1)), 1.0) * float(2**63)
    bound = bound.astype(np.uint64)[of]
    picks, lengths = [], np.zeros((len(sizes), runs * LEVELS), np.int64)
    for k in range(runs * LEVELS):
        value = sets * _ODD[k]
        value = (value ^ (value >> np.uint64(29))) * _ODD[k + 1] >> np.uint64(1)
        chosen = np.flatnonzero(value < bound)
        picks.append((mixed(sets[chosen] + _ODD[k]) >> np.uint64(32)).astype(np.uint32))
        lengths[:, k] = np.bincount(of[chosen], minlength=len(sizes))
    # By text, then run and level.
    owner = np.concatenate([np.repeat(np.arange(len(sizes)), lengths[:, k]) for k in range(runs * LEVELS)])
    return np.concatenate(picks)[np.argsort(owner, kind="stable")].view(np.int32), lengths.ravel()


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def _hashed_batch(data: np.ndarray, offsets: np.ndarray, words: int, similarity: float, runs: int) -> list[pa.Array]:
    sets, ends = shingle_sets(data, offsets, words)
    sizes = np.diff(ends)
    key = np.zeros((len(sizes), 2), np.uint64)
    if len(sets):
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets + _ODD[-1 - i]))]) for i in range(2)]
        key = np.stack([s[ends[1:]] - s[ends[:-1]] for s in sums], 1)
    picks, lengths = _sampled(sets, ends, similarity, runs)
    few = np.minimum(sizes, SKETCH)
    first = np.repeat(ends[:-1] - (np.cumsum(few) - few), few) + np.arange(few.sum())
    sketch = (sets[first] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return [
        pa.array([k.tobytes() for k in key], pa.binary()),
        pa.array(sizes),
        pa.ListArray.from_arrays(_offsets(np.full(len(sizes), runs * LEVELS)), pa.ListArray.from_arrays(_offsets(lengths), pa.array(picks))),
        pa.ListArray.from_arrays(_offsets(few), pa.array(sketch)),
    ]


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def hashed_sets(rows: DataFrame, words: int, similarity: float, runs: int) -> DataFrame:
    """``rows`` of ``(_id, _mark, _text)`` as ``(_id, _mark)`` and `HASHED`; equal sets have equal keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("_text"))
            for i, j in text_parts(offsets):
                arrays = _hashed_batch(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words, similarity, runs)
                kept = [batch.column(c).slice(i, j - i) for c in ("_id", "_mark")]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], ["_id", "_mark", *HASHED.names])

    return in_batches(rows, run, T.StructType([rows.schema["_id"], rows.schema["_mark"], *HASHED.fields]))


def shingle_rows(rows: DataFrame, words: int) -> DataFrame:
    """``rows`` of ``(_key, _text)`` as ``(_key, _set)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("_text"))
            for i, j in text_parts(offsets):
                sets, ends = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("_key").slice(i, j - i), column], ["_key", "_set"])

    return in_batches(rows, run, T.StructType([rows.schema["_key"], T.StructField("_set", T.ArrayType(T.LongType()))]))


def buckets(sets: DataFrame, similarity: float, runs: int) -> DataFrame:
    """``(_path, _class, _key, _n)``: the buckets that hold at least two sets, and how many.

    A set's paths begin with each token it samples in a run. A bucket with more than `BUCKET` sets is split: each of
    its sets goes on with each token it samples for the next level. Sets come in classes of size, and a set goes to
    the class above too if one that is similar could be there; so a bucket's sets are of like size.
    """
    at = [F.floor(F.log2(F.col("_size") / s)) for s in (1.0, similarity)]
    level = sets.select("_key", "_picks", F.explode(F.array_distinct(F.array(*at))).alias("_class"))
    level = level.select("_key", "_picks", "_class", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("_run"))
    level = level.select("_key", "_run", "_class", F.explode(F.get("_picks", F.col("_run") * LEVELS)).alias("_token"))
    level = level.select("_key", "_run", "_class", F.xxhash64("_class", "_run", "_token").alias("_path"))
    done = []
    for depth in range(1, LEVELS + 1):
        level = settled(level)
        counts = settled(level.groupBy("_path").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1))
        counted = level.join(counts, "_path")
        if depth == LEVELS:
            done.append(counted.select("_path", "_class", "_key", "_n"))
            break
        done.append(counted.where(F.col("_n") <= BUCKET).select("_path", "_class", "_key", "_n"))
        # Written, so that Spark knows how small they mostly are, and need not shuffle all rows to find the few.
        large = settled(counts.where(F.col("_n") > BUCKET).coalesce(1))
        if large.isEmpty():
            break
        again = settled(level.join(large, "_path").select("_path", "_class", "_key", "_run"))
        again = again.join(sets.select("_key", "_picks"), "_key")
        token = F.explode(F.get("_picks", F.col("_run") * LEVELS + depth)).alias("_token")
        level = again.select("_key", "_run", "_class", "_path", token).select("_key", "_run", "_class", F.xxhash64("_path", "_token").alias("_path"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return settled(out)


def _in_blocks(members: DataFrame) -> DataFrame:
    """Rows of a bucket as groups of one or two blocks of it, so that every two sets of it are in one group.

    A block has at most some 1,000 sets and 2 million tokens, however large the bucket is.
    """
    largest = F.pow(F.lit(2.0), F.col("_class") + 1)  # of the bucket's sets
    wide = F.greatest(F.lit(1), F.least(F.lit(BLOCK_SETS), F.floor(F.lit(BLOCK_TOKENS) / largest)))
    blocks = F.ceil(F.col("_n") / wide)
    own = F.pmod(F.xxhash64("_key", "_path"), blocks)
    placed = members.withColumn("_blocks", blocks).withColumn("_own", own)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_other")
    return placed.select(*members.columns, "_own", other).select(
        *members.columns,
        F.least("_own", "_other").alias("_low"),
        F.greatest("_own", "_other").alias("_high"),
        (F.col("_own") > F.col("_other")).alias("_second"),
    )


GROUP = ["_path", "_low", "_high"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches in which all groups are whole, and where each group begins; the last group may go on in the next batch."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = _joined([rest, batch])
        starts = _starts(batch)
        rest = batch.slice(starts[-1])
        if len(starts) > 1:
            yield batch.slice(0, starts[-1]), starts
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in GROUP]
    return np.concatenate([[0], 1 + np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], 0))])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(column.values), np.asarray(column.offsets)


def common_counts(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many values every two of the lists have in common, each list's values being different."""
    n = len(ends) - 1
    if n == 2:
        a, b = values[ends[0] : ends[1]], values[ends[1] : ends[2]]
        shared = len(set(a.tolist()).intersection(b.tolist()))
        return np.array([[len(a), shared], [shared, len(b)]])
    out = np.diag(np.diff(ends)).astype(np.float32)
    flat = values[ends[0] : ends[-1]]
    names, token, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[token] > 1
    column = (np.cumsum(times > 1) - 1)[token[keep]]
    row = np.repeat(np.arange(n), np.diff(ends))[keep]
    if not len(column):
        return out.astype(np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    np.fill_diagonal(out, 0)
    step, width = max(1, (1 << 21) // n), int(column[-1]) + 1
    for begin in range(0, width, step):
        i, j = np.searchsorted(column, [begin, begin + step])
        part = np.zeros((n, min(step, width - begin)), np.float32)
        part[row[i:j], column[i:j] - begin] = 1
        out += part @ part.T
    np.fill_diagonal(out, np.diff(ends))
    return out.astype(np.int64)  # counts below 2^24 are exact, and what is computed from them must be


def _first_meeting(paths: np.ndarray, ends: np.ndarray, here: int, pair: np.ndarray) -> np.ndarray:
    """Of the pairs, those that share no bucket with a smaller path, so that each pair is looked at in one bucket."""
    mine = paths[ends[0] : ends[-1]]
    below = mine < here
    ends = np.concatenate([[0], np.cumsum(below)])[ends - ends[0]]
    return pair & (common_counts(mine[below], ends) == 0) if ends[-1] else pair


def _pairs(second: np.ndarray, alone: bool) -> np.ndarray:
    """Which two rows of a group meet there: all in a group of one block (``alone``), else those of different blocks.

    A group of two blocks may have rows of one only, as the other can be empty; no two of them meet there.
    """
    n = len(second)
    pair = np.ones((n, n), bool) if alone else second[:, None] != second[None, :]
    np.fill_diagonal(pair, False)
    return pair


def _near(common: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    both = sizes[:, None] + sizes[None, :]
    return common * (1 + similarity) >= similarity * both - 1e-6


def _plausible(members: DataFrame, similarity: float) -> DataFrame:
    """The rows of groups that are similar to another by their sketches, and to none of them in an earlier bucket."""
    schema = T.StructType([members.schema[c] for c in [*GROUP, "_second", "_key"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in _groups(batches):
            sketch, sketch_ends = _lists(batch.column("_sketch"))
            paths, path_ends = _lists(batch.column("_paths"))
            second = batch.column("_second").to_numpy(zero_copy_only=False).astype(bool)
            here, sizes = batch.column("_path").to_numpy(), batch.column("_size").to_numpy()
            alone = batch.column("_low").to_numpy() == batch.column("_high").to_numpy()
            # Far fewer of the smallest shingles in common than similar sets have: some 6 standard deviations.
            least = similarity * SKETCH_COMMON
            keep = []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a < 2:
                    continue
                pair = _pairs(second[a:b], alone[a])
                few = np.diff(sketch_ends[a : b + 1])
                common = common_counts(sketch, sketch_ends[a : b + 1])
                small = np.minimum(few[:, None], few[None, :])
                like = sizes[a:b, None] >= similarity * sizes[None, a:b] - 1e-6
                pair &= (common >= least * small) & like & like.T
                if pair.any():
                    pair = _first_meeting(paths, path_ends[a : b + 1], int(here[a]), pair)
                    keep.append(a + np.flatnonzero(pair.any(1)))
            rows = np.concatenate(keep) if keep else np.zeros(0, np.int64)
            yield batch.select(schema.names).take(pa.array(rows))

    return in_batches(members, run, schema)


def _linked(members: DataFrame, similarity: float) -> DataFrame:
    """``(_key, _links, _root)``: of each row of a group, the documents it is similar to there, and the smallest key
    of those that are connected with it there."""
    schema = T.StructType([members.schema["_key"], T.StructField("_links", T.LongType()), T.StructField("_root", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, starts in _groups(batches):
            values, ends = _lists(batch.column("_set"))
            paths, path_ends = _lists(batch.column("_paths"))
            second = batch.column("_second").to_numpy(zero_copy_only=False).astype(bool)
            here, copies = batch.column("_path").to_numpy(), batch.column("_copies").to_numpy()
            alone = batch.column("_low").to_numpy() == batch.column("_high").to_numpy()
            keys = batch.column("_key").to_pylist()
            out = [], [], []
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a < 2:
                    continue
                sizes = np.diff(ends[a : b + 1])
                pair = _pairs(second[a:b], alone[a]) & _near(common_counts(values, ends[a : b + 1]), sizes, similarity)
                if not pair.any():
                    continue
                pair = _first_meeting(paths, path_ends[a : b + 1], int(here[a]), pair)
                links = pair @ copies[a:b]
                order = np.argsort(np.array(keys[a:b], object), kind="stable")
                label = np.empty(b - a, np.int64)
                label[order] = np.arange(b - a)
                while True:
                    lower = np.minimum(label, np.where(pair, label[None, :], b - a).min(1))
                    if (lower == label).all():
                        break
                    label = lower
                for i in np.flatnonzero(links):
                    out[0].append(keys[a + i])
                    out[1].append(int(links[i]))
                    out[2].append(keys[a + order[label[i]]])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], schema.names)

    return in_batches(members, run, schema)


def _classes(docs: DataFrame, id_column: str, text_column: str, words: int, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """The hashed rows, and for each key of theirs its copies, its name, its class's name and size, and its links.

    A name is the place of the smallest id in the order of ids, ``(none, id, mark)``, the mark being a hash of the text.
    """
    runs = runs_for(recall)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("_text"))
    hashed = settled(hashed_sets(rows, words, similarity, runs))
    named = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_mark").alias("mark")))
    sets = settled(
        hashed.groupBy("_key").agg(
            F.count(F.lit(1)).alias("_copies"),
            named.alias("_name"),
            *[F.first(c).alias(c) for c in ("_size", "_picks", "_sketch")],
        )
    )
    found = buckets(sets.where(F.col("_size") > 0), similarity, runs)
    paths = found.groupBy("_key").agg(F.collect_list("_path").alias("_paths"))  # as many as the runs sample
    about = settled(paths.join(sets.select("_key", "_size", "_copies", "_sketch"), "_key"))
    members = _in_blocks(found.join(about.drop("_copies"), "_key"))
    members = members.select(*GROUP, "_second", "_key", "_size", "_sketch", "_paths")
    likely = settled(_plausible(members.repartition(*GROUP).sortWithinPartitions(*GROUP), similarity))
    wanted = likely.select("_key").distinct().join(sets.select("_key", "_name"), "_key")
    wanted = wanted.select(F.col("_key"), F.col("_name.id").alias("_of"), F.col("_name.mark").alias("_with")).hint("shuffle_hash")
    again = rows.join(wanted, (F.col("_mark") == F.col("_with")) & same(F.col("_id"), F.col("_of")))
    tokens = shingle_rows(again.select("_key", "_text"), words).groupBy("_key").agg(F.first("_set").alias("_set"))
    full = likely.join(tokens, "_key").join(about.select("_key", "_copies", "_paths"), "_key")
    full = full.select(*GROUP, "_second", "_key", "_set", "_copies", "_paths")
    links = settled(_linked(full.repartition(*GROUP).sortWithinPartitions(*GROUP), similarity))
    classes = components(links, "_key", "_root").select(F.col("node").alias("_key"), F.col("root").alias("_class"))
    classed = sets.select("_key", "_copies", "_name").join(settled(classes), "_key")
    sums = classed.groupBy("_class").agg(F.min("_name").alias("_first"), F.sum("_copies").alias("_total"))
    classed = classed.select("_key", "_class").join(sums, "_class").drop("_class")
    counted = links.groupBy("_key").agg(F.sum("_links").alias("_links"))
    result = sets.select("_key", "_copies", "_name").join(classed, "_key", "left").join(counted, "_key", "left")
    return hashed, settled(
        result.select(
            "_key",
            F.coalesce("_first", "_name").alias("_first"),
            F.coalesce("_total", "_copies").alias("_total"),
            (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_links"),
        )
    )


def jaccard_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``docs``: ``(id_column, class_id, class_size, n_links)``.

    Documents are linked if the Jaccard similarity of their sets of ``words``-word shingles is at least
    ``similarity``; ``n_links`` counts them, copies too. Classes are the connected components of the links, named by
    their smallest id. A text of fewer words is one shingle; texts without words are equal to each other. Null texts
    have no words. Null ids come after all others as a name, and rows that repeat id and text count separately.
    Other columns are not read.

    Copies (equal sets) are one set from the start. Sets go to the buckets of their chosen paths (`buckets`), in as many
    runs as the target ``recall`` of pairs at the least similarity needs. Buckets are compared by brute force in
    blocks (`_in_blocks`): first by the 48 smallest hashes of each set, then, where that leaves a pair, by the sets, of which
    only those are read again. Every pair is compared in the smallest of the buckets that both are in, so pairs
    are neither written nor counted twice; a bucket gives one row per set, its links and a connected set.
    """
    hashed, about = _classes(docs, id_column, text_column, words, similarity, recall)
    about = about.select("_key", F.col("_first.id").alias("class_id"), F.col("_total").alias("class_size"), F.col("_links").alias("n_links"))
    return hashed.select(F.col("_id").alias(id_column), "_key").join(about, "_key").drop("_key")


def drop_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """``docs`` with one row of each class of `jaccard_classes`: that with the smallest id.

    Of rows that share this id, the one with the smallest hash of its text stays, and of equal ones, one.
    """
    _, about = _classes(docs, id_column, text_column, words, similarity, recall)
    stay = about.select(F.col("_first.id").alias("_of"), F.col("_first.mark").alias("_with")).distinct().hint("shuffle_hash")
    mark = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    marked = packed(docs, F.col(id_column).alias("_id"), mark.alias("_mark"))
    kept = marked.join(stay, (F.col("_mark") == F.col("_with")) & same(F.col("_id"), F.col("_of")))
    return kept.dropDuplicates(["_with", "_of"]).select("_row.*")
