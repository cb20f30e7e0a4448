"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, settled

PRIME = (1 << 31) - 1
BASES = (1_000_003, 754_974_721)  # windows have the first; whole texts and extensions both
WINDOW, SLOTS = 24, 64
_PIECE = 1 << 18  # code points whose products are computed together, in 8 bytes each


def _pieces(n: int) -> Iterator[slice]:
    return (slice(i, min(i + _PIECE, n)) for i in range(0, n, _PIECE))


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` below 2^63 modulo the Mersenne prime 2^31 - 1, without division."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


class Powers:
    """The powers of a base, as many as the longest text so far needs, in 4 bytes each."""

    def __init__(self, base: int):
        self.base, self.up = base, np.ones(1, np.uint32)

    def first(self, n: int) -> np.ndarray:
        known = len(self.up)
        if known < n:
            up = np.empty(n, np.uint32)
            up[:known] = self.up
            while known < n:
                # The powers so far, at most a piece of them, times the power that comes next.
                step = pow(self.base, known, PRIME)
                more = min(known, n - known, _PIECE)
                up[known : known + more] = _mod(up[:more].astype(np.int64) * step)
                known += more
            self.up = up
        return self.up[:n]


POWERS = [Powers(b) for b in BASES]
INVERSES = [Powers(pow(b, -1, PRIME)) for b in BASES]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """The prefix array of a text: ``hashes[i]`` is the sum over j < i of ``points[j] * base ** j``.

    The span from i to j has ``hashes[j] - hashes[i]``, which is its own hash times ``base ** i``. So spans of
    equal length are compared after multiplying each by the other's power, and any span in constant time.
    """

    def __init__(self, points: np.ndarray, which: int = 0):
        n = len(points)
        self.n, self.powers, self.inverses = n, POWERS[which], INVERSES[which]
        up = self.powers.first(n)
        # In 4 bytes each; a piece's terms below 2^31 add up to less than 2^50.
        self.hashes = np.zeros(n + 1, np.uint32)
        before = 0
        for at in _pieces(n):
            sums = np.cumsum(_mod((points[at].astype(np.int64) + 1) * up[at])) + before
            self.hashes[at.start + 1 : at.stop + 1] = sums = _mod(sums)
            before = int(sums[-1])

    def span(self, start: int, end: int, at: int) -> int:
        """The hash of a span, as if it began at position ``at``, which is not before ``start``."""
        shift = int(self.powers.first(at + 1)[at - start])
        return (int(self.hashes[end]) - int(self.hashes[start])) % PRIME * shift % PRIME

    def windows(self, size: int) -> np.ndarray:
        """The hash of each span of ``size`` code points, independent of where it lies."""
        count = max(0, self.n - size + 1)
        back, out = self.inverses.first(count), np.empty(count, np.uint32)
        for at in _pieces(count):
            here = self.hashes[at.start + size : at.stop + size].astype(np.int64) - self.hashes[at]
            out[at] = _mod(np.where(here < 0, here + PRIME, here) * back[at])
        return out


Hashed = tuple[PrefixHashes, ...]


def hashed(points: np.ndarray) -> Hashed:
    """The prefix arrays of a text for both bases."""
    return tuple(PrefixHashes(points, which) for which in range(len(BASES)))


def spans_equal(a: Hashed, i: int, b: Hashed, j: int, length: int) -> bool:
    """Are the ``length`` code points of ``a`` from i those of ``b`` from j? Wrong with chance (length / 2^31)^2."""
    at = max(i, j)
    return all(x.span(i, i + length, at) == y.span(j, j + length, at) for x, y in zip(a, b))


def common_extension(a: Hashed, i: int, b: Hashed, j: int) -> int:
    """How many code points ``a`` from i and ``b`` from j have in common, by binary search over the length."""
    low, high = 0, min(a[0].n - i, b[0].n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _smallest(hashes: np.ndarray, slots: int) -> np.ndarray:
    """The ``slots`` smallest different values, sorted."""
    if len(hashes) > 8 * slots:
        for spread in (4, 64):
            few = hashes[hashes <= PRIME * spread * slots // len(hashes)]
            found = np.unique(few)
            if len(found) >= slots:
                return found[:slots]
    return np.unique(hashes)[:slots]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes in an order that has nothing to do with the polynomial, below 2^31."""
    out = np.empty(len(hashes), np.uint32)
    for at in _pieces(len(hashes)):
        x = (hashes[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out[at] = x >> np.uint64(33)
    return out


class Fingerprint:
    """The hash of the whole text and its smallest window hashes."""

    def __init__(self, length: int, windows: np.ndarray, hashes: tuple[int, int], slots: int = SLOTS):
        self.length, self.whole = length, np.array(hashes, ">u4").tobytes()
        self.slots, self.few = slots, _smallest(windows, slots)

    def __bytes__(self) -> bytes:
        return self.whole + self.few.astype(">u4").tobytes()

    def __str__(self) -> str:
        return f"{self.length:x}-{self.whole.hex()}-{bytes(self)[8:].hex()}"

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal texts, else the share of the smallest windows of both that both have: their Jaccard similarity."""
        if (self.length, self.whole) == (other.length, other.whole):
            return 1.0
        both = np.union1d(self.few, other.few)[: self.slots]
        common = np.intersect1d(self.few, other.few, assume_unique=True)
        return float(np.isin(both, common, assume_unique=True).sum() / len(both)) if len(both) else 0.0


class Text:
    """A text with its prefix array, its windows and its fingerprint."""

    def __init__(self, text: str, window: int = WINDOW, slots: int = SLOTS):
        self.text, self.points, self.size, self.slots = text, code_points(text), window, slots
        self.prefix = hashed(self.points)
        self.windows = _mixed(self.prefix[0].windows(window))
        whole = tuple(int(p.hashes[-1]) for p in self.prefix)
        self.fingerprint = Fingerprint(len(self.points), self._or_whole(self.windows, whole[0]), whole, slots)

    def _or_whole(self, windows: np.ndarray, whole: int) -> np.ndarray:
        # A text shorter than a window is its own window; an empty one has none.
        return windows if len(windows) or not whole else _mixed(np.array([whole], np.uint32))

    def followed_by(self, keep: int, other: Text, take: int) -> Fingerprint:
        """The fingerprint of the first ``keep`` code points and then the first ``take`` of ``other``.

        The windows of both parts are known; only those across the seam are hashed anew.
        """
        w = self.size
        start, end = max(0, keep - w + 1), min(take, w - 1)
        seam = PrefixHashes(np.concatenate([self.points[start:keep], other.points[:end]])).windows(w)
        windows = [self.windows[: max(0, keep - w + 1)], _mixed(seam), other.windows[: max(0, take - w + 1)]]
        whole = tuple(
            (int(a.hashes[keep]) + int(b.hashes[take]) * int(a.powers.first(keep + 1)[keep])) % PRIME
            for a, b in zip(self.prefix, other.prefix)
        )
        return Fingerprint(keep + take, self._or_whole(np.concatenate(windows), whole[0]), whole, self.slots)


# Digests travel as bytes, a half of their hexadecimal digits.
RESULT = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.BinaryType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("edited_chars", T.LongType()),
        T.StructField("edited_fingerprint", T.BinaryType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("common_prefix", T.LongType()),
    ]
)
KINDS = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary()}


def _written(fingerprint: str, length: str) -> Column:
    digits = F.lower(F.hex(fingerprint))
    return F.concat(F.lower(F.hex(length)), F.lit("-"), digits.substr(1, 16), F.lit("-"), F.substring(digits, 17, 1 << 30))


def _compared(own: Text, after: Text) -> tuple:
    """The result columns of a text and the one after it."""
    n = len(own.points)
    half = n // 2
    take = min(half, len(after.points))
    edited = own.followed_by(n - half, after, take)
    digest = sha256((own.text[: n - half] + after.text[:take]).encode("utf-8", "replace")).digest()
    return (
        n,
        digest,
        bytes(own.fingerprint),
        edited.length,
        bytes(edited),
        own.fingerprint.likeness(edited),
        own.fingerprint.likeness(after.fingerprint),
        # The edited text is this one up to the seam, and from there what both still have in common.
        n - half + common_extension(own.prefix, n - half, after.prefix, 0) if take else n - half,
    )


def fingerprint_chain(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: its id, and the columns of `RESULT`, digests as hexadecimal text.

    The fingerprint is the text's length, two polynomial hashes of the whole and its ``slots`` smallest hashes
    of windows of ``window`` code points; ``near_*`` is 1 for equal texts and else the Jaccard similarity of the
    window sets, estimated from two fingerprints. The edited text is the first half (rounded up) followed by as
    many code points of the next text, in order of id, null ids last, and for one id by a hash of the
    text; after the last comes the
    first. Its fingerprint takes the windows of both parts as they are. ``common_prefix`` is how long text and
    edited text agree. Null texts are empty; two empty texts are equal. Other columns are not read.

    A text takes some 20 bytes for each code point besides itself, and so do the powers that a worker keeps for the
    longest text so far: two texts of 20 million code points need about 1 GB.

    Texts are shuffled once, into ranges of ids. A task holds two texts at a time. Where its range ends it
    writes its first and last text to a table, two rows per task, from which the pairs across ranges are made.
    """
    place = ["_none", "_id", "_hash"]
    rows = docs.select(
        F.col(id_column).isNull().alias("_none"), F.col(id_column).alias("_id"), F.coalesce(text_column, F.lit("")).alias("_text")
    ).withColumn("_hash", F.xxhash64("_text"))
    edge = [T.StructField("_part", T.IntegerType()), T.StructField("_edge", T.StringType()), T.StructField("_text", T.StringType())]
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), *RESULT.fields, *edge])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, arrow = TaskContext.get().partitionId(), None, None
        empty = (None,) * len(RESULT)

        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*found), arrow)] if found else [pa.array([], f.type) for f in arrow], schema=arrow
            )

        for batch in batches:
            if arrow is None:
                arrow = pa.schema([batch.schema.field("_id"), *[pa.field(f.name, KINDS[f.dataType.simpleString()]) for f in schema.fields[1:]]])
            found = []
            for key, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                now = (key, Text(text, window, slots))
                if before is None:
                    found.append((key, *empty, part, "first", text))
                else:
                    found.append((before[0], *_compared(before[1], now[1]), None, None, None))
                before = now
            yield batch_of(found)
        if before is not None:
            yield batch_of([(before[0], *empty, part, "last", before[1].text)])

    ranged = rows.repartitionByRange(*place).sortWithinPartitions(*place, "_text").select("_id", "_text")
    done = settled(in_batches(ranged, run, schema))
    firsts = done.where(F.col("_edge") == "first").select(F.col("_part").alias("_of"), F.col("_text").alias("_next"))
    around = W.orderBy("_of")  # one row per task
    places = firsts.select("_of").select(
        "_of", F.lead("_of").over(around).alias("_then"), F.min("_of").over(W.partitionBy()).alias("_start")
    )
    lasts = done.where(F.col("_edge") == "last").select("_id", "_part", "_text")
    seams = lasts.join(places, lasts["_part"] == places["_of"]).select("_id", "_text", F.coalesce("_then", "_start").alias("_at"))
    seams = seams.join(firsts, seams["_at"] == firsts["_of"]).select("_id", "_text", "_next")
    out = T.StructType([schema.fields[0], *RESULT.fields])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("_text").to_pylist(), batch.column("_next").to_pylist())
            found = [_compared(Text(a, window, slots), Text(b, window, slots)) for a, b in pairs]
            columns = list(zip(*found)) or [()] * len(RESULT)
            arrays = [pa.array(c, KINDS[f.dataType.simpleString()]) for c, f in zip(columns, RESULT.fields)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *arrays], out.names)

    whole = done.where(F.col("_edge").isNull()).select(*out.names)
    return whole.unionByName(in_batches(seams, finish, out)).select(
        F.col("_id").alias(id_column),
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        _written("fingerprint", "n_chars").alias("fingerprint"),
        _written("edited_fingerprint", "edited_chars").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "common_prefix",
    )
