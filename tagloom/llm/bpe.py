"""Byte-level BPE by forced cuts: a byte pair that no token has inside can only lie between two tokens."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, text_column as text_array, utf8

#: What a task remembers of fragments and their ids, in bytes, besides those of the slice at hand; beyond it the older
#: half is forgotten and encoded again.
KEPT_BYTES = 96 << 20
#: Longer fragments are not remembered. An entry is counted with what Python needs for two short byte strings and a place.
KEPT_LENGTH, _ENTRY = 48, 200
_SLICE, _CALL = 100_000, 4096
# The white space of more than one byte in UTF-8.
_WIDE_SPACES = [c.encode() for c in "\u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"]
# What an apostrophe takes with it as one word.
_CONTRACTED = ["s", "t", "re", "ve", "m", "ll", "d"]


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, and back."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encodes and decodes batches with one tokenizer file."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        told = json.loads(spec)
        before, after = told["pre_tokenizer"] or {}, told["decoder"] or {}
        plain = told["normalizer"] is None and told["post_processor"] is None and not before.get("add_prefix_space")
        if told["model"]["type"] != "BPE" or not {before.get("type"), after.get("type")} == {"ByteLevel"} or not plain:
            raise ValueError("a byte-level BPE without prefix space, normalizer and post-processor is needed")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        tokens = {i: bytes(alphabet[c] for c in t) for t, i in told["model"]["vocab"].items()}
        if any(t.get(x) for t in told["added_tokens"] for x in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that take white space with them or stand for whole words only are not supported")
        added = {t["id"]: t["content"].encode() for t in told["added_tokens"]}
        self.added = re.compile(b"|".join(map(re.escape, added.values()))) if added else None
        self._learn_cuts(tokens.values())
        tokens |= added
        self.lengths = np.zeros(max(tokens) + 1, np.int64)
        for i, t in tokens.items():
            self.lengths[i] = len(t)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(self.lengths))), np.uint8)
        self.known: dict[bytes, bytes] = {}
        self.known_bytes = 0

    def _learn_cuts(self, tokens) -> None:
        """Pairs that are certain cuts, and do not change how the sides are split into words.

        The left byte ends a character that is no white space: white space is split by what follows it. The right byte
        begins a character, and is no apostrophe, which reads differently at the start of a text. Nor is anything
        cut that an apostrophe may take with it.
        """
        cut = np.ones((256, 256), bool)
        for t in tokens:
            pairs = np.frombuffer(t, np.uint8)
            cut[pairs[:-1], pairs[1:]] = False
        cut[:, 0x80:0xC2] = cut[:, ord("'")] = False
        cut[:0x21] = cut[0x7F] = cut[0xC0:] = False
        for word in _CONTRACTED:
            for left, right in zip(f"'{word}", word):
                cut[ord(left), ord(right)] = False
        self.cut = cut.ravel()
        # A character of several bytes is white space if its last three bytes, or two, are one of these numbers.
        self.wide = {n: np.array(sorted(int.from_bytes(w) for w in _WIDE_SPACES if len(w) == n)) for n in (2, 3)}

    def cuts(self, data: np.ndarray, raw: bytes) -> np.ndarray:
        """Where ``data`` may be cut, as positions of the byte after the cut."""
        if len(data) < 2:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.cut[(data[:-1].astype(np.uint16) << 8) | data[1:]]) + 1
        for found in self.added.finditer(raw) if self.added else ():
            inside = slice(*np.searchsorted(at, [found.start() + 1, found.end()]))
            at = np.delete(at, inside)
        wide = np.flatnonzero(data[at - 1] >= 0x80)
        if len(wide):
            end = at[wide]
            two = (data[end - 2].astype(np.int64) << 8) | data[end - 1]
            three = (data[np.maximum(end - 3, 0)].astype(np.int64) << 16) | two
            at = np.delete(at, wide[np.isin(two, self.wide[2]) | np.isin(three, self.wide[3])])
        return at

    def _learn(self, fragments: list[bytes]) -> None:
        """Remember the ids of fragments, by the library, some thousand in a call."""
        for i in range(0, len(fragments), _CALL):
            some = fragments[i : i + _CALL]
            texts = [f.decode(errors="replace") for f in some]
            for f, found in zip(some, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
                ids = array("i", found.ids).tobytes()
                self.known[f] = ids
                self.known_bytes += _ENTRY + len(f) + len(ids)

    def _forget(self, fragments: list[bytes]) -> None:
        """Forget the long ones of fragments just learned, and the older half of all if they are too many."""
        long = [f for f in fragments if len(f) > KEPT_LENGTH]
        while long or self.known_bytes > KEPT_BYTES:
            for f in long or list(self.known)[: len(self.known) // 2 + 1]:
                self.known_bytes -= _ENTRY + len(f) + len(self.known.pop(f))
            long = []

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids begin."""
        raw = data.tobytes()
        begins = np.zeros(len(data) + 1, bool)
        begins[self.cuts(data, raw)] = begins[offsets] = True
        at = np.flatnonzero(begins)
        packed, counts = [], [np.zeros(1, np.int64)]
        for i in range(0, len(at) - 1, _SLICE):
            ends = at[i : i + _SLICE + 1].tolist()
            fragments = [raw[a:b] for a, b in zip(ends, ends[1:])]
            parts = list(map(self.known.get, fragments))
            missing = [n for n, ids in enumerate(parts) if ids is None]
            new = list(dict.fromkeys([fragments[n] for n in missing]))
            self._learn(new)
            for n in missing:
                parts[n] = self.known[fragments[n]]
            self._forget(new)
            counts.append(np.fromiter(map(len, parts), np.int64, len(parts)) // 4)
            packed.append(b"".join(parts))
        ids = np.frombuffer(b"".join(packed), "<i4")
        return ids, np.cumsum(np.concatenate(counts))[np.searchsorted(at, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all texts, and where each text begins; ids that are no token give nothing."""
        ids = np.where((ids >= 0) & (ids < len(self.lengths)), ids, -1)
        length = np.where(ids < 0, 0, self.lengths[ids])
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
        out = []
        for i in range(0, len(ids), _SLICE):
            n = length[i : i + _SLICE]
            first = np.repeat(self.starts[ids[i : i + _SLICE]] - (np.cumsum(n) - n), n)
            out.append(self.bytes[first + np.arange(len(first))].tobytes())
        return b"".join(out), ends[offsets]


@lru_cache(maxsize=2)
def _codec(spec: str) -> Codec:
    return Codec(spec)


def _map(df: DataFrame, path: str, fields: list[T.StructField], add) -> DataFrame:
    """``df`` with the columns that ``add(codec, batch)`` gives for each batch."""
    with open(path, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: some MB, whatever the data
    names = [f.name for f in fields]
    kept = [c for c in df.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *add(codec, batch)], [*kept, *names])

    return in_batches(df, run, T.StructType([*[df.schema[c] for c in kept], *fields]))


def _encoded(codec: Codec, column) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    ids, offsets = codec.encode(*utf8(column))
    return ids, offsets, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))


IDS = T.ArrayType(T.IntegerType())


def bpe_encode(docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole text, as the tokenizer file at ``path`` gives them.

    Texts are cut at byte pairs that no token of the vocabulary has inside, so no merge crosses a cut; the
    fragments, mostly words with the space before them, in scripts that few tokens have single characters, are encoded
    independently and their ids put in a row. Each task remembers short fragments up to `KEPT_BYTES`. The names of
    added tokens in a text are those tokens, as in the library. Null or empty texts have no ids; a text without
    any cut is one fragment, encoded whole and not remembered. Other columns
    pass through; a column with the name of the ids is replaced. The file is read by the driver only.
    """
    return _map(
        docs, path, [T.StructField(ids_column, IDS)], lambda codec, batch: [_encoded(codec, batch.column(text_column))[2]]
    )


def bpe_decode(df: DataFrame, path: str, ids_column: str = "ids", decoded_column: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids; null gives an empty text, ids that are no token give nothing."""

    def add(codec: Codec, batch: pa.RecordBatch):
        ids = batch.column(ids_column).fill_null([])
        offsets = np.asarray(ids.offsets, np.int64)
        flat = np.asarray(ids.values.fill_null(-1), np.int32)[offsets[0] : offsets[-1]]
        return [text_array(*codec.decode(flat, offsets - offsets[0]))]

    return _map(df, path, [T.StructField(decoded_column, T.StringType())], add)


def bpe_round_trip(
    docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids", decoded_column: str = "decoded"
) -> DataFrame:
    """`bpe_encode` and `bpe_decode` of its ids in one pass over the batches."""

    def add(codec: Codec, batch: pa.RecordBatch):
        ids, offsets, column = _encoded(codec, batch.column(text_column))
        return [column, text_array(*codec.decode(ids, offsets))]

    return _map(docs, path, [T.StructField(ids_column, IDS), T.StructField(decoded_column, T.StringType())], add)
