"""Sets of word shingles as 64-bit hashes, in numpy, for many texts at once."""

from __future__ import annotations

import numpy as np

from tagloom.llm.common import SPACES

WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True
_random = np.random.default_rng(20)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_PLACES = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """All bits of each number spread over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    up = np.ones(1, np.uint64)

    @classmethod
    def first(cls, n: int) -> np.ndarray:
        while len(cls.up) < n:
            cls.up = np.concatenate([cls.up, cls.up * (cls.up[-1:] * _BASE)])
        return cls.up


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins, its hash, and the number of the first word of each text. White space parts words."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if not len(data):
        return none
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A text's first byte begins a word even if the text before ended with one.
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] |= inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return none
    span = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, span)
    terms = _BYTE[data[starts[0] :]]
    # Spaces are 0, so a word's sum may run on to the next word. Its length sets it apart from what is like it.
    value = np.add.reduceat(terms * _Powers.first(int(span.max()))[place], starts - starts[0])
    length = np.add.reduceat(inside[starts[0] :].astype(np.uint64), starts - starts[0])
    return starts, mixed(value + length * _PLACES[-1]), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text, sorted, and where each text's begin.

    A shingle is ``words`` words in a row, words being what lies between white space. A text of fewer words is
    one shingle of all of them, a text without words has none.
    """
    texts = len(offsets) - 1
    _, word, at = word_hashes(data, offsets)
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    counts = np.diff(at)
    # Rows of words: a full shingle begins at each word but a text's last ones; a short text is one row.
    rows = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(texts), rows)
    head = at[of] + np.arange(len(of)) - np.repeat(np.cumsum(rows) - rows, rows)
    length = np.minimum(counts[of], words)
    total = length.astype(np.uint64)
    padded = np.concatenate([word, np.zeros(words, np.uint64)])
    for k in range(words):
        total += np.where(k < length, padded[head + k] * _PLACES[k], np.uint64(0))
    hashed = mixed(total)
    order = np.lexsort((hashed, of))
    hashed, of = hashed[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (of[1:] != of[:-1])
    hashed, of = hashed[new], of[new]
    return hashed, np.searchsorted(of, np.arange(texts + 1))


def text_parts(offsets: np.ndarray, size: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes each, so that the arrays made of them stay small."""
    parts, i = [], 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        parts.append((i, j))
        i = j
    return parts
