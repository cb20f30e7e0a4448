"""Text quality from overlapping heuristics, weighed by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, uniform, utf8
from tagloom.llm.shingles import mixed, text_parts, word_hashes

# What a heuristic measures: below the first bound it votes good, above the second bad, else not at all.
HEURISTICS = {
    "symbols per character": (0.02, 0.08),
    "upper-case letters per ASCII letter": (0.15, 0.5),
    "words equal to the one before": (0.05, 0.25),
    "words without any letter": (0.05, 0.2),
    "words that end a sentence": (0.3, 0.6),
    "repeated words, in windows of 200": (0.6, 0.85),  # see `WINDOW`
    "digits per character": (0.1, 0.5),
    "words that end in a symbol": (0.1, 0.4),
}
WINDOW = 200  # words that are compared with each other; the mean over all windows does not depend on a text's length
FEWEST_WORDS = 8  # shares of fewer words say nothing, and all heuristics are silent
NO_WORDS = -1  # instead of votes
GOOD, BAD, SILENT = 0, 1, 2
SAMPLE = 1500  # documents of either label that the scorer learns from, about
KEEP = 0.25  # a text goes only if the scorer is rather sure that it is bad
DOUBT = 10  # words that are added to a text's number of words
BITS = 12  # of the hashed features of each of the three families
STEPS = 150

_KIND = np.zeros(256, np.uint8)  # bits: lower, upper, digit, sentence end, other punctuation, symbol, not ASCII
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 4
for _chars, _bit in ((".!?", 8), (",;:'\"()-", 16), ("#$%&*+/<=>@[\\]^_`{|}~", 32)):
    _KIND[[ord(c) for c in _chars]] = _bit
_KIND[0x80:] = 64
_LETTERS = 1 | 2 | 64


class Words:
    """The words of many texts: kinds of characters, hashes and owners."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.texts = len(offsets) - 1
        starts, self.hashes, at = word_hashes(data, offsets)
        self.first, self.counts = at[:-1], np.diff(at)
        self.of = np.repeat(np.arange(self.texts), self.counts)
        kind = _KIND[data]
        self.kinds = np.bitwise_or.reduceat(kind, starts) if len(starts) else np.zeros(0, np.uint8)
        ends = np.append(starts[1:], len(data)) - 1 if len(starts) else starts
        # The last byte before the next word may be white space; step back over it.
        while len(ends) and (blank := _is_blank(data, ends, starts)).any():
            ends = ends - blank
        self.last = kind[ends] if len(ends) else np.zeros(0, np.uint8)
        self.same = np.zeros(len(self.of), bool)
        self.same[1:] = (self.hashes[1:] == self.hashes[:-1]) & (self.of[1:] == self.of[:-1])
        text = np.repeat(np.arange(self.texts), np.diff(offsets))
        bits = [np.bincount(text[(kind & bit) > 0], minlength=self.texts) for bit in (1, 2, 4, 32, 127)]
        self.lower, self.upper, self.digits, self.symbols, self.characters = bits

    def per_text(self, flag: np.ndarray) -> np.ndarray:
        return np.bincount(self.of[flag], minlength=self.texts)

    def measures(self) -> np.ndarray:
        """`HEURISTICS` of each text, as columns."""
        words, characters = np.maximum(self.counts, 1), np.maximum(self.characters, 1)
        place = np.arange(len(self.of)) - (self.first[self.of] if len(self.of) else 0)
        window = np.cumsum(place % WINDOW == 0)  # the texts' words follow each other
        order = np.lexsort((self.hashes, window))
        h, w = self.hashes[order], window[order]
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (w[1:] == w[:-1])
        return np.stack(
            [
                self.symbols / characters,
                self.upper / np.maximum(self.upper + self.lower, 1),
                self.per_text(self.same) / words,
                self.per_text((self.kinds & _LETTERS) == 0) / words,
                self.per_text(self.last == 8) / words,
                np.bincount(self.of[order][again], minlength=self.texts) / words,
                self.digits / characters,
                self.per_text(self.last == 32) / words,
            ],
            1,
        )

    def votes(self) -> np.ndarray:
        """Each text's votes as one number, base 3, or `NO_WORDS`."""
        low, high = np.array(list(HEURISTICS.values())).T
        measures = self.measures()
        vote = np.where(measures < low, GOOD, np.where(measures > high, BAD, SILENT))
        vote[self.counts < FEWEST_WORDS] = SILENT
        return np.where(self.counts > 0, vote @ 3 ** np.arange(len(HEURISTICS)), NO_WORDS)

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashed features as (text, feature, share of the text's words): words, their kinds, pairs of kinds.

        The shares of a text of a few words are small, so that its score stays near that of no features.
        """
        following = np.append(self.kinds[1:] * (self.of[1:] == self.of[:-1]), np.uint8(0))[: len(self.of)]
        repeated = np.append(self.same[1:], False)[: len(self.of)]
        kinds = self.kinds.astype(np.uint64) * np.uint64(128) + self.last
        pairs = kinds * np.uint64(512) + following.astype(np.uint64) * np.uint64(2) + repeated
        families = [self.hashes, mixed(kinds + np.uint64(1)), mixed(pairs + np.uint64(1 << 40))]
        columns = [(f >> np.uint64(64 - BITS)).astype(np.int64) + (i << BITS) for i, f in enumerate(families)]
        of = np.tile(self.of, 3)
        return of, np.concatenate(columns), (1.0 / (self.counts + DOUBT))[of]


def _is_blank(data: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    value = data[ends]
    return (((value >= 9) & (value <= 13)) | (value == 32)) & (ends > starts)


class LabelModel:
    """How often each heuristic votes what on good and on bad texts, and how many texts are bad."""

    def __init__(self, counts: dict[int, int], steps: int = 100):
        """Expectation-maximisation over the counts of all combinations of votes.

        It starts from a text with any bad vote being bad, which also says which of the two classes is which.
        """
        self.counts = dict(counts)
        patterns = np.arange(3 ** len(HEURISTICS))
        n = np.array([counts.get(p, 0) for p in patterns.tolist()], float)
        votes = patterns[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3
        n[(votes == SILENT).all(1)] = 0
        bad = np.where((votes == BAD).any(1), 0.9, 0.1)
        for _ in range(steps):
            weight = np.stack([1 - bad, bad], 1) * n[:, None]
            self.prior = (weight.sum(0) + 1) / (weight.sum() + 2)
            self.chances = np.stack([(weight.T @ (votes == v)) for v in range(3)], -1) + 0.1
            self.chances /= self.chances.sum(-1, keepdims=True)
            # Silence of all is no evidence; of one it is, as heuristics are silent on purpose.
            logs = sum(np.log(self.chances[:, k, votes[:, k]]).T for k in range(len(HEURISTICS))) + np.log(self.prior)
            bad = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
            bad[(votes == SILENT).all(1)] = self.prior[1]
        #: The chance that a text with these votes is bad; the last one, at `NO_WORDS`, is 1.
        self.bad = np.append(bad, 1.0)


def _mapped(df: DataFrame, names: list[str], fields: list[T.StructField], add, text: str = "_text") -> DataFrame:
    """The columns ``names`` and those that ``add(words)`` gives, about 1 MB of text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            for i, j in text_parts(offsets):
                arrays = add(Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                kept = [batch.column(c).slice(i, j - i) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], [*names, *[f.name for f in fields]])

    return in_batches(df, run, T.StructType([*[df.schema[c] for c in names], *fields]))


_VOTES = T.StructField("_votes", T.IntegerType())


def fit_label_model(docs: DataFrame, text_column: str = "text") -> LabelModel:
    """The label model of all texts; the driver gets the counts of at most 3 ** 8 combinations of votes."""
    texts = docs.select(F.col(f"`{text_column}`").alias("_text"))
    votes = _mapped(texts, [], [_VOTES], lambda words: [pa.array(words.votes().astype(np.int32))])
    return LabelModel({r["_votes"]: r["n"] for r in votes.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).collect()})


class Scorer:
    """A linear function of hashed features, with a sigmoid: the chance that a text is good."""

    def __init__(self):
        self.weights, self.bias = np.zeros(3 << BITS), 0.0

    def train(self, of: np.ndarray, features: np.ndarray, shares: np.ndarray, good: np.ndarray, ridge: float = 1e-4) -> None:
        """Adam on the cross-entropy with the posterior labels, both classes weighing the same."""
        weight = np.where(good >= 0.5, 0.5 / max((good >= 0.5).sum(), 1), 0.5 / max((good < 0.5).sum(), 1))
        params, first, second = np.zeros(len(self.weights) + 1), 0.0, 0.0
        for step in range(1, STEPS + 1):
            self.weights, self.bias = params[:-1], params[-1]
            error = (self._sigmoid(of, features, shares, len(good)) - good) * weight
            grad = np.append(np.bincount(features, error[of] * shares, len(self.weights)), error.sum())
            grad[:-1] += ridge * self.weights / len(self.weights)
            first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
            params = params - 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        self.weights, self.bias = params[:-1], params[-1]

    def _sigmoid(self, of, features, shares, texts) -> np.ndarray:
        total = np.bincount(of, self.weights[features] * shares, texts) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))

    def score(self, words: Words) -> np.ndarray:
        return np.where(words.counts > 0, self._sigmoid(*words.features(), words.texts), 0.0)


def fit_scorer(docs: DataFrame, model: LabelModel, text_column: str = "text", sample: int = SAMPLE, seed: int = 0) -> Scorer:
    """A scorer learned from the posterior labels of a bounded sample.

    About ``sample`` texts that the label model calls good and as many bad ones are chosen by a hash of the text,
    with a rate that follows from the counts of all, so that their hashed features fit on the driver. The counts are
    those that ``model`` was fitted on, which must be of the same texts.
    """
    texts = docs.select(F.col(f"`{text_column}`").alias("_text"), uniform(F.lit(seed), F.col(f"`{text_column}`")).alias("_luck"))
    bad = model.bad
    spoken = {votes: n for votes, n in model.counts.items() if votes != NO_WORDS}
    totals = [sum(n for votes, n in spoken.items() if (bad[votes] >= 0.5) == side) for side in (False, True)]
    rates = [min(1.0, sample / max(1, t)) for t in totals]
    fields = [_VOTES, T.StructField("_features", T.ArrayType(T.IntegerType())), T.StructField("_shares", T.ArrayType(T.FloatType()))]

    def add(words: Words) -> list[pa.Array]:
        of, features, shares = words.features()
        merged, total = np.unique(of * (3 << BITS) + features, return_inverse=True)
        ends = np.searchsorted(merged // (3 << BITS), np.arange(words.texts + 1)).astype(np.int32)
        summed = np.bincount(total, shares, len(merged)).astype(np.float32)
        return [
            pa.array(words.votes().astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array((merged % (3 << BITS)).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(summed)),
        ]

    likely = texts.where(F.col("_luck") < max(rates))
    chosen = _mapped(likely, ["_luck"], fields, add)
    rate = F.when(F.col("_votes").isin([p for p in range(len(bad) - 1) if bad[p] >= 0.5]), rates[1]).otherwise(rates[0])
    rows = chosen.where((F.col("_luck") < rate) & (F.col("_votes") != NO_WORDS)).orderBy("_luck").limit(4 * sample).collect()
    scorer = Scorer()
    if rows:
        of = np.repeat(np.arange(len(rows)), [len(r["_features"]) for r in rows])
        features = np.array([x for r in rows for x in r["_features"]], np.int64)
        shares = np.array([x for r in rows for x in r["_shares"]])
        scorer.train(of, features, shares, np.array([1 - bad[r["_votes"]] for r in rows]))
    return scorer


def score_quality(docs: DataFrame, model: LabelModel, scorer: Scorer, text_column: str = "text") -> DataFrame:
    """``docs`` with ``quality``, the scorer's chance that the whole text is good, and ``weak_label``, the label model's.

    Null and empty texts, and those of white space only, have 0 for both. Other columns pass through; columns with
    the names of the results are replaced.
    """
    fields = [T.StructField("quality", T.DoubleType()), T.StructField("weak_label", T.DoubleType())]
    kept = [c for c in docs.columns if c not in ("quality", "weak_label")]
    both = docs.sparkSession.sparkContext.broadcast((scorer, model.bad))  # some 100 kB

    def add(words: Words) -> list[pa.Array]:
        scorer, bad = both.value
        return [pa.array(scorer.score(words)), pa.array(1 - bad[words.votes()])]

    return _mapped(docs.select(*[F.col(f"`{c}`") for c in kept]), kept, fields, add, text_column)
