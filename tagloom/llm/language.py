"""Language identification by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, uniform, unused, utf8

WINDOW = 128  # bytes
WIDTHS, FILTERS = (2, 3, 4), 16
# Bounds of the sample that is learned from: documents per language, windows of each, and documents of all languages
# together, of which each has its part but never less than the last number.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS, SAMPLE_TOTAL, SAMPLE_LEAST = 400, 4, 40_000, 20
# Steps for up to 32 languages; in proportion for more.
STEPS, STEPS_LANGUAGES, BATCH, RATE = 400, 32, 128, 0.01
UNKNOWN = "und"

_PAD = 256
_LOWER = np.arange(257, dtype=np.int16)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(257, np.float32)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[0x80:256] = 1


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows that cover all texts begin, and the text of each. A text has one window at least.

    Windows of a text overlap by as much as the widest filter needs to see every span once.
    """
    sizes = np.diff(offsets)
    step = WINDOW - max(WIDTHS) + 1
    counts = np.maximum(1, -(-(sizes - max(WIDTHS) + 1) // step))
    of = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return offsets[of] + nth * step, of


class ByteNetwork:
    """Filters of several widths over bytes, the maximum of each over the window, and a softmax.

    A filter's weights are one number per byte value and place, so a convolution adds up table rows.
    """

    def __init__(self, languages: Sequence[str], seed: int = 0):
        r = np.random.default_rng(seed)
        self.languages = list(languages)
        self.filters = [r.normal(0, 0.3, (w, 257, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = r.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)
        for f in self.filters:
            f[:, _PAD] = 0

    def _responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        for table in self.filters:
            places = x.shape[1] - len(table) + 1
            total = np.take(table[0], x[:, :places], axis=0)
            for place in range(1, len(table)):
                total += np.take(table[place], x[:, place : place + places], axis=0)
            yield total

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([r.max(1) + b for r, b in zip(self._responses(x), self.bias)], 1)
        return _softmax(np.maximum(pooled, 0) @ self.out + self.out_bias)

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 0) -> None:
        """Adam on cross-entropy. Gradients reach a filter only at the byte span that had its maximum."""
        r = np.random.default_rng(seed)
        params = [*self.filters, *self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        column = np.arange(FILTERS)
        for step in range(1, STEPS * max(1, -(-len(self.languages) // STEPS_LANGUAGES)) + 1):
            pick = r.integers(0, len(x), min(BATCH, len(x)))
            xs = x[pick].copy()
            # Some windows are cut short, as those of short texts are.
            short = r.random(len(xs)) < 0.25
            ends = np.where(short, r.integers(8, WINDOW, len(xs)), WINDOW)
            xs[np.arange(WINDOW)[None, :] >= ends[:, None]] = _PAD
            responses = list(self._responses(xs))
            best = [resp.argmax(1) for resp in responses]
            rows = np.arange(len(xs))[:, None]
            pooled = np.concatenate([resp[rows, b, column] + bias for resp, b, bias in zip(responses, best, self.bias)], 1)
            hidden = np.maximum(pooled, 0)
            error = _softmax(hidden @ self.out + self.out_bias)
            error[np.arange(len(xs)), y[pick]] -= 1
            error /= len(xs)
            back = (error @ self.out.T) * (pooled > 0)
            grads_f, grads_b = [], []
            for k, (table, b) in enumerate(zip(self.filters, best)):
                g, mine = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
                for place in range(len(table)):
                    np.add.at(g[place], (xs[rows, b + place], column), mine)
                g[:, _PAD] = 0
                grads_f.append(g)
                grads_b.append(mine.sum(0))
            grads = [*grads_f, *grads_b, hidden.T @ error + 1e-4 * self.out, error.sum(0)]
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text, the likeliest language and its probability: the mean of all windows, by their letters."""
        starts, of = windows(data, offsets)
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        weight = np.zeros(len(offsets) - 1)
        for i in range(0, len(starts), 128):  # these responses stay in a core's cache
            begin, text = starts[i : i + 128], of[i : i + 128]
            at = begin[:, None] + np.arange(WINDOW)
            inside = at < offsets[text + 1][:, None]
            x = np.full(at.shape, _PAD, np.int16)
            x[inside] = _LOWER[data[at[inside]]]
            letters = _LETTER[x].sum(1) + 1e-3
            np.add.at(total, text, self.probabilities(x) * letters[:, None])
            np.add.at(weight, text, letters)
        total /= np.maximum(weight, 1e-9)[:, None]
        best = total.argmax(1) if len(total) else np.zeros(0, np.int64)
        return best, np.clip(total[np.arange(len(total)), best], 0, 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def held_out(id_column: str):
    """A fifth of the ids, by their text; no id is never learned from either."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(True))


def fit_language_model(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_total: int = SAMPLE_TOTAL,
    seed: int = 0,
) -> ByteNetwork | None:
    """A network learned from a bounded sample of the labelled rows that are not held out.

    Every language that has such a row is learned. Counts per language come from the whole table. About
    ``sample_documents`` documents of each, fewer if there are more than ``sample_total`` in all but 20 at least, are
    chosen by a hash of the id, and 4 windows of each by a hash as well, so the driver gets some MB at most and reruns
    learn the same. Null if there is nothing to learn from.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"), F.col(f"`{lang_column}`").alias("_lang"))
    rows = rows.where(~held_out("_id") & F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    counts = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    languages = sorted(r["_lang"] for r in counts)
    place = {name: i for i, name in enumerate(languages)}
    each = min(sample_documents, max(SAMPLE_LEAST, sample_total // len(languages)))
    # A table of one row for each language, however many rows a language has.
    rates = docs.sparkSession.createDataFrame([(r["_lang"], each / r["n"]) for r in counts], "_of string, _rate double")
    luck = uniform(F.lit(seed), F.col("_id").cast("string"), F.length("_text"))
    rows = rows.withColumn("_luck", luck).where(F.col("_luck") < each / min(r["n"] for r in counts))
    chosen = rows.join(F.broadcast(rates), F.col("_lang") == F.col("_of")).where(F.col("_luck") < F.col("_rate"))
    room = F.greatest(F.lit(0), F.length("_text") - WINDOW)
    pieces = [
        F.substring("_text", (uniform(F.lit(seed), F.lit(k), F.col("_luck")) * (room + 1)).cast("int") + 1, F.lit(WINDOW))
        for k in range(SAMPLE_WINDOWS)
    ]
    sample = (
        chosen.select("_luck", "_lang", F.array(*pieces).alias("pieces"))
        .orderBy("_luck", "_lang", "pieces")
        .collect()
    )
    raw = [(p.encode("utf-8", "replace")[:WINDOW], place[r["_lang"]]) for r in sample for p in r["pieces"]]
    x = np.full((len(raw), WINDOW), _PAD, np.int16)
    for i, (piece, _) in enumerate(raw):
        x[i, : len(piece)] = _LOWER[np.frombuffer(piece, np.uint8)]
    network = ByteNetwork(languages, seed)
    network.train(x, np.array([y for _, y in raw]), seed)
    return network


def predict_language(
    docs: DataFrame, network: ByteNetwork | None, text_column: str = "text", out_column: str = "lang_pred", score_column: str = "score"
) -> DataFrame:
    """``docs`` with the predicted language of the whole text and its probability.

    A null text, one without any letter, and every text where nothing was learned are ``und`` with score 0.
    Of languages with the same probability the first in the order of their names is taken. Only the text is looked at. Other columns pass through; columns with the names of the results are replaced.
    """
    if network is None:
        return docs.withColumns({out_column: F.lit(UNKNOWN), score_column: F.lit(0.0)})
    kept, flag = [c for c in docs.columns if c not in (out_column, score_column)], unused(docs, "_letter")
    fields = [T.StructField(out_column, T.StringType()), T.StructField(score_column, T.DoubleType())]
    work = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text_column}`").rlike(r"\p{L}"), F.lit(False)).alias(flag))
    model = docs.sparkSession.sparkContext.broadcast(network)  # some 100 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.value.languages, object)
        for batch in batches:
            letter = batch.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            best, score = model.value.predict(*utf8(batch.column(text_column)))
            language = pa.array(np.where(letter, names[best], UNKNOWN), pa.string())
            arrays = [*[batch.column(c) for c in kept], language, pa.array(np.where(letter, score, 0.0), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, out_column, score_column])

    return in_batches(work, run, T.StructType([*[docs.schema[c] for c in kept], *fields]))
