"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss."""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import in_batches, unused

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The base patterns. They match what the contract's match, in linear time: a run of digits is entered at its
# start only, as no later start could reach further, and an address is found from its @.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT, _DIGIT = re.compile(r"[^0-9]"), re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The matches of the fixed patterns, by kind as in `KINDS` and then by place."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]  # of any length; int() takes 4300 digits
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# Tokens and their features

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_RUN = re.compile(r"\S+")
# Where personal data can be: digits, @, '(at)' or '[at]', and 'at' before a dotted host. Read alike by Spark.
_AT = r"[(\[{][ \t]*[aA][tT][ \t]*[)\]}]|(?<![A-Za-z])[aA][tT][ \t]+[^ \t\r\n.]+\.[^ \t\r\n.]"
TRIGGER = f"[0-9@]|{_AT}"
_TRIGGER, _WRITTEN_AT = re.compile(TRIGGER), re.compile(_AT)
REACH = 8  # tokens to either side of such a place that are looked at
LABELS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))


def _shape(token: str) -> str:
    if token.isascii() and token.isdigit():
        n = len(token)
        return f"9{n if n < 5 else '5-8' if n < 9 else '9-15' if n < 16 else '16-19' if n < 20 else '20'}"
    if token[0].isalpha():
        return ("A" if token[0].isupper() else "") + ("A" if token[1:].isupper() else "a" if len(token) > 1 else "")
    return token


def _run_shape(run: str) -> str:
    """The kinds of characters in a row; of a long run those of both ends, and that it is long."""
    if len(run) > 80:
        return f"{_run_shape(run[:40])}~{_run_shape(run[-40:])}"
    return "".join(k for k, _ in groupby("9" if c in "0123456789" else "a" if c.isalnum() else c for c in run))


def _word(token: str) -> str:
    token = token.lower()
    return token if len(token) <= 12 else f"{token[:6]}~{token[-6:]}"


def _digits(run: str) -> str:
    n = sum(1 for _ in islice(_DIGIT.finditer(run), 20))
    return str(n) if n < 20 else "20"


#: A segment of more tokens than this is parted.
LONGEST = 2000


def segments(text: str) -> Iterator[list[tuple[int, int, list[str]]]]:
    """Tokens near a match of `TRIGGER`, as runs of ``(start, end, features)``.

    No span begins further than `REACH` tokens from one, so all other tokens are no personal data by definition.
    Line ends end a segment. Looks at the lines with such a match only, and keeps the tokens of one segment at a
    time, whatever the length of the line; one of more than `LONGEST` tokens is parted, between two plain words
    if there are any.
    """
    position, end = _TRIGGER.search(text), 0
    while position:
        start = text.rfind("\n", 0, position.start()) + 1
        end = text.find("\n", position.start())
        end = len(text) if end < 0 else end
        for tokens in _line_segments(text, start, end):
            yield _featured(text, tokens, end)
        position = _TRIGGER.search(text, end)


def _line_segments(text: str, start: int, end: int) -> Iterator[list[tuple[int, int, str]]]:
    segment: list[tuple[int, int, str]] = []
    before: deque[tuple[int, int, str]] = deque(maxlen=REACH)
    after = 0
    written = _WRITTEN_AT.finditer(text, start, end)
    place = next(written, None)
    for m in _TOKEN.finditer(text, start, end):
        token = (m.start(), m.end(), m.group())
        while place and place.end() <= token[0]:
            place = next(written, None)
        if token[2] == "@" or "0" <= token[2][0] <= "9" or (place and place.start() < token[1]):
            segment.extend(before)
            before.clear()
            segment.append(token)
            after = REACH
        elif after:
            segment.append(token)
            after -= 1
        else:
            if segment and len(before) == REACH:  # the next match is out of reach
                yield segment
                segment = []
            before.append(token)
        if len(segment) > LONGEST and (_between_words(segment) or len(segment) > LONGEST + 256):
            yield segment[:-1]
            segment = segment[-1:]
    if segment:
        yield segment


def _between_words(tokens: list[tuple[int, int, str]]) -> bool:
    (_, before, left), (after, _, right) = tokens[-2:]
    return after > before and left.isalpha() and right.isalpha() and "at" not in (left.lower(), right.lower())


def _featured(text: str, tokens: list[tuple[int, int, str]], end: int) -> list[tuple[int, int, list[str]]]:
    shapes = [_shape(t) for _, _, t in tokens]
    spaced = ["_" if a == 0 or text[a - 1].isspace() else "" for a, _, _ in tokens]
    out, run_end, run = [], -1, ("", "")
    padded = ["<", "<", *shapes, ">", ">"]
    for i, (a, b, t) in enumerate(tokens):
        if a >= run_end or spaced[i]:
            m = _RUN.match(text, a, end)
            run_end, run = m.end(), (_run_shape(m.group()), _digits(m.group()))
        p = padded[i : i + 5]
        out.append(
            (a, b, [
                "bias", f"s {spaced[i]}{p[2]}", f"-1 {p[1]}", f"+1 {p[3]}", f"-2 {p[0]} {p[1]}", f"+2 {p[3]} {p[4]}", f"-0 {p[1]} {p[2]}",
                f"+0 {p[2]} {p[3]}", f"w {_word(t)}", f"r {run[0]}", f"n {run[1]} {spaced[i]}",
                f"g {spaced[i]} {spaced[i + 1] if i + 1 < len(tokens) else '_'} {p[1]} {p[2]} {p[3]}",
            ])
        )
    return out


class ChainField:
    """A linear-chain conditional random field: weights of features per label, and of label pairs."""

    def __init__(self, features: dict[str, int]):
        self.features = features
        n = len(LABELS)
        self.weights, self.pairs = np.zeros((len(features) + 1, n)), np.zeros((n, n))
        # An inside label follows the same kind only; no sequence starts with one.
        self.allowed = np.array([[b[0] != "I" or a[1:] == b[1:] and a != "O" for b in LABELS] for a in LABELS])
        self.start = np.array([0.0 if b[0] != "I" else -1e4 for b in LABELS])

    def _rows(self, sequences: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """The features of all tokens as a padded array (sequence, place, feature), and the lengths."""
        absent, lengths = len(self.features), np.array([len(s) for s in sequences])
        width = max((len(f) for s in sequences for f in s), default=1)
        out = np.full((len(sequences), max(lengths, default=0), width), absent, np.int32)
        for i, s in enumerate(sequences):
            for j, f in enumerate(s):
                out[i, j, : len(f)] = [self.features.get(x, absent) for x in f]
        return out, lengths

    def _scores(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[rows].sum(2)

    def train(self, sequences: list[list[list[str]]], labels: list[list[int]], steps: int = 50, rate: float = 0.3, ridge: float = 2e-4):
        """Adam on the log-likelihood, all sequences at once, by forward and backward sums in logarithms."""
        rows, lengths = self._rows(sequences)
        count, longest, _ = rows.shape
        mask = np.arange(longest)[None, :] < lengths[:, None]
        gold = np.zeros((count, longest), np.int64)
        for i, s in enumerate(labels):
            gold[i, : len(s)] = s
        onehot = np.eye(len(LABELS))[gold] * mask[..., None]
        pair_gold = np.einsum("stl,stm->lm", onehot[:, :-1] * mask[:, 1:, None], onehot[:, 1:])
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (self.weights, self.pairs)]
        # The tokens in the order of their features, so that a feature's gradient is the sum of one stretch.
        flat = rows[mask]
        order = np.argsort(flat, axis=None, kind="stable")
        token = order // flat.shape[1]
        used, first = np.unique(flat.ravel()[order], return_index=True)
        for step in range(1, steps + 1):
            score = self._scores(rows)
            score[:, 0] += self.start
            pairs = np.where(self.allowed, self.pairs, -1e4)
            ahead, behind = np.zeros_like(score), np.zeros_like(score)
            ahead[:, 0] = score[:, 0]
            for t in range(1, longest):
                new = _log_sum(ahead[:, t - 1, :, None] + pairs, 1) + score[:, t]
                ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
            for t in range(longest - 2, -1, -1):
                new = _log_sum(pairs + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
                behind[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
            total = _log_sum(ahead[:, -1], 1)[:, None]
            chance = np.exp(ahead + behind - total[..., None]) * mask[..., None]
            pair_chance = np.zeros_like(self.pairs)
            for t in range(1, longest):
                joint = ahead[:, t - 1, :, None] + pairs + (score[:, t] + behind[:, t])[:, None, :] - total[..., None]
                pair_chance += np.exp(np.minimum(joint, 0))[mask[:, t]].sum(0)
            grad = np.zeros_like(self.weights)
            grad[used] = np.add.reduceat((chance - onehot)[mask][token], first)
            grad[-1] = 0
            for p, g, (m, v) in zip((self.weights, self.pairs), (grad, pair_chance - pair_gold), moments):
                g = g / count + ridge * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def decode(self, sequences: list[list[list[str]]]) -> list[np.ndarray]:
        """The likeliest labels of each sequence, by Viterbi over all of them at once."""
        rows, lengths = self._rows(sequences)
        score = self._scores(rows)
        if not score.size:
            return [np.zeros(0, np.int64) for _ in sequences]
        best = score[:, 0] + self.start
        pairs, back = np.where(self.allowed, self.pairs, -1e4), np.zeros(score.shape, np.int8)
        for t in range(1, score.shape[1]):
            way = best[:, :, None] + pairs
            back[:, t] = way.argmax(1)
            best = np.where((t < lengths)[:, None], way.max(1) + score[:, t], best)
        out = np.zeros(score.shape[:2], np.int64)
        label = best.argmax(1)
        for t in range(score.shape[1] - 1, -1, -1):
            live = t < lengths
            out[live, t] = label[live]
            label = np.where(live, back[np.arange(len(label)), t, label] if t else label, label)
        return [out[i, :n] for i, n in enumerate(lengths)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


# The labelled table

WORDS = "the of and to in is it for on with le la les de et un une que der die das und ein zu el los una y con para please write call".split()


def labelled_table(rows: int = 250, seed: int = 11, written: bool = False) -> list[tuple[str, list[Span]]]:
    """Sentences with marked spans, made by rule: each kind in several ways of writing, and numbers that are none.

    With ``written``, sentences without digits or @, and addresses in them with '(at)' or '[at]'.
    """
    r = random.Random(seed)

    def number(n: int) -> str:
        return "".join(r.choices("0123456789", k=n))

    def word() -> str:
        w = r.choice(WORDS) if r.random() < 0.5 else "".join(r.choices("abdehinorstuvéü", k=r.randint(2, 10)))
        return w.capitalize() if r.random() < 0.15 else w.upper() if r.random() < 0.05 else w

    def name() -> str:
        return "".join(r.choices("abdehinorstu", k=r.randint(2, 9)))

    def card() -> str:
        body = number(15)
        digits = next(body + d for d in "0123456789" if _luhn(body + d))
        between = r.choice(["", "", " ", "-"])
        return between.join(digits[i : i + 4] for i in range(0, 16, 4))

    host = lambda: f"{name()}{r.choice(['', number(1)])}.{name()}.{r.choice(['com', 'org', 'net', 'de', 'fr'])}"
    writers = {
        "email": lambda: f"{name()}{r.choice(['', '.', '_', '+'])}{r.choice([name(), number(2)])}{r.choice(['@', '@', '@', ' (at) ', '[at]', ' @ '])}{host()}",
        "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: r.choice([
            f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}",
            f"+{number(2)} {number(3)} {number(3)} {number(4)}", f"00{number(2)} {number(3)} {number(3)} {number(4)}", f"{number(3)}.{number(3)}.{number(4)}",
        ]),
    }
    written_address = lambda: f"{name()}{r.choice(['', '', '.' + name()])}{r.choice([' (at) ', '[at]'])}{name()}{r.choice(['', '.' + name()])}.{r.choice(['com', 'org', 'net', 'de', 'fr'])}"
    others = [
        lambda: f"{r.randint(1900, 2099)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"{r.randint(1, 23)}:{number(2)}", lambda: number(r.randint(1, 13)),
        lambda: f"{number(2)}.{number(2)}", lambda: f"{number(1)}.{number(1)}.{number(1)}", lambda: f"{number(1)},{number(3)}.{number(2)}", lambda: f"#{number(5)}",
        lambda: '"' + "".join(r.choices("0123456789abcdef", k=r.randint(24, 48))) + '"', lambda: f"{name()}-{number(4)}", lambda: f"{number(2)}%",
        lambda: f"@{name()}", lambda: number(r.randint(20, 30)), lambda: f"{number(1)}.{number(1)}.{number(1)}.{number(1)}.{number(1)}", lambda: f"({number(4)})",
        lambda: f"{number(2)}/{number(2)}/{number(4)}", lambda: f"{number(4)}-{number(4)}", lambda: f"{number(3)} {number(3)}", lambda: f"{name()}{number(2)}.{name()}",
    ]
    table = []
    for _ in range(rows):
        text, spans = "", []
        for _ in range(r.randint(3, 14)):
            kind = r.random()
            if kind < 0.12:
                k = "email" if written else r.choice(KINDS)
                piece = written_address() if written else writers[k]()
                spans.append((k, len(text), len(text) + len(piece)))
            else:
                piece = r.choice(others)() if kind < 0.3 and not written else f"(at) {word()}" if written and kind < 0.15 else word()
            text += piece + (r.choice([".", ",", "!!", "###", "%%%", " |", ";"]) if r.random() < 0.25 else "") + " "
        table.append((text.strip(), spans))
    return table


def fit_chain_field(table: Iterable[tuple[str, list[Span]]] | None = None) -> ChainField:
    """A field learned from rows of text and spans; by default from `labelled_table`, both forms."""
    sequences, labels, seen = [], [], {}
    for text, spans in labelled_table() + labelled_table(100, written=True) if table is None else table:
        for segment in segments(text):
            sequences.append([f for _, _, f in segment])
            marks = []
            for a, b, _ in segment:
                span = next((s for s in spans if s[1] <= a and b <= s[2]), None)
                marks.append(LABELS.index(("B-" if a == span[1] else "I-") + span[0]) if span else 0)
            labels.append(marks)
    for s in sequences:
        for f in s:
            for x in f:
                seen[x] = seen.get(x, 0) + 1
    field = ChainField({x: i for i, x in enumerate(sorted(x for x, n in seen.items() if n > 1))})
    if sequences:
        field.train(sequences, labels)
    return field


def _likely(kind: str, piece: str) -> bool:
    """Could this be of the kind at all?"""
    digits = _NO_DIGIT.sub("", piece)
    if kind == "email":
        return bool(re.search(r"(@|\b[aA][tT]\b)", piece) and "." in piece and piece[-1].isalnum())
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", piece)) and all(int(p) <= 255 for p in piece.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return 10 <= len(digits) <= 15 and not re.search(r"[^0-9\x20().+-]", piece)


#: So many tokens are decoded together, or the tokens of one segment.
_TOGETHER = 50_000


def all_spans(texts: list[str], field: ChainField) -> list[list[tuple[str, int, int, bool]]]:
    """For each text its spans by kind and place, with whether a fixed pattern found it.

    The field's spans are added where they overlap no other span and could be of their kind.
    """
    found = [[(*s, True) for s in base_spans(t)] for t in texts]
    waiting, held = [], 0
    for i, t in enumerate(texts):
        base = _Taken(found[i])
        for s in segments(t):
            waiting.append((s, t, found[i], base))
            held += len(s)
            if held > _TOGETHER:
                _decode(waiting, field)
                waiting, held = [], 0
    _decode(waiting, field)
    return [sorted(s, key=lambda x: (KINDS.index(x[0]), x[1])) for s in found]


class _Taken:
    """The places of a text that spans take."""

    def __init__(self, spans: list[tuple[str, int, int, bool]]) -> None:
        # Spans of different kinds may overlap; the furthest end so far makes one look at a sorted list enough.
        self.starts, self.ends, furthest = [], [], 0
        for _, start, end, _ in sorted(spans, key=lambda s: s[1]):
            furthest = max(furthest, end)
            self.starts.append(start)
            self.ends.append(furthest)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start


def _decode(parts: list, field: ChainField) -> None:
    """Add what the field finds in the segments to the spans of their texts."""
    order = sorted(range(len(parts)), key=lambda i: len(parts[i][0]))  # sequences of like length share a block
    for k in range(0, len(order), 256):
        block = [parts[i] for i in order[k : k + 256]]
        for (segment, text, mine, base), path in zip(block, field.decode([[f for _, _, f in p[0]] for p in block])):
            for kind, first, last in _labelled_runs(path):
                start, end = segment[first][0], segment[last][1]
                # Segments do not overlap, nor do the runs of one, so only the base spans can be in the way.
                if base.free(start, end) and _likely(kind, text[start:end]):
                    mine.append((kind, start, end, False))


def _labelled_runs(path: np.ndarray) -> Iterator[tuple[str, int, int]]:
    i = 0
    while i < len(path):
        if path[i] == 0:
            i += 1
            continue
        j = i + 1
        while j < len(path) and LABELS[path[j]][0] == "I" and path[j] != 0:
            j += 1
        yield LABELS[path[i]][2:], i, j - 1
        i = j


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)


def find_personal_data(docs: DataFrame, field: ChainField, text_column: str = "text", out_column: str = "spans") -> DataFrame:
    """``docs`` with the spans of personal data in the whole text, in code points, by kind and place.

    Runs of digits, words and lines may have any length; memory grows with a text by its size and its spans only.

    ``base`` spans are the matches of the fixed patterns, all of them; the others were added by the field.
    Null and empty texts have none. A text without a match of `TRIGGER` has none either and is not looked at in Python.
    Other columns pass through; a column with the name of the result is replaced. No shuffle.
    """
    kept, flag = [c for c in docs.columns if c != out_column], unused(docs, "_look")
    work = docs.select(*kept, F.coalesce(F.col(text_column).rlike(TRIGGER), F.lit(False)).alias(flag))
    model = docs.sparkSession.sparkContext.broadcast(field)  # some 100 kB
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            look = np.flatnonzero(batch.column(flag).to_numpy(zero_copy_only=False).astype(bool))
            out = [[]] * batch.num_rows
            for i in range(0, len(look), 500):
                some = look[i : i + 500]
                for at, spans in zip(some.tolist(), all_spans(batch.column(text_column).take(pa.array(some)).to_pylist(), model.value)):
                    out[at] = [dict(zip(("kind", "start", "end", "base"), s)) for s in spans]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, kind)], [*kept, out_column])

    return in_batches(work, run, T.StructType([*[docs.schema[c] for c in kept], T.StructField(out_column, SPANS)]))
