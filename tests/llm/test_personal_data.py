"""Base spans against the contract's patterns, the field on sentences it has not seen, and the query."""

import hashlib
import random
import re

import pytest

from tagloom.llm import personal_data as pd
from tagloom.llm.queries import QUERIES

# The contract's patterns, as written there.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_equals_the_patterns():
    r = random.Random(1)
    for _ in range(30_000):
        text = "".join(r.choices("0123456789 .-+()@@aB%_é\n", k=r.randint(0, 40)))
        assert pd.base_spans(text) == brute(text), repr(text)
    for _ in range(3000):
        text = "".join(r.choices(["4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "255", ".", "256.1.1.1", " ", "+1 (523) 555-1055", "a@b.c", "@", "x.y@z-1.com.", "-", "007.1.1.001"], k=6))
        assert pd.base_spans(text) == brute(text), repr(text)


def test_base_is_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000, "@" * 300_000, "a@b" * 100_000,
                 "0" * 300_000 + "1.1.1.1", "1.1.1." + "0" * 300_000 + "9", ("0" * 5000 + ".") * 60, "." * 150_000 + "1" * 150_000 + ".2.3.4"):
        pd.base_spans(text)


def test_long_runs_of_digits():
    zeros = "0" * 5000
    assert pd.base_spans(f"{zeros}1.1.{zeros}.255") == [("ip", 0, 10_008)]
    assert pd.base_spans(f"{zeros}256.1.1.1 1.1.1.{'9' * 5000}") == []


def by_lists(text):
    """The tokens of `segments`, from the whole line's list of tokens."""
    out, at = [], 0
    for line in text.split("\n"):
        tokens = [(m.start() + at, m.end() + at, m.group()) for m in pd._TOKEN.finditer(line)]
        written = [(m.start() + at, m.end() + at) for m in pd._WRITTEN_AT.finditer(line)]
        hits = [i for i, (a, b, t) in enumerate(tokens) if t == "@" or "0" <= t[0] <= "9" or any(a < y and x < b for x, y in written)]
        inside = [i for i in range(len(tokens)) if any(abs(i - h) <= pd.REACH for h in hits)]
        for n, i in enumerate(inside):
            if n == 0 or inside[n - 1] != i - 1:
                out.append([])
            out[-1].append(tokens[i][:2])
        at += len(line) + 1
    return out


def test_segments_equal_those_of_whole_lines():
    r = random.Random(4)
    for _ in range(2000):
        text = "".join(r.choices(["a ", "bc ", "7", " @", "(at) ", "x at y.z ", ". ", "\n", "é ", "--", "word " * 9, "word " * 17], k=r.randint(0, 25)))
        assert [[t[:2] for t in s] for s in pd.segments(text)] == by_lists(text), repr(text)


def test_long_lines_are_parted_between_words(field, monkeypatch):
    text = " ".join(f"write to jane{i} (at) host{i}.org or call +1 (523) 555-{1000 + i} please and thank you" for i in range(60))
    whole = pd.all_spans([text], field)
    monkeypatch.setattr(pd, "LONGEST", 50)
    assert max(map(len, pd.segments(text))) <= 50 + 256 and len(list(pd.segments(text))) > 10
    assert pd.all_spans([text], field) == whole and len(whole[0]) >= 60


def test_a_long_line_takes_bounded_memory(field):
    import tracemalloc

    text = "plain words in one line " * 100_000 + "1 2 3 4 5 6 7 8 " * 20_000
    tracemalloc.start()
    pd.all_spans([text], field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20


@pytest.fixture(scope="module")
def field():
    return pd.fit_chain_field()


def test_field_finds_unseen_spans_and_leaves_plain_text_alone(field):
    right = wrong = missed = 0
    table = pd.labelled_table(200, seed=77)
    for (_, spans), found in zip(table, pd.all_spans([t for t, _ in table], field)):
        found = {s[:3] for s in found}
        right, wrong, missed = right + len(found & set(spans)), wrong + len(found - set(spans)), missed + len(set(spans) - found)
    assert right / (right + missed) > 0.85 and right / (right + wrong) > 0.85
    plain = "On 2024-05-01 at 12:30 we sold 1,250 items for 12.50 each, 17% more. #12345 3 of 4"
    assert pd.all_spans([plain, "", "no digits here"], field) == [[], [], []]
    added = pd.all_spans(["call (523) 555-1055 or write anna_42[at]mail.example.com"], field)[0]
    assert [(k, base) for k, _, _, base in added] == [("email", False), ("phone", False)]


def test_written_addresses_without_digits(spark, field):
    """No digit and no @ in the text, or none within reach; also through the frame, which chooses the texts to look at."""
    rest = "and so on with words " * 20
    forms = ["jane (at) host.org", "jane.doe[at]mail.host.com", "anna (at) mail.example.de"]
    texts = [f"please write to {f} {end}" for f in forms for end in ("", rest, rest + "on 2024-05-01")]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in pd.find_personal_data(df, field).collect():
        address = next(f for f in forms if f in r.text)
        assert [(s.kind, r.text[s.start : s.end], s.base) for s in r.spans] == [("email", address, False)], r.text
    plain = ["We met at home. Look at this (at least once) and at St.Paul for the rest", "(at) noon [at] night"]
    assert pd.all_spans(plain, field) == [[], []]


def test_decode_is_the_best_path(field):
    import itertools

    import numpy as np

    segment = next(pd.segments("call +1 23"))[:4]
    path = field.decode([[f for _, _, f in segment]])[0]
    rows, _ = field._rows([[f for _, _, f in segment]])
    score = field._scores(rows)[0]

    def total(labels):
        if pd.LABELS[labels[0]][0] == "I" or not all(field.allowed[a, b] for a, b in zip(labels, labels[1:])):
            return -np.inf
        return sum(score[t, y] for t, y in enumerate(labels)) + sum(field.pairs[a, b] for a, b in zip(labels, labels[1:]))

    assert tuple(path) == max(itertools.product(range(len(pd.LABELS)), repeat=len(segment)), key=total)


def test_frames(spark, field):
    rows = [(1, None), (2, ""), (3, "é a.b@c.de\n"), (3, "é a.b@c.de\n"), (None, "x " * 60_000 + "10.0.0.1"), (5, "nothing")]
    df = spark.createDataFrame([(k, t, "_", "s") for k, t in rows], "doc_id long, text string, _look string, spans string")
    out = pd.find_personal_data(df, field)
    assert out.columns == ["doc_id", "text", "_look", "spans"]
    got = sorted([(r.text or "", [tuple(s) for s in r.spans]) for r in out.collect()])
    assert got == sorted((t or "", [(*s, True) for s in brute(t or "")]) for _, t in rows)
    assert pd.find_personal_data(df.limit(0), field).collect() == []


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op7_personal_data"](spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        spans = brute(texts[r.doc_id])
        written = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pd.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(",")) | {""}
