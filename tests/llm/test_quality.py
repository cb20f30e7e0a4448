"""The weak-label model and its scorer on marked texts, and the query against the labels table."""

import random
import re
import string

import numpy as np
import pytest

from tagloom.llm import quality as ql
from tagloom.llm.queries import QUERIES


def words(*texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8) if any(raw) else np.zeros(0, np.uint8)
    return ql.Words(data, np.cumsum([0, *map(len, raw)]))


def test_measures():
    text = "One one one two. THREE | 44 é# \n"
    m = dict(zip(ql.HEURISTICS, words("", text, "x").measures()[1]))
    assert m["symbols per character"] == pytest.approx(2 / 24)
    assert m["upper-case letters per ASCII letter"] == pytest.approx(6 / 17)
    assert m["words equal to the one before"] == pytest.approx(1 / 8)
    assert m["words without any letter"] == pytest.approx(2 / 8)
    assert m["words that end a sentence"] == pytest.approx(1 / 8)
    assert m["repeated words, in windows of 200"] == pytest.approx(1 / 8)
    assert m["digits per character"] == pytest.approx(2 / 24)
    assert m["words that end in a symbol"] == pytest.approx(2 / 8)


def test_repetition_after_the_first_words_counts():
    name, varied = "repeated words, in windows of 200", " ".join(f"w{i}" for i in range(200))
    texts = ["a b", f"{varied} " + "buy this now and here " * 2000, " ".join(f"w{i}" for i in range(5000)), varied + " a a"]
    together = words(*texts).measures()[:, list(ql.HEURISTICS).index(name)]
    assert together == pytest.approx([0, (10_000 - 50 * 5) / 10_200, 0, 1 / 202])
    vote = words(*texts).votes() // 3 ** list(ql.HEURISTICS).index(name) % 3
    assert vote.tolist() == [ql.SILENT, ql.BAD, ql.GOOD, ql.GOOD]


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def plain_votes(text):
    """The votes of the heuristics on one text, from their names."""
    words = plain_words(text)
    if not words:
        return None
    raw, last = [w.encode() for w in words], [w.encode()[-1:] for w in words]
    count = lambda chars: sum(text.count(c) for c in chars)
    upper, lower = count(string.ascii_uppercase), count(string.ascii_lowercase)
    symbols, characters = count("#$%&*+/<=>@[\\]^_`{|}~"), sum(map(len, raw))
    # Characters are bytes that show; control characters do not.
    characters = sum(33 <= b < 127 or b >= 128 for w in raw for b in w)
    letter = lambda w: any(chr(b) in string.ascii_letters or b >= 128 for b in w)
    windows = [words[i : i + 200] for i in range(0, len(words), 200)]
    measures = [
        symbols / characters, upper / max(1, upper + lower), sum(a == b for a, b in zip(words, words[1:])) / len(words),
        sum(not letter(w) for w in raw) / len(words), sum(x in (b".", b"!", b"?") for x in last) / len(words),
        sum(len(w) - len(set(w)) for w in windows) / len(words), count(string.digits) / characters,
        sum(x and x in b"#$%&*+/<=>@[\\]^_`{|}~" for x in last) / len(words),
    ]
    if len(words) < ql.FEWEST_WORDS:
        return [ql.SILENT] * 8
    return [ql.GOOD if m < low else ql.BAD if m > high else ql.SILENT for m, (low, high) in zip(measures, ql.HEURISTICS.values())]


def random_texts(count, seed):
    r = random.Random(seed)
    pieces = ["the", "Quick", "FOX", "é#", "end.", "what?", "||", "12", "3,4", "a", "a a a", "x%", "\n", "buy now!"]
    return [" ".join(r.choices(pieces[: r.randint(1, len(pieces))], k=r.choice([0, 1, 5, 9, 30, 450]))) for _ in range(count)]


def test_votes_equal_the_heuristics_as_named():
    texts = random_texts(300, 4)
    for text, got in zip(texts, words(*texts).votes().tolist()):
        want = plain_votes(text)
        assert got == (ql.NO_WORDS if want is None else sum(v * 3**k for k, v in enumerate(want))), repr(text)


def plain_label_model(votes, steps=100):
    """Expectation-maximisation text by text: the prior, and the chance that each text is bad."""
    silent = [all(v == ql.SILENT for v in t) for t in votes]
    bad = [0.9 if ql.BAD in t else 0.1 for t in votes]
    for _ in range(steps):
        spoken = [i for i in range(len(votes)) if not silent[i]]
        total = [sum(1 - bad[i] for i in spoken), sum(bad[i] for i in spoken)]
        prior = [(t + 1) / (sum(total) + 2) for t in total]
        chance = {}
        for c in (0, 1):
            for k in range(8):
                said = [0.1 + sum(bad[i] if c else 1 - bad[i] for i in spoken if votes[i][k] == v) for v in range(3)]
                for v in range(3):
                    chance[c, k, v] = said[v] / sum(said)
        for i, t in enumerate(votes):
            side = [prior[c] * np.prod([chance[c, k, v] for k, v in enumerate(t)]) for c in (0, 1)]
            bad[i] = prior[1] if silent[i] else side[1] / sum(side)
    return bad


def test_posteriors_equal_plain_expectation_maximisation():
    votes = [v for v in map(plain_votes, random_texts(200, 5)) if v]
    counts = {}
    for t in votes:
        number = sum(v * 3**k for k, v in enumerate(t))
        counts[number] = counts.get(number, 0) + 1
    model = ql.LabelModel(counts)
    assert [model.bad[sum(v * 3**k for k, v in enumerate(t))] for t in votes] == pytest.approx(plain_label_model(votes), abs=1e-6)


def test_scores_equal_a_plain_sum():
    scorer = ql.Scorer()
    scorer.weights, scorer.bias = np.random.default_rng(1).normal(size=len(scorer.weights)), 0.3
    texts = random_texts(60, 6)
    for text, got in zip(texts, scorer.score(words(*texts))):
        if not plain_words(text):
            assert got == 0
            continue
        one = words(text)
        of, features, _ = one.features()
        # Every word has one feature of each family, and each weighs one part of the words and the doubt.
        assert len(features) == 3 * len(plain_words(text)) and set(of) == {0}
        total = sum(scorer.weights[f] for f in features) / (len(plain_words(text)) + ql.DOUBT) + 0.3
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_texts_are_read_for_votes_once(spark, monkeypatch):
    """The scorer takes the counts of the label model; only the texts it learns from are looked at again."""
    df = spark.createDataFrame([(i, "a plain text of some words and more of them again") for i in range(20)], "doc_id long, text string")
    model, passes = ql.fit_label_model(df), []
    whole = ql._mapped
    monkeypatch.setattr(ql, "_mapped", lambda *a, **k: passes.append(1) or whole(*a, **k))
    ql.fit_scorer(df, model)
    assert len(passes) == 1 and sum(model.counts.values()) == 20


def test_batches_do_not_matter():
    texts = ["a b c", "", "  ", "c d c", "C!! D##", "é " * 50]
    together, alone = words(*texts), [words(t) for t in texts]
    assert together.votes().tolist() == [a.votes()[0] for a in alone]
    scorer = ql.Scorer()
    scorer.weights = np.random.default_rng(1).normal(size=len(scorer.weights))
    assert scorer.score(together) == pytest.approx([scorer.score(a)[0] for a in alone])


def test_expectation_maximisation_finds_the_accuracies():
    r = np.random.default_rng(3)
    bad = r.random(20_000) < 0.3
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.75, 0.85, 0.9])
    right = r.random((len(bad), 8)) < accuracy
    votes = np.where(right, bad[:, None], ~bad[:, None]).astype(int)
    votes[r.random(votes.shape) < 0.2] = ql.SILENT
    patterns, n = np.unique(votes @ 3 ** np.arange(8), return_counts=True)
    model = ql.LabelModel(dict(zip(patterns.tolist(), n.tolist())), steps=200)
    assert model.prior[1] == pytest.approx(0.3, abs=0.03)
    said_bad = model.chances[1, :, ql.BAD] / (1 - model.chances[1, :, ql.SILENT])
    assert said_bad == pytest.approx(accuracy, abs=0.05)
    assert ((model.bad[votes @ 3 ** np.arange(8)] >= 0.5) == bad).mean() > 0.97


def test_frames(spark):
    good = "The quick brown fox jumps over the lazy dog and then it runs away from there. "
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, good * 3), (4, good * 3), (None, "SPAM!! BUY!! NOW!! " * 30), (6, good * 2000)]
    df = spark.createDataFrame([(k, t, 0.5, "_") for k, t in rows], "doc_id long, text string, quality double, _text string")
    model = ql.fit_label_model(df)
    out = ql.score_quality(df, model, ql.fit_scorer(df, model)).collect()
    assert out[0].__fields__ == ["doc_id", "text", "_text", "quality", "weak_label"] and len(out) == len(rows)
    score = {(r.doc_id, r.text): (r.quality, r.weak_label) for r in out}
    assert [score[k, t] for k, t in rows[:3]] == [(0.0, 0.0)] * 3
    assert score[4, good * 3][0] > 0.5 > score[None, "SPAM!! BUY!! NOW!! " * 30][0]
    empty = df.limit(0)
    model = ql.fit_label_model(empty)
    assert ql.score_quality(empty, model, ql.fit_scorer(empty, model)).collect() == []


def test_query_agrees_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in QUERIES["op8_quality"](spark, sf).collect()}
    gold = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    kept = [out[k].kept for k, q in gold.items() if q == 1]
    gone = [not out[k].kept for k, q in gold.items() if q == 0]
    assert np.mean(kept) > 0.98 and np.mean(gone) > 0.9
