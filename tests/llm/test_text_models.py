"""Language identification and main-text extraction."""

import html as html_text
import random
import re
import time
import zlib

import numpy as np
import pytest

from tagloom.llm import html_text as ht
from tagloom.llm import language as lg
from tagloom.llm.queries import QUERIES

# Language


def test_windows_cover_all_texts():
    r = random.Random(1)
    sizes = [0, 1, 3, 127, 128, 129, 253, 254, 255, 1000] + [r.randint(0, 2000) for _ in range(50)]
    offsets = np.cumsum([0, *sizes])
    starts, of = lg.windows(np.zeros(offsets[-1], np.uint8), offsets)
    widest = max(lg.WIDTHS)
    for i, size in enumerate(sizes):
        mine = starts[of == i] - offsets[i]
        assert len(mine) >= 1 and (mine[0] == 0)
        spans = {j for s in mine for j in range(s, s + lg.WINDOW - widest + 1)}
        assert set(range(max(0, size - widest + 1))) <= spans  # every widest filter's span lies in one window


def test_gradients(monkeypatch):
    """A training step lowers the loss, and two languages of different letters are told apart."""
    r = np.random.default_rng(2)
    x = np.full((200, lg.WINDOW), lg._PAD, np.int16)
    y = np.arange(200) % 2
    for i in range(200):
        x[i, :60] = r.choice([97, 98, 99, 32] if y[i] else [97, 101, 105, 32], 60)
    network = lg.ByteNetwork(["one", "two"])
    before = -np.log(network.probabilities(x)[np.arange(200), y]).mean()
    monkeypatch.setattr(lg, "STEPS", 60)
    network.train(x, y)
    after = -np.log(network.probabilities(x)[np.arange(200), y]).mean()
    assert after < 0.1 < before


def test_batches_do_not_matter():
    network = lg.ByteNetwork(["a", "b", "c"], seed=5)
    texts = ["", "x", "hello world " * 100, "é" * 300, "Z" * 129]
    raw = [t.encode() for t in texts]
    together = network.predict(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, t in enumerate(raw):
        alone = network.predict(np.frombuffer(t, np.uint8) if t else np.zeros(0, np.uint8), np.array([0, len(t)]))
        assert alone[0][0] == together[0][i] and alone[1][0] == pytest.approx(together[1][i], rel=1e-4)


def plain_probabilities(network, raw):
    """The network's answer for one text, one window, filter and place at a time."""
    step = lg.WINDOW - max(lg.WIDTHS) + 1
    total, weight = np.zeros(len(network.languages)), 0.0
    for start in range(0, max(1, len(raw) - max(lg.WIDTHS) + 1), step):
        window = [b + 32 if 65 <= b <= 90 else b for b in raw[start : start + lg.WINDOW]]
        window += [lg._PAD] * (lg.WINDOW - len(window))
        hidden = []
        for table, bias in zip(network.filters, network.bias):
            for f in range(lg.FILTERS):
                best = max(sum(float(table[k, window[i + k], f]) for k in range(len(table))) for i in range(lg.WINDOW - len(table) + 1))
                hidden.append(max(0.0, best + float(bias[f])))
        scores = [sum(h * float(network.out[k, c]) for k, h in enumerate(hidden)) + float(network.out_bias[c]) for c in range(len(total))]
        chances = np.exp(np.array(scores) - max(scores))
        letters = sum(97 <= b <= 122 or 128 <= b < 256 for b in window) + 1e-3
        total += chances / chances.sum() * letters
        weight += letters
    return total / weight


def test_predictions_equal_a_plain_forward_pass():
    network = lg.ByteNetwork(["a", "b", "c", "d"], seed=9)
    for table in network.filters:
        table[:, lg._PAD] = 0.1
    for text in ["", "X", "Hello World, " * 3, "Grüße aus Köln; " * 12, "漢字 und mehr 12" * 9]:
        raw = text.encode()
        best, score = network.predict(np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8), np.array([0, len(raw)]))
        want = plain_probabilities(network, raw)
        assert best[0] == want.argmax() and score[0] == pytest.approx(want.max(), rel=1e-4)


def test_every_language_is_learned(spark, monkeypatch):
    """300 languages of two rows and more, most beyond any number of frequent ones."""
    monkeypatch.setattr(lg, "STEPS", 200)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for n in range(300):
        word = letters[n % 26] + letters[(n // 26) % 26] + letters[(n * 7 + 3) % 26]
        rows += [(n * 100 + k, f"{word} " * (40 + k), f"l{n:03d}") for k in range(2 + (n % 5) * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    network = lg.fit_language_model(df, sample_total=3000)
    learned = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5}
    assert network.languages == sorted(learned) and len(learned) > 290
    assert lg.fit_language_model(df.limit(0)) is None


def test_language_frames(spark):
    texts = [(i, ("the cat and the dog of " * 9, "en") if i % 2 else ("der hund und die katze von " * 9, "de")) for i in range(60)]
    rows = [(i, t, l, "s", 0.5) for i, (t, l) in texts] + [(100, None, "en", "s", 1.0), (101, "", None, "s", 1.0), (102, "12 . 34", "de", "s", 1.0), (None, texts[1][1][0], None, None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, _letter string, score double").repartition(3)
    network = lg.fit_language_model(df)
    assert network.languages == ["de", "en"]
    out = lg.predict_language(df, network)
    assert out.columns == ["doc_id", "text", "lang", "_letter", "lang_pred", "score"]
    for r in out.collect():
        if r.text is None or not re.search("[a-z]", r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == ("en" if "cat" in r.text else "de") and 0.5 < r.score <= 1
    other = lg.predict_language(df.select("text").distinct(), network).collect()  # no id, source or label needed
    assert {(r.text, r.lang_pred) for r in other} == {(r.text, r.lang_pred) for r in out.collect()}
    assert lg.fit_language_model(df.where("lang is null")) is None
    assert {r.lang_pred for r in lg.predict_language(df, None).collect()} == {"und"}
    assert lg.predict_language(df.limit(0), network).collect() == []


def test_language_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    gold = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op2_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(gold)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in out)
    right = [r.lang_pred == gold[r.doc_id] for r in out if r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.98


# Main text


def article_text(page):
    """The article of the given pages, found by their one template."""
    inside = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)[1]
    return " ".join(html_text.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside))).split())


def test_html_query_on_all_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: (r.url, article_text(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = QUERIES["op9_html_text"](spark, sf).collect()
    assert {r.page_id: (r.url, r.text) for r in out} == pages and all(r.n_chars == len(r.text) for r in out)


def test_other_templates():
    long = "A sentence with quite a few words in it, as articles have. " * 6
    page = f"""<html><head><title>No</title><style>p{{}}</style></head><body class="page">
      <header><a href="/">Home</a> My site</header><ul class="main-menu"><li><a>One</a><li><a>Two</a></ul>
      <div id="cookieNotice">We use cookies, <a>agree</a></div><aside><p>{long}</p></aside>
      <div class="content"><h1>The &eacute;t&eacute;&nbsp;title</h1><p>{long}<p>Second <i>par</i>agraph<br>goes on
      <ul><li>a point</ul><form><input value=x>Sign up</form><script>if (1 < 2) {{ "</p>" }}</script>
      <div class="ad">Buy now</div><blockquote>{long}</blockquote></div>
      <div class="links"><a href=1>{long}</a><a href=2>more</a></div>
      <section class="comments"><p>{long}</p><p>{long}</p><p>{long}</p></section><footer>&copy; me</footer>"""
    text = " ".join(long.split())
    assert ht.main_text(page) == f"The été title {text} Second paragraph goes on a point {text}"


LONG = "A sentence with quite a few words in it, as articles have. " * 6
OTHERS = f"""<div class="sidebar"><p>{LONG}</p></div><div id="comments"><p>{LONG}</p><p>{LONG}</p></div><form>Sign up</form>"""


@pytest.mark.parametrize(
    "start", ["<form runat=server>", "<div class='has-sidebar'>", "<div id='no-comments'>", "<div class='content-sidebar-wrap'><div id=form1>", "<body class='x'><div class=share-page><form>"]
)
@pytest.mark.parametrize("headline", ["<h1>Title</h1>", ""])
@pytest.mark.parametrize("article", ["<div>{}</div>", "<article>{}</article>"])
def test_wrappers_with_other_names(start, headline, article):
    inner = article.format(f"{headline}<p>{LONG}</p><p>{LONG}</p>")
    text = f"{'Title ' if headline else ''}{LONG}{LONG}".strip()
    assert ht.main_text(f"<p>We</p>{start}{inner}{OTHERS}") == text
    assert ht.main_text(f"<article>{start}{headline}<p>{LONG}</p><p>{LONG}</p>{OTHERS}</article>") == text


def test_long_comments_stay_out():
    comments = f"<div class=comments>{f'<p>{LONG}</p>' * 9}</div>"
    for page in (f"<h1>Title</h1><div><p>{LONG}</p></div>{comments}", f"<div class=has-sidebar><h1>Title</h1><div><p>{LONG}</p></div>{comments}</div>"):
        assert "Title" not in ht.main_text(comments) and ht.main_text(page).count("A sentence") == 6


def test_lists_of_links_in_main_go():
    links = "<ul>" + "<li><a href=1>An other page</a>" * 20 + "</ul>"
    for tag in ("main", "article", "div"):
        assert ht.main_text(f"<{tag}><h1>Title</h1><div><p>{LONG}</p><p>{LONG}</p><p>See <a>this</a> page</div>{links}</{tag}>").endswith("See this page")


def test_formulas_stay():
    formula = "<math><mi>x</mi><mo>=</mo><mn>2</mn></math>"
    page = f"<article><p>Let {formula} be. {LONG}</p><p>{LONG}</p></article>"
    assert ht.main_text(page).startswith("Let x=2 be. A sentence")


@pytest.mark.parametrize("tag", ["<div>", "<span>", "<p>x", "<li>x", "<b><div>", "<table><tr><td>", "</div><div><i>", "<article><header>"])
def test_many_open_tags_are_read_in_linear_time(tag):
    start = time.time()
    assert isinstance(ht.main_text(tag * 200_000), str)
    assert time.time() - start < 60


def reference_ends(html):
    """The elements of a page as ``(tag, parent)`` with every end looked up in the whole list of open ones."""

    class Slow(ht.Page):
        def _end(self, names, until):
            for depth in range(len(self.open) - 1, 0, -1):
                tag = self.tags[self.open[depth]]
                if tag in names:
                    return self._close_to(depth)
                if tag in until:
                    return None
            return None

    page = Slow(html)
    return list(zip(page.tags, page.parents)), page.texts


def test_open_elements_are_found_as_by_looking_at_all():
    r = random.Random(8)
    names = ["p", "div", "b", "a", "ul", "li", "table", "tr", "td", "th", "dl", "dt", "dd", "article", "header", "span", "button", "select", "option"]
    for _ in range(3000):
        html = "".join(r.choice(["<{}>", "</{}>", "<{}>x"]).format(r.choice(names)) for _ in range(r.randint(1, 40)))
        page = ht.Page(html)
        assert (list(zip(page.tags, page.parents)), page.texts) == reference_ends(html), html


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- open", "&", "&amp", "<script>x", "</p></div>", "<a><a><a>" * 50, "<div>" * 5000])
def test_broken_pages_do_not_crash(page):
    assert isinstance(ht.main_text(page), str)


def test_html_frames(spark):
    page = "<body><p>Hello &lt;you&gt;\n\n  there</p><nav>no</nav>"
    rows = [(1, None), (2, ""), (3, page), (3, page), (None, "<p>" + "word " * 50_000), (5, "plain &amp; simple")]
    df = spark.createDataFrame([(k, h, "x", 1) for k, h in rows], "page_id long, html string, main_text string, n_chars int").repartition(3)
    out = ht.extract_main_text(df)
    assert out.columns == ["page_id", "html", "n_chars", "main_text"]
    want = ["", "", "Hello <you> there", "Hello <you> there", ("word " * 50_000).strip(), "plain & simple"]
    assert sorted((r.html or "", r.main_text) for r in out.collect()) == sorted((h or "", w) for (_, h), w in zip(rows, want))
    assert ht.extract_main_text(df.limit(0)).collect() == []


def test_density_prefers_text_to_links():
    page = ht.Page("<body><div><a>one two three</a><a>four five six</a></div><div><p>one two three four five six</p></div></body>")
    density = dict(zip(page.tags, ht.densities(page)))
    assert density["p"] > density["a"]
