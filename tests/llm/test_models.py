"""Language ID, quality and HTML extraction: brute force, held-out accuracy, fixtures."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.llm import html_text, language_id, quality, queries

from .cases import ROWS, documents, empty

SF = "/root/testdata/sf0.01"


def brute_phrases(codes, trained):
    """Greedy longest matches of the whole text."""
    n, i, held = 0, 0, {tuple(trained[a:b]) for a in range(len(trained)) for b in range(a + 1, min(len(trained), a + 80) + 1)}
    while i < len(codes):
        j = i + 1
        while j <= len(codes) and tuple(codes[i:j]) in held:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


TRAIN = (("de", "der die das und nicht aber auch schön größer über allen gipfeln ist ruh"), ("en", "the and not but also over all the hills there is rest in every tree"), ("fr", "le la les et ne pas mais aussi être où il est très bien déjà"))


def test_phrases_are_longest_matches(monkeypatch):
    """Of whole texts, wherever lanes end: lanes shorter than a phrase, too."""
    model = language_id.Model(TRAIN)
    texts = ["the tree is over there", "schön und größer", "漢字 x", "", "zzz qqq " * 200, "la rest und déjà vu " * 60, *(t for _, t in TRAIN), "über allen gipfeln ist ruh over all the hills " * 9]
    codes = [model.codes(t) for t in texts]
    wanted = [[brute_phrases(c.tolist(), model.codes(t).tolist()) for c in codes] for _, t in TRAIN]
    for block, few in ((512, 12), (64, 12), (64, 0), (7, 2), (3, 0), (3, 100)):
        monkeypatch.setattr(language_id, "BLOCK", block)
        monkeypatch.setattr(language_id.Edges, "FEW", few)
        assert model.phrases(codes).tolist() == wanted


def test_languages_of_many_letters():
    """Alphabets of hundreds of letters side by side, and letters that no language was trained with."""
    rng = np.random.default_rng(4)
    make = lambda first, n, size: "".join(chr(first + k) if k < n else " " for k in rng.integers(0, n + n // 5, size))
    blocks = {"am": (0x1200, 70), "yi": (0xA000, 1000), "ko": (0xAC00, 2000), "zh": (0x4E00, 3000)}
    model = language_id.Model(tuple((k, make(*v, 30_000)) for k, v in sorted(blocks.items())))
    for name, (first, n) in blocks.items():
        found = list(model.judge([make(first, n, 700) for _ in range(5)]))
        assert {x for x, _ in found} == {name} and min(s for _, s in found) > 0.5
    assert all(s < 0.51 for _, s in model.judge(["ภาษาไทยเป็นภาษา", "русский язык"]))  # phrases by themselves in all


def test_whole_result_of_language_id(spark):
    """The query's lang_pred and score against plain code that parses whole texts with substring searches."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    learned = language_id.learn(spark.createDataFrame([r for r in docs.values() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]))
    plain = lambda t: re.sub(r"[\W\d_]+", " ", t or "").lower()
    got = {r.doc_id: r for r in queries.op8_language_id(spark, sf).collect()}
    trained = {lang: plain(t) for lang, t in learned}
    for doc, r in docs.items():
        text, costs = plain(r.text), []
        if not any(c.isalpha() for c in text):
            assert got[doc].lang_pred == "und" and got[doc].score == 0
            continue
        for lang, own in sorted(trained.items()):
            i = n = 0
            while i < len(text):
                j, step = i + 1, 1
                while j + step <= len(text) and text[i : j + step] in own:
                    j, step = j + step, 1
                i, n = j, n + 1
            costs.append((n * np.log2(len(own)) / len(text), lang))
        costs.sort()
        assert got[doc].lang_pred == costs[0][1] and abs(got[doc].score - costs[1][0] / (costs[0][0] + costs[1][0])) < 1e-9


def test_training_rows_are_bounded_by_rows_only(spark):
    long = "lange worte und viele zeichen " * 70_000  # 2 MB
    rows = [(k, "kurz und gut" if k else long, "de") for k in range(5)] + [(None, "ohne nummer", "de")] * 30 + [(7, "noch ein text", "de"), (7, "und ein anderer", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (_, text), = language_id.learn(df)
    assert long in text and text.count("ohne nummer") == 1 and "noch ein text" in text and "und ein anderer" in text
    (_, text), = language_id.learn(df, docs=3)
    assert sum(map(text.count, ("kurz und gut", "ohne nummer", "noch ein text", "und ein anderer"))) + (long in text) == 3


def test_automaton_knows_every_substring():
    codes = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    a = language_id.SuffixAutomaton(codes)

    def known(part):
        state = 0
        for c in part:
            if c not in a.edges[state]:
                return False
            state = a.edges[state][c]
        return True

    parts = {tuple(codes[i:j]) for i in range(9) for j in range(i, 10)}
    import itertools

    for n in range(5):
        for p in itertools.product((1, 2, 3), repeat=n):
            assert known(p) == (p in parts)


def test_language_cases(spark):
    out = {r.doc_id: r for r in language_id.predict(documents(spark, True), TRAIN).collect()}
    assert [out[d].lang_pred for d in (4, 5, 9, 10)] == ["und"] * 4 and out[5].score == 0.0
    assert all(0 <= r.score <= 1 for r in out.values())
    assert language_id.predict(empty(spark), TRAIN).count() == 0
    assert {r.lang_pred for r in language_id.predict(documents(spark), ()).collect()} == {"und"}
    assert {r.score for r in language_id.predict(documents(spark).where("doc_id = 1"), TRAIN[:1]).collect()} == {1.0}
    assert language_id.learn(empty(spark)) == ()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op8_language_id(spark, SF).join(docs, "doc_id").collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) > 0.97


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op5_quality(spark, SF).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(labels[r.doc_id], r.predicted, r.score) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([y == p for y, p, _ in held]) > 0.93
    ones, zeros = [s for y, _, s in held if y == 1], [s for y, _, s in held if y == 0]
    assert np.mean([a > b for a in ones for b in zeros]) > 0.95


def test_quality_cases(spark):
    net = quality.train([b"good words here and there", b"### $$$ %%%"] * 20, np.array([1, 0] * 20, np.float32), epochs=6)
    out = quality.classify(documents(spark, True), net)
    assert out.count() == len(ROWS) and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.classify(empty(spark), net).count() == 0
    texts = [(t or "").encode() for _, t, _ in ROWS]
    alone = np.array([net.score([t])[0] for t in texts])
    assert np.allclose(net.score(texts), alone, atol=1e-5)  # batches don't matter
    assert np.allclose(quality.train([], np.zeros(0, np.float32)).score([b"x"]), 0.5)


def test_quality_trains_on_whole_texts_and_few_rows(spark, monkeypatch):
    """A long labelled text is trained on, and a repeated id is one row."""
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, wanted: seen.append((texts, wanted.tolist())))
    long = "many good words " * 140_000  # 2 MB
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, None), (4, "x"), (4, "x"), (4, "y")] + [(2, "short")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (4, 0), (4, 1), (5, 1), (None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    quality.learn(docs, labels, F.lit(True))
    texts, wanted = seen.pop()
    assert texts[:3] == [long.encode(), b"short", b""] and wanted == [1, 0, 1, 0, 1] and len(texts) == 5
    quality.learn(docs, labels, F.lit(True), rows=2)
    assert len(seen.pop()[0]) <= 2


def test_whole_result_of_quality(spark):
    """The query's scores against a plain convolution with the trained weights, text by text."""
    sf, nets = "/root/testdata/sf0.001", []
    train = quality.train
    try:
        quality.train = lambda texts, wanted: nets.append(train(texts, wanted, epochs=2)) or nets[-1]
        got = {r.doc_id: r for r in queries.op5_quality(spark, sf).collect()}
    finally:
        quality.train = train
    net, docs = nets[0], spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        text = (r.text or "").encode()
        flat = np.lib.stride_tricks.sliding_window_view(np.vstack([net.embed[list(text)], np.repeat(net.embed[:1], quality.WIDTH, axis=0)]), quality.WIDTH, axis=0)[: max(1, len(text))]
        response = np.einsum("tdw,wdf->tf", flat, net.filters)
        n_chunks = max(1, (len(text) + quality.WIDTH - 1) // 128)
        pooled = np.array([np.maximum(response[k * 128 : k * 128 + 256].max(axis=0) + net.shift, 0) if k * 128 < len(response) else np.zeros(quality.FILTERS) for k in range(n_chunks)])
        z = np.hstack([pooled.max(axis=0), pooled.mean(axis=0)]) @ net.out + net.bias[0]
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-z))) < 1e-4
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)


def brute_features(net, text):
    """Every window of every overlapping chunk."""
    padded = text + b"\0" * (quality.WIDTH - 1)
    response = np.array([sum(net.embed[padded[t + j]] @ net.filters[j] for j in range(quality.WIDTH)) for t in range(max(1, len(text)))]) if text else np.array([sum(net.embed[0] @ net.filters[j] for j in range(quality.WIDTH))])
    halves = (len(text) + quality.WIDTH - 1) // 128 + 1
    chunks = []
    for k in range(max(1, halves - 1)):
        part = response[k * 128 : k * 128 + 256]
        chunks.append(np.maximum(part.max(axis=0) + net.shift, 0) if len(part) else np.zeros(quality.FILTERS))
    return np.hstack([np.max(chunks, axis=0), np.mean(chunks, axis=0)])


@pytest.mark.parametrize("n", [0, 1, 100, 127, 128, 130, 255, 256, 700])
def test_pooling_covers_everything(n):
    net = quality.ByteNet(3)
    text = bytes(np.random.default_rng(n).integers(1, 255, n).tolist())
    assert np.allclose(net.features(quality.Layout([b"before", text, b"after" * 60]))[1], brute_features(net, text), atol=1e-4)


def test_gradients():
    net = quality.ByteNet(4)
    net.out += np.random.default_rng(0).normal(0, 0.3, net.out.shape).astype(np.float32)
    texts, wanted, weight = [b"some words in a row", b"### %% x" * 40], np.array([1.0, 0.0], np.float32), np.array([1.0, 2.0], np.float32)
    loss = lambda: float(np.mean(weight * -np.log(np.where(wanted == 1, net.score(texts), 1 - net.score(texts)))))
    found = net.gradients(texts, wanted, weight)
    for w, g in zip(net.weights, found, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        before, step = w[at], 1e-2
        w[at] = before + step
        up = loss()
        w[at] = before - step
        down = loss()
        w[at] = before
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-3


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a < b) document.write("<p>no</p>")</script><style>p{}</style></head><body class="single-post">
<div id="cookie-notice">We use cookies to give you the best experience on this site, whether you like it or not.</div>
<header class="site-header"><a href="/">Home of the great long site name with many words</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<main><article><h1>Title &amp; more</h1><p>First &eacute;&#233;   paragraph
with a <b>bold</b> word and a <a href=x>link</a>.<p>Tiny.<ul><li>point one<li>point two</ul><!-- <p>hidden</p> -->
<aside><h3>Also read these other long stories of today</h3><p>Sidebar words that are long enough to look like an article paragraph, honestly they are.</p></aside>
<form><label>Your mail</label><input name=m><button>Send it</button></form><div class="advert">Buy this now, it is cheap and good and everybody has one of them already.</div><p>Last 1 &lt; 2 paragraph</p></article></main>
<div class="comments"><p>I am a reader and I have very long opinions about this article which I share here.</p></div><footer>&copy; 2024 somebody, all rights are reserved by them for ever and ever.</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "Title & more\n\nFirst éé paragraph with a bold word and a link.\n\nTiny.\n\npoint one\n\npoint two\n\nLast 1 < 2 paragraph"
    assert html_text.main_text(PAGE[: PAGE.index("Last 1") + 4] + " &am<p cl").endswith("point two\n\nLast &am")
    for odd in ("", None, "<", "<!--", "<p", "</", "plain", "<article>x", "<script>never closed", "<article><p>a</article></p></div>b", "<table><tr><td>", "<![CDATA[x", '<a href="un"closed>x</a>'):
        assert isinstance(html_text.main_text(odd), str)
    assert html_text.main_text("<article>x") == "x"
    assert html_text.main_text("<article><p>" + "word " * 300_000 + "</article>").count("word") == 300_000


def test_tree_learns_the_table():
    x, y = html_text._sampled()
    assert (html_text.tree().predict(x) == (y > 0)).all() and len(y) > 100


def unnamed_page(r):
    """A page whose tags say nothing, with its labels."""
    block = lambda tag, x: f"<{tag}>{x}</{tag}>"
    link = lambda a, b: (lambda n: f"-{n}/{n}")(r.randint(a, b))
    box, out = r.choice(["p", "div"]), []
    if r.random() < 0.5:
        out.append(block("div", f"-{r.randint(12, 28)}"))
    out += [block(r.choice(["li", "div"]), link(1, 4)) for _ in range(r.randint(3, 8))]
    if r.random() < 0.5:
        out.append(block("div", f"-{r.randint(2, 10)}"))
    out.append(block("h1", f"+{r.randint(4, 12)}"))
    for _ in range(r.randint(3, 9)):
        k, n = r.random(), r.randint(18, 120)
        if k < 0.7:
            out.append(block(box, f"+{n}" + (f"/{r.randint(1, max(1, n // 12))}" if r.random() < 0.3 else "")))
        elif k < 0.85:
            out.append(block(box, f"+{r.randint(3, 16)}"))
        else:
            out += [block("h2", f"+{r.randint(2, 6)}"), block(box, f"+{r.randint(20, 60)}")]
    if r.random() < 0.6:
        out += [block("h3", f"-{r.randint(1, 4)}")] + [block("li", link(5, 12)) for _ in range(r.randint(2, 5))]
    else:
        out += [block("div", link(1, 4)) for _ in range(r.randint(2, 4))]
    if r.random() < 0.7:
        out.append(block("div", f"-{r.randint(3, 20)}"))
    return "".join(out)


def test_neighbours_carry_the_tree():
    """On pages whose tags say nothing, with and without the columns of tags; a block's own numbers alone do worse."""
    import random

    mark = re.compile(r"([+-])(\d+)(?:/(\d+))?(?=<)")
    rows = lambda pages: (lambda f: (np.vstack([html_text.table(b) for b in f]), np.array([x.text.startswith("in") for b in f for x in b])))([html_text.blocks(mark.sub(html_text._fill, p)) for p in pages])
    r = random.Random(1)
    x, y = rows([unnamed_page(r) for _ in range(200)])
    f1 = lambda p: 2 * (p & y).sum() / (p.sum() + y.sum())
    assert f1(html_text.tree().predict(x)) > 0.95
    plain_x, plain_y = rows(html_text.PLAIN)
    of = lambda names: [html_text.FEATURES.index(n) for n in names]
    without = [k for k in range(len(html_text.FEATURES)) if html_text.FEATURES[k] not in ("place", "within", "elsewhere")]
    assert f1(html_text.Tree(plain_x[:, without], plain_y).predict(x[:, without])) > 0.95
    own = of(("words", "density", "heading"))
    assert f1(html_text.Tree(plain_x[:, own], plain_y).predict(x[:, own])) < 0.92
    used = set()

    def walk(node):
        if not isinstance(node, float):
            used.add(html_text.FEATURES[node[0]])
            walk(node[2])
            walk(node[3])

    walk(html_text.tree().root)
    assert {"words before", "density before", "words after", "density after"} <= used


def test_hidden_elements_and_whole_names():
    article = lambda inner: html_text.main_text(f"<nav><a>Home</a></nav><article><h1>Title of it</h1><p>First words of the article.</p>{inner}<p>Last words of the article.</p></article><footer>Foot</footer>").split("\n\n")[2:-1]
    for gone in (
        '<p style="display: none">no <b>no</b></p>', "<p><span hidden>no</span></p>", '<p class="comment">no reader speaks here</p>', "<div aria-hidden=true><p>no</p><p>no</p></div>", "<p hidden>no",
        '<div style="visibility:hidden"><div>no</div>no</div>', '<div class="comment-list"><p>no</p></div>', '<div id="adSlot">no</div>', '<ul><li class="ad">no<li hidden>no</ul>', '<blockquote class="sponsored">no</blockquote>',
        '<div class="article-footer">no</div>', '<div class="related-posts"><p>no</p></div>',
    ):
        assert article(gone) == [], gone
    for kept in (
        '<section id="side-effects"><p>yes</p></section>', '<div class="related-work"><p>yes</p></div>', '<div class="no-ads has-sidebar"><p>yes</p></div>', '<p class="summary lead">yes</p>', "<div class='byline'>yes</div>",
        "<p hidden>no<p>yes</p>", "<ul><li hidden>no<li>yes</ul>", '<ul><li class="ad">no<li>yes</ul>', '<p aria-hidden="false">yes</p>', "<p class=comment>no</p><p>yes</p>", "<p><img hidden>yes</p>", '<div class="commentary">yes</div>', '<h2 class="menu-planning">yes</h2>',
    ):
        assert article(kept) == ["yes"], kept


def test_pages(spark):
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op9_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>|<[^>]*$", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, "u", None), (1, "u", PAGE), (2, None, "")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert {(r.page_id, r.n_chars > 0) for r in html_text.extract(odd).collect()} == {(1, False), (1, True), (2, False)}
    assert html_text.extract(odd.where("page_id = 9")).count() == 0
