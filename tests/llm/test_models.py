"""Nearest neighbours, language ID and HTML text: recall, gradients, held-out accuracy, small pages."""

import zlib

import numpy as np

from segmetrics.llm import langid
from segmetrics.llm.ann import nearest
from segmetrics.llm.html_text import Rules, extract_text, main_blocks
from segmetrics.llm.langid import Network, fit, pooled, predict
from segmetrics.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# nearest neighbours -----------------------------------------------------------

def brute(rows, nth=20, n=20):
    """Of each query id its neighbours; rows: (id, vector)."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % nth == 0:
            s = sorted((-float(v[:len(x)] @ x[:len(v)]), i) for i, v in ok if i != q)
            out[q] = [(i, -a) for a, i in s[:n]]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def test_neighbours_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{MIDDLE}/embeddings.parquet").collect()]
    got, want = by_query(QUERIES["op7_nearest_neighbours"](spark, MIDDLE)), brute(rows)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert recall(got, want) >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, s in found:
            assert i != q and abs(np.dot(np.array(vectors[q]), np.array(vectors[i])) - s) < 1e-12


def test_isolated_queries_are_served_too(spark):
    """Clustered vectors with a few far from every cluster: no query is left with few of its neighbours."""
    g = np.random.default_rng(12)
    centres = g.normal(size=(30, 24))
    x = centres[g.integers(0, 30, 3000)] + g.normal(size=(3000, 24)) * 0.08
    alone = [20 * i for i in range(0, 12)]
    x[alone] = g.normal(size=(12, 24)) * 1.3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = by_query(nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), brute(rows)
    each = sorted(len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items())
    assert np.mean(each) >= 0.95 and np.mean(each[:len(each) // 10]) >= 0.9 and all(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) >= 18 for q in alone)


def test_probability_of_being_met_falls_with_the_distance():
    from segmetrics.llm.ann import Index, met

    index = Index(16, 1.0, 6)
    p = met(index, 40, np.array([0.05, 0.3, 0.8, 1.4, 2.0]))
    assert p[0] > 0.99 and all(a >= b - 0.02 for a, b in zip(p, p[1:])) and p[-1] < p[0]
    g = np.random.default_rng(4)
    q = g.normal(size=(200, 16))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    u = g.normal(size=(200, 16))
    u -= (u * q).sum(1, keepdims=True) * q
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    angle = 2 * np.arcsin(0.8 / 2)
    x = np.cos(angle) * q + np.sin(angle) * u                                        # at distance 0.8 of q
    hit = np.zeros(200, bool)
    for t in range(8):
        own = index.buckets(np.floor(index.places(x, False, t)))
        hit |= (index.probes(q, t, 40) == own[:, None]).any(1)
    assert abs(hit.mean() - p[2]) < 0.12


def test_neighbours_odd(spark):
    g = np.random.default_rng(3)
    rows = [(i, (g.normal(size=4) * g.uniform(0.1, 9)).tolist()) for i in range(1, 30)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(40, 110)]                       # one very common vector
    rows += [(120, None), (140, []), (160, [0.0] * 4), (180, [1.0, None, 0.0, 0.0]), (200, [float("nan"), 1.0, 0.0, 0.0]),
             (220, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), (240, [5.0]), (20, rows[19][1])]
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<double>, rep long")
    seen = dict(rows)
    got, want = by_query(nearest(df)), brute(list({(i, tuple(v) if v else None) for i, v in rows}))
    assert set(got) == set(want) == {20, 40, 60, 80, 100, 240}
    assert recall(got, want) >= 0.9
    for q in (40, 60):
        same = [i for i, s in got[q] if seen[i] == seen[q]]
        assert same == [i for i, _ in want[q] if seen[i] == seen[q]]
    assert nearest(df.limit(0)).count() == 0
    assert by_query(nearest(df.filter("vec_id in (20, 3)").dropDuplicates(["vec_id"])))[20][0][0] == 3


# language ID -------------------------------------------------------------------

def test_gradients():
    g = np.random.default_rng(0)
    net = Network.start(3, hidden=3)
    x, y = g.integers(0, 256, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grads = net.loss(x, y)
    for w, dw in zip(net.weights(), grads):
        for at in zip(*(g.integers(0, s, 8) for s in w.shape)) if w.shape[0] != 256 else [(int(b), j) for b in x.ravel()[:6] for j in (0, 4, 8)]:
            old = w[at]
            w[at] = old + 1e-6
            up = net.loss(x, y)[0]
            w[at] = old - 1e-6
            down = net.loss(x, y)[0]
            w[at] = old
            assert abs((up - down) / 2e-6 - dw[at]) < 1e-5


def test_pooling_is_the_mean_over_all_bytes(monkeypatch):
    monkeypatch.setattr(langid, "LANES", 5)
    net = Network.start(3).single()
    g = np.random.default_rng(1)
    texts = [bytes(g.integers(97, 123, n).astype(np.uint8)) for n in (1, 0, 127, 128, 129, 700, 2000)]
    got = pooled(net, texts)
    for t, p in zip(texts, got):
        want = np.zeros(3)
        for lo in range(0, len(t), langid.WINDOW):
            x = np.frombuffer(t[lo:lo + langid.WINDOW], np.uint8)[:, None]
            (f, b), _ = net.states(x)
            a = np.concatenate((f, b), 1)[:, :, 0] @ net.out.T + net.bias
            e = np.exp(a - a.max(1, keepdims=True))
            want += (e / e.sum(1, keepdims=True)).sum(0)
        assert np.allclose(p, want / max(1, len(t)), atol=2e-3)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op10_language_id"](spark, MIDDLE).collect()}
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    assert len(rows) == len(docs)
    ok = []
    for d in docs:
        out = zlib.crc32(str(d.doc_id).encode()) % 3 == 1
        assert rows[d.doc_id].held_out == out and 0 <= rows[d.doc_id].score <= 1
        if out and d.lang is not None and rows[d.doc_id].lang_pred != "und":
            ok.append(rows[d.doc_id].lang_pred == d.lang)
    assert len(ok) > 200 and sum(ok) / len(ok) > 0.95


def test_many_languages_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_TOTAL", 80)
    words = [f"{chr(97 + k // 8)}{chr(97 + k % 8)}z" for k in range(70)]
    df = spark.createDataFrame([(70 * i + k, f"{w} " * 40, w) for i in range(4) for k, w in enumerate(words)], "doc_id long, text string, lang string")
    net, languages = fit(df)
    assert languages == sorted(words) and len(net.bias) == 70
    assert {r.lang_pred for r in predict(df, net, languages).collect()} <= set(words)


def test_language_odd(spark):
    rows = [(7, "½ ²", "de"), (8, "Ⅷ ٣", "en"), (1, None, "en"), (2, "", None), (3, "12 + 34", "en"), (4, "the and of " * 30_000, "en"), (None, "le la les", "fr"), (6, "ü", None)]
    df = spark.createDataFrame([(i, t, x, "k") for i, t, x in rows], "doc_id long, text string, lang string, score string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in predict(df, *fit(df)).collect()]
    assert {i: p for i, p, _ in got if i in (1, 2, 3, 7, 8)} == dict.fromkeys((1, 2, 3, 7, 8), "und") and len(got) == 8
    assert predict(df.limit(0), *fit(df.limit(0))).count() == 0


# HTML ----------------------------------------------------------------------------

def test_pages():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
            "<!-- <p>no</p> --><div class='ad'>Buy <div>now</div></div><article><h1>Head &amp; line</h1><p><b>Bold\n  text<br>next&nbsp;one<br><p>Be.</p>"
            "<div id=\"share-bar\">share</div><form><p>mail?</p></form><aside>side</aside><p>a <a href=x>link</a> &lt;p&gt; 1 < 2</p>"
            "<section class='comments'><p>first!</p></section></article><footer>&copy; x</footer></body></html>")
    assert main_blocks(page) == ["Head & line", "Bold text next one", "Be.", "a link <p> 1 < 2"]


def test_pages_without_an_article():
    long = "The cat and the dog of the house went to the river and it was the best day for all of them in the world. " * 3
    page = (f"<body><div><a href=/>Home</a> <a href=/b>About us and them</a></div><h2>A title</h2><div>{long}</div><p>Short.</p><div>{long}</div>"
            "<div>zzz qqq xxx yyy www vvv uuu ttt sss rrr zzz qqq xxx yyy www vvv uuu ttt sss rrr</div><p>End.</p></body>")
    got = main_blocks(page)
    assert got == [long.strip(), "Short.", long.strip()]
    assert main_blocks("plain text only") == ["plain text only"] and main_blocks("") == [] and main_blocks("<p") == ["<p"]


def test_page_table(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<article><p>x</p></article>"), (3, "u", "<div>" * 3000 + "deep" + "<" * 3000 + '<a b="' * 500)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = extract_text(df, Rules(), keep=["url"]).collect()
    assert [r.text for r in got if r.page_id is None] == ["x"] and sum(r.text == "" for r in got) >= 3 and len(got) == 5
    assert extract_text(df.limit(0)).count() == 0
    whole = QUERIES["op4_html_text"](spark, SMALL).collect()
    assert len(whole) == spark.read.parquet(f"{SMALL}/pages.parquet").count() and all(r.n_chars == len(r.text) > 0 for r in whole)


def test_text_is_the_article_of_each_page(spark):
    """On the given pages the article element is the main text: compare with a plain reading of it."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in QUERIES["op4_html_text"](spark, SMALL).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))]
        assert r.text == "\n".join(filter(None, blocks))


def test_long_attributes_and_names_in_values():
    long = "x" * 5000
    assert main_blocks(f"<article><p>one<img src=\"data:{long}\"> two</p><script data-a='{long}'>var a = 1;</script><div data-b=\"{long}\"><p>three</p></div><p>four</p></article>") == [
        "one two", "three", "four"]
    for attrs in ("style='overflow:hidden'", "title=\"the hidden class=ad\"", "data-x=?id=search", "class=overflow-hidden", "class='no-comments has-sidebar'"):
        assert main_blocks(f"<article><div {attrs}><p>one</p></div><p>two</p></article>") == ["one", "two"], attrs
    for attrs in ("hidden", "class=ad", "class='x sidebar'", "id=\"comments\"", "role=search", "data-x='a' aria-hidden=true"):
        assert main_blocks(f"<article><div {attrs}><p>one</p></div><p>two</p></article>") == ["two"], attrs
    body = "The cat and the dog of the house went to the river and it was the best day for all of them in the world."
    assert main_blocks(f"<body><div class='page sidebar-left'><div class=sidebar>links</div><article><p>{body}</p><div class=share>share</div></article></div></body>") == [body]
    assert main_blocks(f"<body><article><p>two</p></article><div class=comments><p>{body}</p></div></body>") == ["two"]


def test_tags_are_scanned_in_linear_time():
    import time

    start = time.time()
    for piece in ("<a b=\"", "<a '\"", "<a '\"x", "<a b='\"' ", "<", "<a \"<a '", "<!x"):
        main_blocks(piece * (200_000 // len(piece)))
        main_blocks("\"'" + piece * (200_000 // len(piece)) + "'")
    assert time.time() - start < 20


def test_blocks_outside_the_article_and_links_in_it():
    body = "The cat and the dog of the house went to the river and it was the best day for all of them in the world. " * 3
    links = "".join(f"<li><a href=/{i}>Linked story number {i}</a></li>" for i in range(4))
    page = f"<body><article><p>A teaser.</p></article><nav>x</nav><h2>Head</h2><div>{body}</div><p>Last.</p><article><p>One.</p><ul>{links}</ul></article></body>"
    assert main_blocks(page) == ["A teaser.", "Head", body.strip(), "Last.", "One."]
    assert main_blocks(f"<article><h2><a href=/>Linked head</a></h2><p><a href=/>One link.</a></p><p>Text.</p></article><div>Printed today</div>") == ["Linked head", "One link.", "Text."]


def test_the_first_pass_decides_about_articles_too(spark, monkeypatch):
    """Article or not, it is the labels of the first pass that count: all boilerplate leaves nothing, all text leaves the links in."""
    from segmetrics.llm import html_text

    pages = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    links = "".join(f"<li><a href=/{i}>Linked story number {i}</a></li>" for i in range(4))
    body = "The cat and the dog of the house went to the river and it was the best day for all of them in the world. " * 3
    mixed = f"<body><article><ul>{links}</ul><p>Read on</p><ul>{links}</ul><p>A teaser.</p></article><div>{body}</div><p>Behind it.</p><div>{body}</div></body>"
    assert main_blocks(mixed) == ["A teaser.", body.strip(), "Behind it.", body.strip()]
    monkeypatch.setattr(html_text, "decide", lambda *a: "boilerplate")
    assert not any(main_blocks(p) for p in pages) and main_blocks(mixed) == []
    monkeypatch.setattr(html_text, "decide", lambda *a: "text")
    assert len(main_blocks(mixed)) == 13


def test_many_open_elements_are_closed_in_linear_time():
    import time

    start = time.time()
    for piece in ("<div>a</b>", "<div hidden>a</i>", "<p>a<span class=ad></b></i>"):
        main_blocks(piece * 40_000)
    assert time.time() - start < 20


def test_edge_blocks_and_other_languages():
    body = "The cat and the dog of the house went to the river and it was the best day for all of them in the world. " * 3
    assert main_blocks(f"<nav>Home</nav><h1>Head</h1><div>{body}</div><p>End.</p><footer>foot</footer>") == ["Head", body.strip(), "End."]
    finnish = "Kissa ja koira menivät yhdessä joelle sekä metsään, koska aurinko paistoi kirkkaasti eikä kukaan halunnut jäädä kotiin. " * 3
    italian = "Il gatto è andato con il cane della casa al fiume e non si è fermato per la pioggia che è caduta di notte in città. " * 3
    for text in (finnish, italian):
        assert main_blocks(f"<div><a href=/>Home</a> <a href=/b>About</a></div><div>{text}</div><p>Loppu.</p>") == [text.strip(), "Loppu."]
