"""Posting lists, language ID, HTML extraction and the pipeline."""

import math
import time
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, postings
from strata.llm.langid import Tagger, held_out, identify, train_on, windows_of
from strata.llm.mainparts import Page, extract, winning_paths
from strata.llm.postings import CentroidGraph, fit_centroids, search
from strata.llm.vectors import valid_vectors

from .conftest import prose
from .test_dedup import VECTOR_SCHEMA, brute_fingerprint, brute_repeats, groups, valid, vectors_with_copies


def brute_nearest(rows, queries, k):
    use = {}
    for i, v in rows:
        use.setdefault(i, []).append(v)
    out = set()
    for q, v in queries:
        near = sorted((min(math.sqrt(((np.array(x) - v) ** 2).sum()) for x in xs if len(x) == len(v)), i)
                      for i, xs in use.items() if i != q and any(len(x) == len(v) for x in xs))
        out |= {(q, n + 1, i) for n, (_, i) in enumerate(near[:k])}
    return out


def test_search_edges(spark, monkeypatch):
    monkeypatch.setattr(postings, "PART_ROWS", 20)  # lists of copies are split
    rows = vectors_with_copies()
    vectors = valid_vectors(spark.createDataFrame(rows, VECTOR_SCHEMA).repartition(3))
    use = [(i, np.array(v, np.float64)) for i, v, _ in rows if i is not None and valid(v)]
    got = search(vectors, vectors.where("vec_id % 100 = 0"))
    want = brute_nearest(use, [(i, v) for i, v in use if i % 100 == 0], 10)
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()} == want
    assert got.where("score is null or score < 0").count() == 0
    few = vectors.where("vec_id in (1, 100, 4006)")
    assert {tuple(r)[:3] for r in search(few, few.where("vec_id = 100")).collect()} == {(100, 1, 1)}
    assert search(vectors.limit(0), vectors.limit(0)).count() == 0


def found_of(spark, rows):
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in search(vectors, vectors.where("vec_id % 100 = 0")).collect()}
    use = [(i, np.array(v, np.float64)) for i, v in rows]
    return got, brute_nearest(use, [(i, v) for i, v in {i: v for i, v in use if i % 100 == 0}.items()], 10)


def test_search_counts_ids_not_rows(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(300, 16)).astype(np.float32)
    once = [(i, v.tolist()) for i, v in enumerate(x)]
    for rows in (
        once * 2,  # every row twice
        once + [(7, (x[100] + 0.01 * r.normal(size=16)).astype(np.float32).tolist()) for _ in range(60)],  # one id, near a query
        once + [once[7]] * 150,  # one id holds a third of the rows, all equal
    ):
        got, want = found_of(spark, rows)
        assert got == want and len(got) == 30


def test_search_reads_lists_until_they_hold_k_ids(spark, monkeypatch):
    monkeypatch.setattr(postings, "LIST_ROWS", 5)
    r = np.random.default_rng(8)
    # around the query lie 600 vectors of one id, all others far away
    rows = [(100, [1.0] + [0.0] * 7)] + [(1, (r.normal(size=8) * 0.1 + np.eye(8)[0]).astype(np.float32).tolist()) for _ in range(600)]
    rows += [(200 + k, (r.normal(size=8) * 0.1 + 30 * np.eye(8)[1]).astype(np.float32).tolist()) for k in range(1, 30)]
    got, want = found_of(spark, rows)
    assert got == want and len(got) == 10


def test_recall_and_scores(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(6000, 32)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    vectors = valid_vectors(frame)
    got = search(vectors, vectors.where("vec_id % 100 = 0")).collect()
    use = [(i, v.astype(np.float64)) for i, v in enumerate(x)]
    hits = 0
    for q in range(0, 6000, 100):
        d = np.sqrt(((x.astype(np.float64) - use[q][1]) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(x)), d))[:10]
        own = {g["vec_id"]: g["score"] for g in got if g["query_id"] == q}
        assert len(own) == 10 and all(abs(d[i] - s) < 1e-12 for i, s in own.items())
        hits += len(set(want.tolist()) & own.keys())
    assert hits >= 0.95 * 600


def test_graph_meets_the_nearest_centroids():
    r = np.random.default_rng(2)
    x = r.normal(size=(3000, 16))
    graph = CentroidGraph(fit_centroids(x, 200))
    assert 150 <= len(graph.c) <= 200
    dist, chosen = graph.search(x[:200], 1.2, 8)
    real = np.sqrt(((x[:200, None] - graph.c[None]) ** 2).sum(axis=2))
    within = real <= 1.2 * real.min(axis=1, keepdims=True)
    assert (chosen & within).sum() >= 0.98 * within.sum()
    assert len(fit_centroids(np.zeros((50, 4)), 10)) == 1


def test_backpropagation_matches_differences():
    tagger = Tagger(["a", "b", "c"], hidden=3)
    for o in (tagger.ahead, tagger.back):
        o.x, o.u = o.x.astype(np.float64), o.u.astype(np.float64)
    tagger.v, tagger.bias = tagger.v.astype(np.float64), tagger.bias.astype(np.float64)
    r = np.random.default_rng(3)
    windows = r.integers(97, 101, (4, 12)).astype(np.uint8)
    labels = np.array([0, 1, 2, 1])

    def loss():
        p = tagger._softmax(tagger._states(np.ascontiguousarray(windows.T))[0])
        return -np.log(p[:, np.arange(4), labels]).mean()

    grads = tagger.step(windows, labels)
    for p, g in zip(tagger.params(), grads):
        for _ in range(4):
            at = (97 + r.integers(4), *(int(r.integers(n)) for n in p.shape[1:])) if p.shape[0] == 256 else tuple(int(r.integers(n)) for n in p.shape)
            old = p[at]
            p[at] = old + 1e-3
            up = loss()
            p[at] = old - 1e-3
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 2e-4


def test_prediction_edges(spark, edge_docs, no_docs):
    r = random.Random(1)
    syllables = {"xx": "ka ri mo ta nu".split(), "yy": "schl ung ötz ver eit".split()}
    word = lambda lang: "".join(r.choice(syllables[lang]) for _ in range(3))
    rows = [(i, " ".join(word(lang) for _ in range(30)), lang) for i in range(200) for lang in [("xx", "yy")[i % 2]]]
    rows += [(1000, "unlabelled text", None), (1001, None, "xx"), (None, rows[0][1], "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tagger = train_on(docs)
    assert tagger.languages == ["xx", "yy"]
    got = identify(docs, tagger, keep=("doc_id", "lang")).withColumn("held", held_out()).collect()
    assert len(got) == len(rows)
    known = [g for g in got if g["lang"] and g["doc_id"] != 1001]
    assert all(g["lang"] == g["lang_pred"] and 0.5 < g["score"] <= 1 for g in known)
    assert any(g["held"] for g in got) and not any(g["held"] for g in got if g["doc_id"] is None)
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(edge_docs, tagger, keep=("doc_id",)).collect()}
    assert all(odd[d] == ("und", 0.0) for d in (1, 2, 3, 19, 20)) and odd[15][0] != "und"
    assert train_on(no_docs).languages == []
    assert identify(docs, Tagger([]), keep=("doc_id",)).where("lang_pred <> 'und'").count() == 0
    assert identify(no_docs, tagger).count() == 0


def test_every_byte_is_in_one_window_and_pooled():
    texts = [b"", b"a" * 64, b"b" * 65, "é".encode() * 100]
    windows, counts = windows_of(texts)
    assert counts.tolist() == [0, 1, 2, 4] and windows.shape == (7, 64)
    tagger = Tagger(["p", "q"])
    _, scores = tagger.predict(texts)
    probabilities = tagger._softmax(tagger._states(np.ascontiguousarray(windows[1:3].T))[0])
    flat = probabilities.transpose(1, 0, 2).reshape(-1, 2)[:65]
    assert scores[2] == pytest.approx(flat.mean(axis=0).max(), abs=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(docs, train_on(docs), keep=("doc_id", "lang")).where(held_out())
    right, n = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 100 and right >= 0.97


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var a="</p><p>no";</script></head>
<body class="page sidebar-right"><header><a href="/">Site</a></header><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, and more cookies, on every page you read here.</p></div>
<div id="wrap"><div class="%s">%s</div><aside><p>Popular, new, and other things to read on this site today.</p></aside></div>
<div id="comments"><p>First! I like this article, really, it is the best article.</p></div>
<form><p>Your name, please, and your e-mail address</p></form><!-- <p>hidden</p> --><footer>&copy; 2024</footer></body></html>"""
ARTICLE = """<h1>Heading</h1><p>One  fish,\n two &lt;fish&gt; &eacute;&#33;<br>three<p>Red <b>fish, <i>blue</b> fish &amp; so on, and on.
<div class="ad-slot"><p>Buy, buy, buy this now.</p></div><ul><li>first item<li>second</ul><noscript>no</noscript>"""
TEXT = "Heading\nOne fish, two <fish> é! three\nRed fish, blue fish & so on, and on.\nfirst item\nsecond"


def test_one_page():
    assert Page(PAGE % ("post-12 content", ARTICLE)).text(None) == TEXT


@pytest.mark.parametrize("source", ["", " ", "plain <text", "<p>a<p", "<", "<<<>>>", "</p></div>x", "<!-- open", "<script>x", "&#xZZ; &bogus;",
                                    "<a " + 'b="' * 500, "<div>" * 3000 + "deep, deep text" + "</div>" * 10])
def test_broken_pages(source):
    assert isinstance(Page(source).text(None), str)


def test_extract_by_consensus(spark):
    long = "<p>" + "A sentence, with commas, of some length that counts as text. " * 6 + "</p>"
    odd = PAGE % ("post-99 content", "<p>Tiny.</p>") + "<div class=teaser>" + long + "</div>"
    rows = [(k, f"https://A.example.com:80/{k}", PAGE % (f"post-{k} content", ARTICLE + long)) for k in range(5)]
    rows += [(10, "http://user@a.example.com/odd", odd), (11, None, None), (12, "", ""), (13, "nonsense", "<p>only</p>"), (None, "x://b/", PAGE % ("c", ARTICLE)),
             (14, "https://a.example.com/none", "<html><body><article><p>Other template, same host.</p></article></body></html>")]
    pages = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string").repartition(3)
    won = {r["host"]: r["path"] for r in winning_paths(pages).collect()}
    assert won["a.example.com"].startswith("html>body.page.sidebar-right>div>div.content.post-#")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    assert got[0]["text"].startswith(TEXT) and got[10]["text"] == "Tiny."  # the host's path, not the page's own best
    assert got[14]["text"] == "Other template, same host." and got[13]["text"] == "only"
    assert got[11]["text"] == got[12]["text"] == "" and got[None]["text"] == TEXT
    assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and len(got) == len(rows)
    assert extract(pages.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    passage = prose(77, 55)
    rows = [(i, prose(300 + i, 90 + i), "en", "s", 1) for i in range(40)]
    rows += [(50, rows[0][1], "en", "s", 1), (51, rows[0][1].upper(), "en", "s", 1), (52, None, "en", "s", 1), (53, "123 !!", "en", "s", 1)]
    rows += [(60 + k, f"{prose(400 + k, 30)} {passage} {prose(500 + k, 20)}", "en", "s", 1) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "packing"]
    kept, before = docs, [(r[0], r[1]) for r in rows]
    for name, stage in pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, "").collect(), docs.schema)
        assert kept.columns == docs.columns
        after = sorted((r["doc_id"], r["text"]) for r in kept.collect())
        if name == "language_id":
            want = sorted(x for x in before if x[0] not in (52, 53))
        elif name == "simhash_dedup":
            fps = [brute_fingerprint(t) for _, t in before]
            find = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
            want = sorted({g: min(x for x, f in zip(before, find) if f == g) for g in find}.values())
            assert len(want) == len(before) - 2
        else:
            cut = brute_repeats([t for _, t in before], 35)
            want = sorted((d, t if not n else k) for (d, t), (_, n, k) in zip(before, cut))
            assert sum(n for _, n, _ in cut) >= 3 * 55
            assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
        assert after == want
        before = after
    pieces = pipeline.STAGES[-1][1](spark, kept, "").collect()
    assert Counter(r["doc_id"] for r in pieces).keys() == {d for d, _ in before}


@pytest.mark.parametrize("body, want", [
    ("<div id=main-nav><a href=/>Home</a></div><div class='entry-content'><div class='article-header'><h1>Title</h1></div>"
     "<p class=byline>By Ann</p><p>Text one.</p><table><tr><td>cell</td></tr></table></div><div class='sideBar'><p>More</p></div>",
     "Title\nBy Ann\nText one.\ncell"),
    ("<main><h1>T</h1><p>A&nbsp;b<!-- x -->c<script>no()</script>d</p><section id=comments><article><p>First, really!</p></article></section>"
     "<div role=alert><p>Notice me</p></div></main>", "T\nA bcd"),
    ("<nav>menu</nav><h1>Flat</h1><p>One, two, three.</p><p hidden>gone</p><footer><p>end</p></footer>", "Flat\nOne, two, three."),
    ("<ARTICLE><P>Upper<BR/>case<UL><LI>x<LI>y</UL></ARTICLE><div class='advert ad-1'>ad</div>", "Upper case\nx\ny"),
    ("<div class=wrap><div class=text><p>Part one, of the text.</p></div><div class=ad><p>buy</p></div><div class=text><p>Part two, of it.</p>"
     "<form><p>Sign up, now</p><input name=a></form></div></div>", "Part one, of the text.\nPart two, of it."),
])
def test_parts_of_pages(body, want):
    assert Page(f"<html><head><title>no</title></head><body>{body}</body></html>").text(None) == want


@pytest.mark.parametrize("body, want", [
    ("<header><svg-icon name=logo></svg-icon><title-bar>Site</title-bar></header><article><p>One, two.</p><p>Three.</p></article>"
     "<footer><svg><text>no</text></svg></footer>", "One, two.\nThree."),
    ("<article><p>One, two.</p><select-menu><p>Three.</p></select-menu><template-x></template-x><p>Four <svg-icon id=a/>five.</p></article>",
     "One, two.\nThree.\nFour five."),
    ("<nav><svg viewBox='0 0 1 1'/></nav><article><p>One <svg class=\"a>b\" />two.</p><p>x<math/>y</p><svg\n><text>no</text></svg ><p>End.</p></article>",
     "One two.\nx y\nEnd."),
    ("<article><p>One <svg data-x='a/>b'><path d='M0'/><text>no</text></svg>two.</p><object data=x/>no</object><p>End.</p></article>", "One two.\nEnd."),
])
def test_names_that_begin_like_skipped_elements(body, want):
    assert Page(f"<html><head><title>no</title></head><body>{body}</body></html>").text(None) == want


LONG = "<p>" + "One sentence, of some length, that counts as text here. " * 3 + "</p>"
LONG_TEXT = " ".join(LONG[3:-4].split())


@pytest.mark.parametrize("attribute", [
    'class="content has-sidebar"', 'id="page-with-sidebar"', 'class="article social-science"', 'class="search-engine-story"',
    'class="layout-sidebar-right"', 'class="post comments-open"', "hidden", "style='display: none'", 'class="article-header"',
    'class="no-sidebar widget-free"', 'role="search"', 'class="ad-free reading"', "aria-hidden=true", 'data-id="ad" class="x"'])
def test_a_mark_on_what_holds_the_article(attribute):
    page = f"<html><body><nav>x</nav><div {attribute}>{LONG}{LONG}</div><div class=sidebar><p>More, here.</p></div><footer>f</footer></body></html>"
    assert Page(page).text(None) == f"{LONG_TEXT}\n{LONG_TEXT}"


@pytest.mark.parametrize("part", [
    "<div class=sidebar-inner>%s</div>", "<div id=comment-list>%s</div>", "<section class='post-comments'>%s</section>", "<div hidden>%s</div>",
    "<div class='related-stories'>%s</div>", "<form>%s</form>", "<div role=banner>%s</div>", "<div class=adContainer>%s</div>", "<header>%s</header>",
    "<div class='cookieConsentBanner'>%s</div>", "<ul class='share-buttons'><li>%s</ul>", "<p>x <span class=ad>%s</span></p>", "<aside>%s</aside>"])
def test_marked_parts_beside_the_article(part):
    """A part with less than the article's score goes, in the article's container too; beside an article element any part does."""
    small = "Some words, of a part."
    want = f"{LONG_TEXT}\n{LONG_TEXT}" + ("\nx" if part.startswith("<p>") else "")
    assert Page(f"<html><body><div class=content>{LONG}{LONG}{part % small}</div></body></html>").text(None) == want
    if not part.startswith("<p>"):
        page = f"<html><body><article><p>Short, but it is the article.</p></article>{part % (LONG * 4)}</body></html>"
        assert Page(page).text(None) == "Short, but it is the article."


def test_a_form_around_the_page():
    page = (f"<html><body><form id=aspnetForm method=post><input type=hidden name=__VIEWSTATE><div class=header>Site</div><ul class=menu><li>a</ul>"
            f"<div class=content><h1>Title</h1>{LONG}{LONG}<form><p>Sign up, here.</p></form></div><div class=sidebar><p>x, y</p></div></form></body></html>")
    assert Page(page).text(None) == f"Title\n{LONG_TEXT}\n{LONG_TEXT}"


def test_math_is_text():
    page = "<article><p>Energy is <math><mi>E</mi>=<mi>m</mi><annotation encoding=tex>E=m</annotation></math> here.</p></article>"
    assert Page(page).text(None) == "Energy is E=m here."


def test_comments_stay_out_however_long():
    page = f"<html><body><div class=post><h1>T</h1>{LONG}</div><div id=comments>{LONG * 8}</div></body></html>"
    assert Page(page).text(None) == f"T\n{LONG_TEXT}"


@pytest.mark.parametrize("unit", ["<a b ", "<b>", "<b>x<p>y", "<span>", '<a ="<a "', "<ul><li>x", "<svg ", "<script>", '<a class="', "<!--", "<div class=ad>x,",
                                  "</p>", "&", "<svg>x</svg", "<", "<a ='", "<a x='\"<b y=\"'", "<td><table>", "<a class ", "<p hidden>z"])
def test_malformed_pages_take_linear_time(unit):
    """1 MB of anything takes seconds; twice as much, no more than about twice as long."""
    n = 1_000_000 // len(unit)
    begin = time.process_time()
    Page(unit * n)
    assert time.process_time() - begin < 12


def test_pipeline_keeps_lettered_texts_without_labels(spark):
    import corpus_pipeline as pipeline

    rows = [(1, "some words", None, "s", 1), (2, "文字", None, "s", 1), (3, "12 !!", None, "s", 1), (4, None, None, "s", 1), (None, "x" * 5000, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in pipeline.language_id(spark, docs, "").collect()} == {1, 2, None}


def test_lists_that_prune():
    """50,000 clustered vectors: the lists stay balanced, and a small share of the table holds nearly all neighbours."""
    r = np.random.default_rng(0)
    centres = r.normal(size=(300, 64))
    x = centres[r.integers(0, 300, 50_000)] + 0.5 * r.normal(size=(50_000, 64))
    graph = CentroidGraph(fit_centroids(x[r.permutation(len(x))[:postings.SAMPLE]], 500))
    rows, lists, first = postings.lists_of(x, graph)
    assert first.sum() == len(x) and set(rows[first]) == set(range(len(x)))
    sizes = np.bincount(lists[first], minlength=len(graph.c))
    assert sizes.max() <= 6 * len(x) / len(graph.c)
    order = np.argsort(lists, kind="stable")
    held = np.split(rows[order], np.searchsorted(lists[order], np.arange(1, len(graph.c))))
    queries = np.arange(0, len(x), 500)
    _, chosen = graph.search(x[queries], postings.RATIO, postings.FEWEST)
    found = compared = 0
    for q, own in zip(queries, chosen):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        true = np.argpartition(d, 10)[:10]
        read = np.concatenate([held[k] for k in np.flatnonzero(own)])
        compared += len(read)
        found += np.isin(true, read).sum()
    assert found >= 0.95 * 10 * len(queries) and compared < 0.1 * len(x) * len(queries)
