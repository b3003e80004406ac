"""Main text of pages, and toxicity on held-out labels."""
import html
import random
import re
import zlib

import pytest

from cartograph.llm import html_text, toxicity

from .conftest import SF, edge_texts


def article(page):
    """The article element of a test page, by its markup."""
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    parts = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?(?:p|h1)[^>]*>", inner)]
    return "\n".join(x for x in (re.sub(r"\s+", " ", p).strip() for p in parts) if x)


def test_op3_equals_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html_text.op3_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PROSE = "A long sentence of the article with many words, which goes on for some time and ends here."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple &#233;", "plain & simple é"),
    (f"<article><p>{PROSE}</p><p>Short &lt;one&gt;.<p>{PROSE}</article><footer>c</footer>", f"{PROSE}\nShort <one>.\n{PROSE}"),
    (f"<main><h1>Title</h1><p>a<b>b</b>\n c<br>d</p><aside>{PROSE}</aside><p>{PROSE}</p></main>", f"Title\nab c d\n{PROSE}"),
    (f"<article><p>{PROSE}</p><form>{PROSE}</form><script>if (a < b) x('</p>');</script><div class='comments'><p>{PROSE}</p>"
     f"</div><p>{PROSE} Two.</p></article><section id=comments><p>{PROSE}</p></section>", f"{PROSE}\n{PROSE} Two."),
    (f"<nav><ul><li><a>x</a><li><a>y</a></ul></nav><div class='cookie-notice'>{PROSE}</div><div><h2>Head</h2><p>{PROSE}</p>"
     f"<p>{PROSE}</p></div><div class=sidebar>{PROSE}</div>", f"Head\n{PROSE}\n{PROSE}"),
    ("<nav>only a menu</nav><style>p{}</style><!-- no -->", ""), ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ("<p>unclosed <b>tags", "unclosed tags"), ("</div></p></article>" + PROSE, PROSE),
])
def test_pages(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<form id=aspnetForm><article><p>{PROSE}</p></article></form>", PROSE),
    (f"<form id=aspnetForm><nav>Menu</nav><div id=content><p>{PROSE}</p><p>{PROSE}</p></div></form>", f"{PROSE}\n{PROSE}"),
    (f"<div role=dialog><article><p>{PROSE}</p></article></div>", PROSE),
    (f"<nav><ul><li>Home<li>About</ul><article><p>{PROSE}</p></article>", PROSE),
    (f"<aside>Links<main><p>{PROSE}</p></main>", PROSE),
    (f"<article><p>{PROSE}</p><form>{PROSE}</form><div role=search>x</div></article>", PROSE),
    *((f"<article><p>{PROSE}</p><section {a}><p>Short part.</p></section></article>", f"{PROSE}\nShort part.")
      for a in ("class='search-algorithms'", "class='related-work'", "id='legal'", "id=discussion", "class=header")),
    *((f"<article><p>{PROSE}</p><div {a}><p>Short part.</p></div></article>", PROSE)
      for a in ("class='related'", "class='ad-slot-2'", "id=comments", "class='text newsletter-box'", "class='share-buttons'")),
    (f"<article><ul><li>{PROSE}<li>Two<ul><li>Inner</ul><li>Three</ul><dl><dt>T<dd>D</dl><table><tr><td>a<td>b<tr><td>c</table></article>",
     f"{PROSE}\nTwo\nInner\nThree\nT\nD\na\nb\nc"),
])
def test_articles_in_other_parts_and_parts_of_articles(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("part", ["<li>word", "<div>word", "<dd>word", "<div class=ad>word", "<nav>word", "<p>a</b>b"])
def test_time_is_linear_in_unclosed_elements(part):
    import time
    import tracemalloc
    page = "<article><p>" + PROSE + "</p><ul>" + part * 100_000
    t = time.process_time()
    text = html_text.main_text(page)
    used = time.process_time() - t
    tracemalloc.start()                                     # tracing takes several times as long
    html_text.main_text(page[:len(page) // 4])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert text.startswith(PROSE) and used < 20 and peak < 75e6, (used, peak)


def test_pages_table_edges(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>", "clash", 7), (1, "u", f"<article><p>{PROSE}</p></article>", "clash", 7),
            (None, None, None, None, None), (2, "v", "", "x", 1), (3, "w", "<p>" + "long words " * 100_000, "y", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    long = ("long words " * 100_000).strip()
    assert got == [(None, None, "", 0), (1, "u", PROSE, len(PROSE)), (1, "u", PROSE, len(PROSE)), (2, "v", "", 0), (3, "w", long, len(long))]
    assert html_text.extract(pages.where("page_id > 9")).count() == 0


LONG = "\n".join([PROSE * 3] * 8)
PARAGRAPHS = f"<p>{PROSE * 3}</p>" * 8


@pytest.mark.parametrize("page, want", [
    (f"<div id=top>Login</div><div id=content><p>So.</p>{PARAGRAPHS}<p>End.</p></div><div id=x>Legal</div>", f"So.\n{LONG}\nEnd."),
    (f"<body><p>So.</p>{PARAGRAPHS}<p>End.</p></body>", f"So.\n{LONG}\nEnd."),
])
def test_short_ends_without_article(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    *((f"<div class='{c}'><article><p>{PROSE}</p></article></div>", PROSE)
      for c in ("site no-sidebar", "layout with-sidebar", "has-share", "skip-nav-target")),
    (f"<div class='with-sidebar'><div id=x><p>{PROSE}</p></div></div><div class=ad>Buy</div>", PROSE),
    (f"<article><div class='article-header'><h1>Title</h1></div><p>{PROSE}</p></article>", f"Title\n{PROSE}"),
    (f"<article><p>{PROSE}</p></article><article class=comment><p>{PROSE} No.</p></article>", PROSE),
    (f"<article><p>{PROSE}</p><article class=comment><p>No.</p></article><p>Yes.</p></article>", f"{PROSE}\nYes."),
    (f"<article><p>{PROSE}</p></article><div class=related><article><p>{PROSE} No.</p></article></div>", PROSE),
])
def test_marked_wrappers(page, want):
    assert html_text.main_text(page) == want


def test_op2_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = toxicity.op2_toxicity(spark, folder).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in held if y == 0) <= 1
    assert sum(y == p for y, p in held) >= 0.95 * len(held)


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = toxicity.held_out(labels["doc_id"])
    turned = labels.withColumn("toxic", toxicity.F.when(held, 1 - labels["toxic"]).otherwise(labels["toxic"]))
    a, b = ({r.doc_id: r["score"] for r in toxicity.scored(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_grammar_states():
    lexicon = toxicity.Lexicon([("=idiot", 0, 50, 0)], 100, 900)
    plain, negated = lexicon.features("an idiot. the end"), lexicon.features("you are not an idiot. the end")
    said, none = lexicon.features("she said: idiot. he said you idiot"), lexicon.features("a calm text. not bad")
    assert plain[1] > 0 and plain[2] > 0 and plain[3:6] == [0.0] * 3
    assert negated[1:4] == [0.0] * 3 and negated[4] > 0
    assert said[5] > 0 and said[2] > 0 and none[1:10] == [0.0] * 9
    assert lexicon.features("I kill, destroy")[8] > 0 and lexicon.features("kill you")[9] > 0
    assert lexicon.weight("=idiot", 1, 1) < lexicon.weight("=idiot", 1, None)
    paths = [lexicon.features(t) for t in ("you are not an idiot", "you idiot are not", "not idiot you")]
    assert len({tuple(x) for x in paths}) == 3
    assert paths[0][1] == paths[2][1] == 0 < paths[1][1] and paths[2][9] > 0


def test_composed_acceptor_equals_its_definition():
    rng = random.Random(3)
    state = 0
    read: list[str] = []                      # symbols of the clause
    for _ in range(30_000):
        x = rng.choices(toxicity.SYMBOLS, (8, 2, 1, 1, 2, 1, 2))[0]
        state, total = toxicity.ACCEPTOR[state][x]
        near, close = read[-toxicity.NEAR:], read[-toxicity.CLOSE:]
        want = ""
        if x in ("insult", "threat"):
            want = ("negated" if "negation" in near else "reported" if "report" in read
                    else "targeted" if "target" in near else "plain")
        elif x == "target" and ("insult" in close or "threat" in close):
            want = "addressed"
        assert total == want
        read = [] if x == "end" else [*read, x]


def test_repeated_documents_count_once_in_the_fit(spark):
    docs = spark.createDataFrame([(1, "b")] * 50 + [(1, "a"), (2, "c"), (2, None), (3, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    ids = [i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5]
    got = {r.doc_id: (r.text, r.toxic) for r in toxicity.sample(docs, labels).collect()}
    assert got == {i: {1: ("a", 1), 2: ("", 0), 3: ("d", 1)}[i] for i in ids}
    assert toxicity.sample(docs, labels).count() == len(ids) and toxicity.sample(docs, labels, 1).count() == 1


def test_score_columns_of_other_meaning_are_kept(spark):
    docs = spark.createDataFrame([(1, "calm", "x", 2.0), (2, None, None, None)], "doc_id long, text string, Score string, _score double")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.collect() == docs.collect()


def test_toxicity_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 1), (10, 0), (4, 0)], "doc_id long, toxic int")
    for x in (labels, labels.limit(0)):
        found = toxicity.scored(edges, x).collect()
        assert len(found) == len(edge_texts()) and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.drop_toxic(edges, labels.limit(0)).columns == edges.columns
    assert toxicity.scored(nothing, labels).count() == 0
