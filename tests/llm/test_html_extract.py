import time

import pyarrow.parquet as pq
import pytest

from daybook.llm.html_extract import Model, _count, extract_text, labels, main_text, parse, train
from tests.llm.helpers import SF, have_tables

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div class="ad">Buy now, really, a long advert text that goes on.</div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b>   text<br>goes on.<p>Second &lt;p&gt; with <a href="#">a link</a>.</p>
<ul><li>one<li>two</ul><script>var a="</p><p>no";</script><!-- <p>no</p> -->
<aside>Related things</aside><form>Sign up <input name=q></form><div class="comments"><p>Nice post, I think so too!</p></div>
<blockquote>Said&nbsp;so</blockquote></article><footer>&copy; site</footer></body></html>"""
WANT = "Head & line\nFirst bold text goes on.\nSecond <p> with a link.\none\ntwo\nSaid so"


def test_page_without_training_and_after_it(spark):
    assert main_text(PAGE, Model({})) == WANT
    pages = spark.createDataFrame([(i, "u", PAGE) for i in range(6)], "page_id long, url string, html string")
    assert main_text(PAGE, train(pages)) == WANT


def test_plain_page_without_named_article():
    long = "A sentence of some length that reads like the body of a text. " * 4
    page = f"<body><div class=menu><a href=1>One</a> <a href=2>Two</a></div><div id=content><p>{long}</p><p>{long}</p></div></body>"
    assert main_text(page, Model({})) == "\n".join([long.strip()] * 2)


def test_edges(spark):
    sources = [None, "", "no markup", "<article>", "<article><p>open", "<article><p>a<p>b</article>", "<p", "a < b > c",
               "<article><p title='>'>x &unknown; &#233; &#x1F642;</p><!-- open", "<script>x", "</p></div><article>t</article>",
               "<article>" + "<div>" * 12 + "deep" + "</div>" * 12 + "</article>", "<article><p>" + "w " * 200_000 + "</article>",
               "<div>" * 3000 + "</div>" * 3000]
    rows = [(i if i % 4 else None, None if i == 2 else f"u{i}", s, "x", "x") for i, s in enumerate(sources)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    out = extract_text(pages, Model({})).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    text = {r.url: r.text for r in out}
    assert text["u0"] == text["u1"] == "" and text["u4"] == "open" and text["u5"] == "a\nb"
    assert text["u8"] == "x &unknown; é 🙂" and text["u10"] == "t" and text["u11"] == "deep"
    assert text["u12"] == " ".join(["w"] * 200_000)
    assert extract_text(pages.limit(0)).count() == 0


def test_messages_equal_enumeration():
    """Marginals of the messages against the sum over all labellings."""
    import itertools

    page = parse("<div class=menu><p>ab</p><ul><li>x</ul></div><article><p>text</p></article>")
    model = Model({})
    n = len(page.tag)
    own = [model.potential(page, i) for i in range(n)]
    total, on = 0.0, [0.0] * n
    for states in itertools.product((0, 1, 2), repeat=n - 1):
        states = (0, *states)
        w = 1.0
        for i in range(1, n):
            w *= own[i][states[i]] * model.edge[states[page.parent[i]]][states[i]]
        total += w
        for i in range(n):
            on[i] += w * (states[i] == 1)
    assert model.marginals(page) == pytest.approx([x / total for x in on], rel=1e-6)


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_held_out_pages(spark):
    """Trained on half of the pages, the blocks of the other half are labelled
    as their own markup says."""
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    model = train(rows.filter("page_id % 2 = 0"))
    right = wrong = 0
    for r in rows.filter("page_id % 2 = 1").collect():
        page = parse(r.html)
        want = labels(page)
        likely = model.marginals(page)
        for i, _ in page.parts:
            same = (likely[i] >= 0.5) == (want[i] == 1)
            right, wrong = right + same, wrong + (not same)
    assert right > 200 and wrong == 0


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_returns_the_article(spark):
    import html
    import re

    from daybook.llm.queries import op3_html_extraction
    want = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<b>", "").replace("</b>", "").replace("<br>", " "))
        want[r.page_id] = "\n".join(x for p in parts if (x := " ".join(html.unescape(p).split())))
    assert {r.page_id: r.text for r in op3_html_extraction(spark, SF).collect()} == want


LONG = "A sentence of some length that reads like the body of a text, and so on it goes. " * 3
TEXT = LONG.strip()
TEMPLATES = {
    "text of the body": (f"<html><body>{LONG}</body></html>", [TEXT]),
    "text beside a paragraph": (f"<body>{LONG}<p>{LONG}</p></body>", [TEXT, TEXT]),
    "paragraphs of the body": (f"<body><h1>Title here</h1><p>{LONG}</p><p>Short one.</p></body>", ["Title here", TEXT, "Short one."]),
    "named divs": (f"<body><div class=topmenu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class=post-body>"
                   f"<h2>Head</h2><p>{LONG}</p></div><div class=footer>c</div></body>", ["Head", TEXT]),
    "nameless divs": (f"<body><div><div><a href=1>Home</a> <a href=2>About us</a></div></div><div><h1>Title</h1><div>{LONG}</div>"
                      f"<div>{LONG}</div></div><div><form>Sign up</form></div></body>", ["Title", TEXT, TEXT]),
    "layout table": (f"<body><table><tr><td class=nav><a href=1>A</a><br><a href=2>B</a><td class=content><p>{LONG}</p><p>{LONG}</p>"
                     "<tr><td class=footer>F</table></body>", [TEXT, TEXT]),
    "main": (f"<body><header>Site</header><main><section><h2>Q</h2><p>{LONG}</p></section></main><footer>F</footer></body>", ["Q", TEXT]),
    "linked list item": (f"<nav><a href=1>Home</a></nav><article><h1>H</h1><p>{LONG}</p><ul><li><a href=x>Linked point</a></li></ul>"
                         f"<p>{LONG}</p></article>", ["H", TEXT, "Linked point", TEXT]),
    "linked paragraph": (f"<nav><a href=1>Home</a></nav><article><h1>H</h1><p><a href=q>{LONG}</a></p><p>{LONG}</p></article>",
                         ["H", TEXT, TEXT]),
    "social paragraph": (f"<article><h1>H</h1><p class=social>{LONG}</p><p>{LONG}</p></article>", ["H", TEXT, TEXT]),
    "comments below": (f"<article><h1>H</h1><p>{LONG}</p></article><div id=disqus><p>{LONG}</p><p>I agree.</p></div>", ["H", TEXT]),
    "comments inside": (f"<article><h1>H</h1><p>{LONG}</p><div id=disqus_thread>" + f"<p>{LONG}</p>" * 60 + "</div></article>", ["H", TEXT]),
}


@pytest.mark.parametrize("name", TEMPLATES)
@pytest.mark.parametrize("trained", [False, pytest.param(True, marks=pytest.mark.skipif(not have_tables, reason="no tables"))])
def test_templates(name, trained):
    """Pages unlike those of the tables, by the prior alone and after training
    on the tables' pages."""
    counts: dict[str, int] = {}
    if trained:
        for batch in pq.read_table(f"{SF}/pages.parquet", columns=["html"]).to_batches():
            for out in _count(iter([batch])):
                for k, n in zip(out[0].to_pylist(), out[1].to_pylist()):
                    counts[k] = counts.get(k, 0) + n
    page, want = TEMPLATES[name]
    assert main_text(page, Model({k: n for k, n in counts.items() if n >= 3})) == "\n".join(want)


@pytest.mark.parametrize("page", ["<div>{0}</section>{0}", "<ul><li><ul>{0}<div>{0}<li/>{0}", "<table><tr><td><table>{0}<div>{0}<td/>{0}"])
def test_parsing_is_linear(page):
    """Unmatched tags below many open elements."""
    n = 20_000
    head, *tags = page.split("{0}")[:-1]
    start = time.process_time()
    parse((head + "".join(t * n for t in tags)) if tags[1:] else head * n + tags[0] * n)
    assert time.process_time() - start < 5
