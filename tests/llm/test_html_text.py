import html
import math
import re

import pytest
from pyspark.sql import functions as F

from barworks.llm.html_text import _measure, extract_text, main_text, parse

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><p>slogan of the site</p></header><nav><a href=x>Home</a></nav>
<div id="cookie-notice">We use cookies &amp; more on this page, please accept all of these.</div>
<div class="layout"><div class="sidebar"><ul><li><a>one</a><li><a>two</a></ul></div>
<div class="post"><h2>A title</h2><p>First   long paragraph with a <a href="q">link</a> inside and quite some words in it.</p><ul><li>item one<li>item two</ul>
<p>Second long<br>paragraph goes on for a while too &eacute; and then stops.<table><tr><td>cell 1<td>cell 2</table><blockquote>quoted text here</blockquote></div></div>
<div class="comments"><p>Nice post! I liked it very much, thanks for writing this long text about things.</p></div>
<form><label>mail</label><input></form><footer>&copy; 2020 all rights reserved</footer><script>var a="<p>no</p>"</script></body></html>"""


def test_page_with_furniture():
    assert main_text(PAGE).split("\n") == [
        "A title", "First long paragraph with a link inside and quite some words in it.", "item one", "item two",
        "Second long paragraph goes on for a while too é and then stops.", "cell 1", "cell 2", "quoted text here"]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<", "<"), ("plain  text", "plain text"), ("<p>a", "a"), ("<!-- unclosed", ""), ("<p title='a>b'>q</p>", "q"),
    ("x<a href=\"y", "x"), ("a &lt;b&gt; &am &amp", "a <b> &am &"), ("<div>" * 3000 + "deep", "deep"), ("<p>a</b></i>b</p></p>c", "ab\nc"),
    ("<script>x", ""), ("<style>p{}</STYLE >y", "y"), ("<nav>menu</nav>", ""), ("<article><header><h1>T</h1></header><p>b</p></article>", "T\nb"),
    ("<p hidden>no</p><p>yes \n it is</p>", "yes it is"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_long_pages_stay_linear():
    assert main_text("<p>" + "<b>" * 20000 + "x")
    assert main_text("<'" * 50000) is not None
    assert len(main_text("<article>" + "<p>one two</p>" * 20000 + "</article>").split("\n")) == 20000


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for row in extract_text(pages).collect():
        page = raw[row.page_id]
        article = page[page.find("<article>"):]
        article = article[:article.find("</article>")] if "</article>" in article else article.split("<footer")[0]
        pieces = re.split("<[^>]*>", re.sub("</?b>", "", article.replace("<br>", " ")))
        want = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in pieces) if x)
        assert row.text == want and row.n_chars == len(want)


def test_tables(spark):
    schema = "page_id bigint, url string, html string, text int, n_chars string"
    rows = [(1, None, None, 1, "x"), (1, None, None, 1, "x"), (None, "u", "<p>a", None, None)]
    out = extract_text(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in out.collect()) == [("", 0), ("", 0), ("a", 1)]
    assert extract_text(spark.createDataFrame([], schema)).count() == 0
    assert extract_text(spark.createDataFrame(rows, schema), text_col="html").filter(F.col("html") == "a").count() == 1


TEXT = "The council agreed on Monday to rebuild the old bridge, and work will begin in the early spring of next year."
WRAPPED = f"<h2>A title</h2><p>{TEXT}</p><p>{TEXT}</p>"


@pytest.mark.parametrize("page", [
    f"<body><div class='content with-sidebar'>{WRAPPED}</div><div class=sidebar><p>Other news</p></div></body>",
    f"<body><div class='post has-share-bar'>{WRAPPED}</div></body>",
    f"<body><div id=no-sidebar><div class=x>{WRAPPED}</div></div><div class=comments><p>Nice post, thanks!</p></div></body>",
    f"<body><form id=aspnetForm><nav><a href=x>Home</a></nav><article>{WRAPPED}</article></form></body>",
    f"<body><form><div>{WRAPPED}</div></form><form class=search><label>Find</label></form></body>",
])
def test_furniture_names_do_not_drop_the_heart(page):
    assert main_text(page) == f"A title\n{TEXT}\n{TEXT}"


def test_lone_text_in_a_named_wrapper():
    assert main_text(f"<body><div class=no-sidebar>{TEXT}</div></body>") == TEXT
    assert main_text(f"<body><div class=no-sidebar><p>{TEXT}</p></div></body>") == TEXT


@pytest.mark.parametrize("page,text", [
    # Nothing but densities tells the article from remarks and a footer.
    (f"<body><div>{WRAPPED}</div><div>Anna: nice post!</div><div>Copyright 2020 The Paper</div></body>", f"A title\n{TEXT}\n{TEXT}"),
    (f"<body><h1>Top</h1><div>{WRAPPED}<ul><li>a short item</ul></div><h3>Comments</h3><div><p>Anna: nice post!</p></div></body>",
     f"Top\nA title\n{TEXT}\n{TEXT}\na short item"),
    (f"<body><p>{TEXT}</p><p>{TEXT}</p><p>Short.</p><div>Anna: nice post!</div></body>", f"{TEXT}\n{TEXT}\nShort."),
    (f"<body><a href=x>Home</a> <a href=y>About</a><div>{WRAPPED}</div></body>", f"A title\n{TEXT}\n{TEXT}"),
    # A menu of links inside an article goes, a short list and a lone link stay.
    (f"<article>{WRAPPED}<ul><li><a href=x>Read more</a><li><a href=y>Also</a></ul></article>", f"A title\n{TEXT}\n{TEXT}"),
    (f"<article>{WRAPPED}<ul><li>one<li>two</ul><p><a href=x>Source</a></p></article>", f"A title\n{TEXT}\n{TEXT}\none\ntwo\nSource"),
])
def test_densities_decide(page, text):
    assert main_text(page) == text


def test_densities_against_their_definition():
    """Composite density and sums of every element, worked out from each subtree anew."""
    root = parse(PAGE)
    order = _measure(root)

    def subtree(node):
        return [node] + [x for c in node.children if not isinstance(c, str) for x in subtree(c)]

    def chars(node):
        return sum(len("".join(c.split())) if isinstance(c, str) else chars(c) for c in node.children)

    def linked(node):
        return chars(node) if node.tag == "a" else sum(linked(c) for c in node.children if not isinstance(c, str))

    share = linked(root) / chars(root)
    expected = {}
    for node in order:
        c, t, lc = chars(node), max(1, len(subtree(node)) - 1), max(1, linked(node))
        lt = max(1, sum(x.tag == "a" for x in subtree(node)))
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        expected[node] = c / t * math.log(max(1, c / lc * t / lt)) / math.log(base) if c else 0
    for node in order:
        assert node.density == pytest.approx(expected[node])
        assert node.total == pytest.approx(sum(expected[c] for c in node.children if not isinstance(c, str)))
