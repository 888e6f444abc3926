"""Op 11: the whole table against a brute-force cut, page layouts, broken markup and edge cases."""

from __future__ import annotations

import html as references
import re
import time

import duckdb
import pytest

from measurekit.llm import html_text
from measurekit.llm.html_text import main_text
from measurekit.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"
PARTS = [
    "The river runs past the old mill and the miller counts sacks of flour every morning before the market opens.",
    "Nobody remembers who built the first wheel, but the stones still turn & grind.",
    "Short one.",
    "In winter the ice stops the wheel for weeks and the village eats bread from the neighbouring town instead.",
]
BODY = "".join(f"<p>{references.escape(p)}</p>\n" for p in PARTS)
TEXT = "\n".join(PARTS)
OPINION = "I really liked this long story about the mill and the river and I want to say so at length. " * 6
COMMENTS = "".join(f'<div class="comment"><p>{OPINION}</p></div>' for _ in range(8))


def test_query_equals_brute_force_and_sql(spark):
    rows = {r["page_id"]: r for r in QUERIES["op11_html_text"](spark, FOLDER).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{FOLDER}/pages.parquet'").fetchall()
    assert len(rows) == len(pages)
    for page, url, html in pages:
        part = re.search("<article>(.*?)</article>", html, re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(references.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1)>", part)]
        text = "\n".join(b for b in blocks if b)
        assert (rows[page]["url"], rows[page]["text"], rows[page]["n_chars"]) == (url, text, len(text))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    assert {r[0]: r[1:] for r in con.sql(ORACLE["op11_html_text"]).fetchall()} == {p: (r["url"], r["text"], r["n_chars"]) for p, r in rows.items()}


LAYOUTS = {
    "boxes": f'<body><header><h1>Site</h1></header><div id="menu"><ul><li><a href=x>A</a><li><a href=y>B</a></ul></div><div id="content">{BODY}</div>'
    f'<div class="sidebar"><p>{PARTS[0]}</p></div><section id="comments">{COMMENTS}</section><div class="cookie-notice">We use cookies.<button>OK</button></div>'
    "<form><p>Sign up for our newsletter please</p><input></form><div class=footer>Copyright</div></body>",
    "wrappers that say what they have": f'<body class="has-sidebar"><div class="page-wrapper"><main><article class="post comments-open">{BODY}<aside>Related</aside>'
    f'<div class="share-buttons"><a>Tweet</a></div></article></main><div class="post-comments">{COMMENTS}</div></div>',
    "table": f"<table><tr><td><a href=1>Home</a><br><a href=2>News</a></td><td>{BODY}</td></tr></table>",
    "comments as articles": f'<body><div>{BODY}</div><article class="comment"><p>{OPINION}</p></article>',
    "advert within": f'<article>{BODY.replace("<p>Short", "<div class=ad><p>Buy more flour today at our shop.</p></div><p>Short")}</article>',
    "scripts": f'<head><title>t</title><style>p{{}}</style></head><script>var t="</p><p>no</p>"</script><div>{BODY}<script>x()</script><noscript>on</noscript></div>',
    "hidden": f'<div>{BODY}<p hidden>no</p><p style="display: none">no</p><p aria-hidden=true>no</p></div>',
    "two parts": f"<body><div><p>{PARTS[0]}</p><p>{references.escape(PARTS[1])}</p></div><div><p>{PARTS[2]}</p><p>{PARTS[3]}</p></div><ul><li><a>a</a><li><a>b</a></ul></body>",
    "upper case": "<BODY><NAV><P>Menu</P></NAV><ARTICLE>" + BODY.replace("<p>", "<P Class='x>y'>").replace("</p>", "</P>") + "</ARTICLE></BODY>",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert main_text(LAYOUTS[name]) == TEXT


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("  \n ", ""),
        ("plain &lt;b&gt; text\n\n here", "plain <b> text here"),
        ("<p>One", "One"),
        ("<p>a<br>b <b>bold</b>er</p><p>c <a href='x'>link</a></p>", "a b bolder\nc link"),
        ("<!-- open <p>x", ""),
        ("<!--> <p>x</p>", "x"),
        ("<p>a &am", "a &am"),
        ("<p>x &#233;&eacute;&nbsp;&nbsp;y &copy</p>", "x éé y ©"),
        ("<p>A<div>B</div>C", "A\nB\nC"),
        ("<p title=\"a>b\">in</p><p>2 < 3</p>", "in\n2 < 3"),
        ("<ul><li>one<li>two</ul><table><tr><td>c1</td><td>c2<tr><td>c3</table>", "one\ntwo\nc1 c2\nc3"),
        ("<nav><p>only a menu</p></nav>", ""),
        ("<p>a</p></body></html><p>b</p>", "a\nb"),
        ('<p>a</p><a href="', "a"),
        ("<article><p>x</p></article><article><p>y</p></article>", "x\ny"),
    ],
)
def test_broken_and_small_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page", ["<div>" * 50_000 + "deep" + "</div>" * 50_000, "<b>" * 30_000 + "<p>x" * 30_000, "<a " * 100_000, '<p "' * 100_000, "<" * 200_000, "&" * 200_000, "<!--" * 50_000]
)
def test_hostile_pages_take_linear_time(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 10


def plain_densities(page, out):
    """Composite densities by recursion over subtrees, element by element."""
    import math

    children = {i: [j for j in range(len(page.tags)) if page.parents[j] == i and not out[j]] for i in range(len(page.tags))}
    own = lambda i, link: sum(len(p[1]) for p in page.pieces if p and p[0] == i and not p[1].isspace() and (p[2] or not link))
    size = lambda i, link=False: own(i, link) + sum(size(j, link) for j in children[i])
    tags = lambda i: sum(1 + tags(j) for j in children[i])
    links = lambda i: sum((page.tags[j] == "a") + links(j) for j in children[i])
    whole, linked = max(size(0), 1), max(size(0, True), 1)

    def density(i):
        c, lc, t, lt = size(i), max(size(i, True), 1), max(tags(i), 1), max(links(i), 1)
        if c == 0 or c / lc * t / lt <= 1:
            return 0.0
        return c / t * math.log(c / lc * t / lt, math.log(c / max(c - size(i, True), 1) * lc + linked / whole * c + math.e))

    return [0.0 if out[i] else density(i) for i in range(len(page.tags))]


@pytest.mark.parametrize("name", LAYOUTS)
def test_densities_equal_recursion(name):
    page = html_text.parse(LAYOUTS[name])
    out = html_text.left_out(page)
    dense, _, _, _ = html_text.densities(page, out)
    for tag, fast, slow in zip(page.tags, dense, plain_densities(page, out)):
        if tag not in html_text.INLINE and tag != "#page":
            assert fast == pytest.approx(slow)


def test_columns_rows_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", LAYOUTS["boxes"], "old", 9), (1, "u", LAYOUTS["boxes"], "old", 9), (None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars int")
    found = html_text.extract(pages)
    assert sorted(found.columns) == sorted(["page_id", "url", "html", "text", "n_chars"])
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in found.collect()) == [(0, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT))]
    assert html_text.extract(pages.limit(0)).collect() == []
