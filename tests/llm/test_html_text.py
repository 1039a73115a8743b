"""Main text of pages: hand-written pages and a plain reading of the test tables."""

import html
import re

from sitewright.llm.html_text import blocks, extract, main_text
from sitewright.llm.queries import QUERIES

LONG = "Some words of a long paragraph that goes on and on, with commas, for well over ninety characters in all."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body class="has-sidebar">
    <header class="site-header"><h2>Site</h2></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
    <div class="cookie-notice">We use cookies. {LONG}</div><aside>Side {LONG}</aside>
    <main><article><header><h1>A &amp; B</h1></header><p>First&nbsp;one
      <b>bold</b>text.<br>Next<!-- not this --></p><div class="ad"><div>Buy</div> now</div><p>{LONG}<p>Short.</p>
    <form><label>Mail</label><input name=x></form><ul><li>Item one<li>Item two</ul>
    <section id="comments"><h3>Comments</h3><p>Reader says {LONG}</p></section></article></main>
    <div id="sidebar">Popular</div><footer>&copy; me</footer></body></html>"""
    assert main_text(page).split("\n") == ["A & B", "First one boldtext. Next", LONG, "Short.", "Item one", "Item two"]


def test_page_without_marked_article():
    page = f"<body><div><a href=x>Home</a> <a href=y>News</a></div><p>Ok</p>{''.join(f'<p>{LONG} {i}</p>' for i in range(4))}<p>Thus it ends.</p><div><a href=z>{LONG}</a></div><div><a>Next</a></div></body>"
    assert main_text(page).split("\n")[-5:] == [f"{LONG} {i}" for i in range(4)] + ["Thus it ends."]
    assert "Home" not in main_text(page) and "Next" not in main_text(page)


def test_parts_by_their_names():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(3))
    for opening, own in (('<div class="content with-sidebar">', True), ('<div class="entry-content">', True), ('<div class="post-footer">', False), ('<div id="searchForm">', False), ('<section class="user-comments">', False), ('<div role="complementary">', False), ('<p hidden>', False)):
        tag = opening[1:].split()[0]
        page = f"<body>{body}{opening}<span>{LONG} own</span></{tag}><p>{LONG} end</p></body>"
        assert (f"{LONG} own" in main_text(page)) == own and main_text(page).endswith("end")
    article = f'<main><p>Teaser {LONG}</p><article><div class="entry-header"><h1>Title</h1></div><p>One.</p><article class="comment"><p>{LONG}</p></article><p>Two.</p></article></main>'
    assert main_text(article) == "Title\nOne.\nTwo."


def test_broken_markup_ends_somewhere():
    assert main_text("<article><p>One<p>Two<script>var a = '<p>x") == "One\nTwo"
    assert main_text("<article><p>1 < 2 & 3 &lt;b&gt; <3</p>") == "1 < 2 & 3 <b> <3"
    assert main_text("<nav><ul><li>Menu<article><p>Text</p></article>") == "Text"
    assert main_text("<article><p>One</p><!-- never closed <p>Two") == "One"
    assert main_text('<article><p title="a>b">Q</p></article><p') == "Q"
    assert main_text(None) == main_text("") == main_text("<p> </p>") == ""


def test_links_weigh_nothing():
    assert blocks("<p>ab <a href=x>cd</a></p>") == [("ab cd", 3, 0)]


def test_query_on_the_given_pages(spark):
    """The given pages have one plain article each."""
    got = {r.page_id: r for r in QUERIES["op1_html_extraction"](spark, "/root/testdata/sf0.001").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = p.html.split("<article>", 1)[1].split("</article>", 1)[0]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[p.page_id].text == "\n".join(x for x in parts if x) and got[p.page_id].n_chars == len(got[p.page_id].text)


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article><p>x</p></article>"), (2, "v", ""), (3, "w", "<article>" + "<p>word 😀 </p>" * 50_000)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text", "0 AS n_chars")).collect()
    assert [(r.page_id, r.text[:6], r.n_chars) for r in out] == [(1, "", 0), (1, "", 0), (None, "x", 1), (2, "", 0), (3, "word 😀", 50_000 * 7 - 1)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_attributes_are_read_one_by_one():
    for attrs in ('style="overflow:hidden"', 'title="a hidden place"', 'data-id="related"', "data-grid='ad'", 'data-href=?id=search', 'class="x" data-hidden', 'aria-hidden="false"', 'data-class="sidebar"', "title='id=\"ad\"'"):
        assert main_text(f"<body {attrs}><article {attrs}><h1>T</h1><p {attrs}>{LONG}</p><div {attrs}>Own</div></article></body>") == f"T\n{LONG}\nOwn", attrs
    for attrs in ("hidden", 'hidden=""', 'aria-hidden = "true"', "class=ads", "ID='comments'"):
        assert main_text(f"<article><p>{LONG}</p><div {attrs}>Other</div></article>") == LONG, attrs
    assert main_text(f'<body class="sidebar modal"><main class="search"><p>{LONG}</p></main></body>') == LONG


def test_parts_of_an_article_named_by_their_subject():
    body = f'<section id="discussion"><h2 id="related-work">Related</h2><p>{LONG}</p></section><section class="legal search form">Law</section><div class="comment-on-law">Of comments</div>'
    assert main_text(f"<article>{body}</article>") == f"Related\n{LONG}\nLaw\nOf comments"
    assert main_text(f'<article class="promo"><p>{LONG}</p></article>') == LONG
    assert main_text(f'<article><p>{LONG}</p><div class="ad-slot">Buy</div><div class="user-comments">Talk</div></article>') == LONG


def test_marks_that_hold_less_than_the_page():
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(6))
    teasers = "".join(f'<article class="card"><h3>Teaser {i}</h3><p>Short.</p></article>' for i in range(3))
    for tag in ("main", 'div class="content"'):
        text = main_text(f"<body><{tag}><h1>Title</h1>{body}{teasers}</{tag.split()[0]}></body>").split("\n")
        assert all(f"{LONG} {i}" in text for i in range(6)) and text[0] == "Title", tag
    assert main_text(f"<main><h1>Title</h1><p>By me</p><article>{body}</article></main>").split("\n") == ["Title", "By me"] + [f"{LONG} {i}" for i in range(6)]
    far = f"<main><div><h1>Title</h1></div><div>x</div><div>y</div><div>z</div><article>{body}</article></main>"
    assert main_text(far).split("\n") == ["Title"] + [f"{LONG} {i}" for i in range(6)]


def test_lines_with_many_links_stay_between_surge_and_dive():
    linked = f'<p>Of this, <a href=x>{LONG}</a> says more</p>'
    page = f"<body><p>{LONG} 1</p>{linked}<p><a href=y>Only a link</a></p><p>{LONG} 2</p><div><a href=z>Home</a></div></body>"
    assert main_text(page).split("\n") == [f"{LONG} 1", f"Of this, {LONG} says more", "Only a link", f"{LONG} 2"]
    refs = "".join(f"<li>Smith and others, <a href=x>A title {i}</a></li>" for i in range(6))
    assert "A title 5" in main_text(f"<body><p>{LONG}</p><ul>{refs}</ul></body>")
