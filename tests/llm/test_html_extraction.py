from __future__ import annotations

import html as html_module
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthlog.llm.html_extraction import extract_main_text, main_text, smoothed, threshold
from hearthlog.llm.queries import op8_html_extraction

LONG = "Many words that make a long paragraph of an article and say nothing at all. " * 4


def plain(page):
    """The article element's text, with plain replacements: right for the given pages."""
    article = re.search(r"<article>(.*)</article>", page, re.S)[1]
    spaced = re.sub(r"</?b>", "", re.sub(r"</?(p|br|h1)>", " ", article))
    return " ".join(html_module.unescape(spaced).split())


def test_query_equals_plain_extraction(spark, small_tables):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small_tables}/pages.parquet").collect()}
    rows = op8_html_extraction(spark, small_tables).collect()
    assert len(rows) == len(pages)
    for row in rows:
        assert row.text == plain(pages[row.page_id].html)
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("plain words", "plain words"),
        ("<p>a&amp;b &lt;c&gt; &#233;&eacute; &am</p>", "a&b <c> éé &am"),
        ("<p>one<p>two\n\n three<br>four", "one two three four"),
        ("<p>a<b>b</b>c <i>d</i></p>", "abc d"),
        (f"<body><nav>x</nav><p>{LONG}</p><p>Short.</p><footer>f</footer>", f"{LONG}Short."),
        (f"<div class='cookie-notice'>{LONG}</div><div id='content'><p>{LONG}</p></div>", LONG.strip()),
        (f"<div><p>{LONG}</p></div><div class='sideBar'><p>{LONG}</p></div>", LONG.strip()),
        (f"<article><p>{LONG}</p><p>x</p><aside>no</aside>"
         f"<section class='comments'><p>{LONG}</p></section></article><p>{LONG}</p>", f"{LONG}x"),
        (f"<main><header><h1>T</h1></header><p>{LONG}</p><form>f<input></form></main>", f"T {LONG}".strip()),
        (f"<header><h1>Site</h1></header><article><h1>T</h1><p>{LONG}</p></article>", f"T {LONG}".strip()),
        (f"<script>var a='<p>';</script><style>p{{}}</style><!-- <p>c</p> --><p>{LONG}", LONG.strip()),
        (f"<ul><li><a href=x>l</a><li><a href=x>m</a></ul><div><p>{LONG}</div>", LONG.strip()),
        (f"<div class=ad>{LONG}</div><p>{LONG}</p><div role=navigation>n</div>", LONG.strip()),
        (f"<article><p>A <span class='search-term'>term</span> stays. {LONG}</p>"
         f"<p style='display: none'>no</p><i aria-hidden=true>no</i></article>", f"A term stays. {LONG}".strip()),
        (f"<div><p>{LONG}</p></div><div><p>s</p></div><div><p>{LONG}</p></div>", f"{LONG}s {LONG}".strip()),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><h2 id='search'>Search</h2><p>{LONG}</p><h2 class='social-structure'>Social</h2><p>{LONG}</p>"
         f"<section id='related-work'><h3>Related</h3><p>Others did so.</p></section></article>",
         f"Search {LONG}Social {LONG}Related Others did so."),
        (f"<div class='content with-sidebar'><article><p>{LONG}</p></article>"
         f"<div class='sidebar'>Out</div></div>", LONG.strip()),
        (f"<div class='content with-sidebar'><p>{LONG}</p><p>{LONG}</p></div><p>x</p>", f"{LONG}{LONG}".strip()),
        (f"<div id='widget'><main><p>{LONG}</p></main></div>", LONG.strip()),
        (f"<main><h1>T</h1><div class='entry'><p>{LONG}</p><p>{LONG}</p></div>"
         f"<article class='card'>teaser</article></main>", f"T {LONG}{LONG}".strip()),
        (f"<main><h1>T</h1><div class='entry'>{LONG}</div><article class='card'>{LONG[:150]}</article></main>",
         f"T {LONG}{LONG[:150]}".strip()),
        (f"<body><div class='entry'><p>{LONG}</p></div><article class='card'>teaser</article></body>",
         LONG.strip()),
        (f"<main><h1>T</h1><div id=widget><article><p>{LONG}</p></article></div></main>", LONG.strip()),
        (f"<article><p>{LONG}</p></article><ol class=comment-list><li><article class=comment-body><p>{LONG[:200]}</p>"
         f"</article></ol>", LONG.strip()),
        (f"<div class=ad>{LONG}</div><article><p>One line.</p></article>", "One line."),
        (f"<div class=widget><p>{LONG}</p><p>{LONG}</p></div><div><p>Other words.</p></div>", f"{LONG}{LONG}".strip()),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG}</p><p>{LONG}</p></section></article>",
         LONG.strip()),
        (f"<article><p>{LONG}</p><div class='sidebar-left'>Out</div><div class='see-related'><a href=x>A link</a>"
         f"</div></article>", LONG.strip()),
    ],
)
def test_names_are_evidence_only(page, text):
    assert main_text(page) == text


def test_smoothing_and_clusters():
    flat = np.full(9, 5.0)
    assert np.allclose(smoothed(flat), flat)
    peak = smoothed(np.array([0.0, 0, 0, 10, 0, 0, 0]))
    assert peak.argmax() == 3 and peak[2] > peak[1] > 0
    assert 2 < threshold(np.array([1.0, 2, 1, 80, 90])) < 80
    assert threshold(np.array([4.0])) == 4


def test_edges(spark):
    schema = "page_id bigint, url string, html string, n_chars string"
    rows = [(1, None, None, "x"), (None, "u", "<p>a", "x"), (2, "u", "<p>b", None), (2, "u", "<p>b", None),
            (3, "v", "<p>" + "long " * 300_000, "y")]
    pages = spark.createDataFrame(rows, schema)
    out = extract_main_text(pages.withColumn("main_text", F.lit(0)))
    assert out.columns == [*pages.columns, "main_text"]
    found = sorted((r.page_id or 0, len(r.main_text)) for r in out.collect())
    assert found == [(0, 1), (1, 0), (2, 1), (2, 1), (3, 1_499_999)]
    assert extract_main_text(pages.where("false")).collect() == []


STORY = f"<h1>T</h1><p>{LONG}</p><p>Second paragraph.</p>"
COMMENTS = "".join(f"<div class=item><p>Reader {i} says that it is all quite wrong.</p></div>" for i in range(20))


@pytest.mark.parametrize(
    "name",
    ["article-comments", "reader-comments", "fb-comments", "wp-comments-area", "user-comments",
     "comments", "comment-list", "readerComments", "story_replies"],
)
@pytest.mark.parametrize("attribute", ["class", "id"])
@pytest.mark.parametrize(
    "page",
    ["<article>{story}</article><div {name}>{comments}</div>",
     "<article>{story}<div {name}>{comments}</div></article>",
     "<main>{story}<div {name}>{comments}</div></main>",
     "<div class=post>{story}</div><div {name}>{comments}</div>",
     "<div class=has-comments><div class=post>{story}</div><section {name}>{comments}</section></div>"],
)
def test_reader_comments_go_whatever_they_are_called(name, attribute, page):
    if attribute == "id" and page.count("<section") and "<article>" in page:
        pytest.skip("ids of sections of an article name their subject")
    filled = page.format(story=STORY, comments=COMMENTS, name=f"{attribute}='{name}'")
    assert main_text(filled) == f"T {LONG}Second paragraph."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class=post-with-comments>{STORY}</div>", f"T {LONG}Second paragraph."),
        (f"<div><p>{LONG}</p></div><div id=bottom>Copyright 2020</div>", LONG.strip()),
        (f"<div><p>{LONG}</p></div><div id=bottom>\u00a9 2020 Us. All rights reserved.</div>", LONG.strip()),
        (f"<article><section id=comments-in-code><h2>Comments</h2><p>{LONG}</p></section></article>",
         f"Comments {LONG}".strip()),
    ],
)
def test_wrappers_and_colophons(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    ["<div class=user-comments>" * 100_000 + LONG, "<div>" * 100_000 + LONG, "<font><p>" * 50_000 + LONG,
     "<article>" * 100_000 + LONG, "<p><div>" + "<b><h1>" * 50_000 + LONG, "<ul><li>" * 50_000 + LONG,
     "<b>" * 100_000 + "</i>" * 100_000 + LONG, "<main><div id=ad>" * 50_000 + LONG],
)
def test_deep_pages_take_linear_time(page):
    start = time.perf_counter()
    assert main_text(page) == LONG.strip()
    assert time.perf_counter() - start < 5
