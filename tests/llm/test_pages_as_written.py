"""Pages as people write them: odd attributes, long and deep pages, short parts inside articles."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from stayscope.llm import pages
from stayscope.llm.common import first_by_hash, table
from tests.llm.test_pages_and_secrets import prose


def all_text(source):
    found = pages.parse(source)
    return pages.joined(found, [True] * len(found.nodes))


@pytest.mark.parametrize(
    "source, want",
    [
        ("<p title=Bob's>First.</p><p>Second, don't lose me.</p><p>Third.</p>", "First. Second, don't lose me. Third."),
        ("x <a href=x title=it's>y</a> z", "x y z"),
        ('q <img alt="5" tall"> r', "q r"),
        ("<p a=\"b>c\" d='e>f'>ok</p>", "ok"),
        ("<p a = \"x>y\" b>ok</p>", "ok"),
        ("<p a= >ok</p>", "ok"),
        ('<p a==">ok</p>', "ok"),
        ('<p title="never closed>text</p><p>more</p>', "text more"),
        ("<p title='>one</p><p title=\"b>c\">two</p>", "one two"),
        ("a<!-->b<!--->c<!-- x > y --!>d", "abcd"),
        ("a<!-- never closed <p>b", "a"),
        ("1 <3 and 2 < 4 > 3", "1 <3 and 2 < 4 > 3"),
        ("all of it <b", "all of it <b"),
        ('cut off <a href="http://x', "cut off"),
        ("cut off</p", "cut off"),
        ("<a href=http://x.com/>l</a>m<br/>n", "lm n"),
        ("<script>if (a</b/>c) x</script\n>s<STYLE>p{}</STYLE x>t", "st"),
        ("<li>a<li>b<ul><li>c</ul><p>d<div>e</div>", "a b c d e"),
        ("<table><tr><td>a<td>b<tr><th>c<td><p>d<table><tr><td>e</table>f</table>", "a b c d e f"),
        ("<dl><dt>a<dd>b<p>c<dt>d</dl>", "a b c d"),
    ],
)
def test_markup_is_read_as_browsers_do(source, want):
    assert all_text(source) == want


def test_a_link_with_a_bare_address_is_open():
    assert [link for _, _, link, _ in pages.parse("<a href=http://x.com/>l</a>m").runs] == [True, False]


@pytest.mark.parametrize(
    "part",
    ["<b><h2>x", "<div>", '<a href="x ', "<b> ", "<a", "<svg><p>", "<li><b>", "<p title='>x ", "<!-- x ", "</script ", "<script>x</script ",
     "<svg><desc><b>", "<td><p>", "<p a=", "&amp", "</div>", "<i>"],
)
def test_time_grows_with_the_page_alone(part):
    took = []
    for size in (100_000, 400_000):
        source = part * (size // len(part)) + "</p>" * 100
        start = time.process_time()
        found = pages.parse(source)
        pages.features(found)
        keep = np.full(len(found.nodes), 0.5)
        pages.joined(found, pages.decode(found, keep, keep * 0.5))
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 1


@pytest.fixture(scope="module")
def extractor(spark):
    """Fitted on as many pages as in production."""
    known = table(spark, "/root/testdata/sf0.1", "pages").where("html IS NOT NULL")
    return pages.fit([r.html for r in first_by_hash(known, known.columns, pages.SAMPLE_PAGES).select("html").collect()])


pick = random.Random(9)
LONG, MORE = prose(pick, 60), prose(pick, 45)
BODIES = {
    "plain": (f"<p>{LONG}</p><p>{MORE}</p>", f"{LONG} {MORE}"),
    "pre": (f"<p>{LONG}</p><pre>x = 1\n  y</pre><p>{MORE}</p>", f"{LONG} x = 1 y {MORE}"),
    "table": (f"<p>{LONG}</p><table><tr><td>ba<td>be</table><p>{MORE}</p>", f"{LONG} ba be {MORE}"),
    "headings": (f"<p>{LONG}</p><h2>Ka ki</h2><p>{MORE}</p>", f"{LONG} Ka ki {MORE}"),
    "list": (f"<p>{LONG}</p><ul><li>bo<li>bu da</ul><p>{MORE}</p>", f"{LONG} bo bu da {MORE}"),
    "quote": (f"<p>{LONG}</p><blockquote>Du ka ko</blockquote><p>{MORE}</p>", f"{LONG} Du ka ko {MORE}"),
    "terms": (f"<p>{LONG}</p><dl><dt>le<dd>li lo</dl><p>{MORE}</p>", f"{LONG} le li lo {MORE}"),
    "inline": (f"<p>{LONG}<a href=x title=it's>du</a> <em>ko</em></p><p>{MORE}", f"{LONG}du ko {MORE}"),
}
FRAMES = {
    "article": "<nav><ul><li><a href=a>Ba</a><li><a href=b>Be</a><li><a href=c>Bi</a></ul></nav><article><h1>Ka ko</h1>{}</article><footer>&copy; Bo bu</footer>",
    "main": "<header><a href=/>Ba be</a></header><main><h1>Ka ko</h1>{}</main><aside><h3>Du</h3><ul><li><a href=a>da</a><li><a href=b>de</a></ul></aside>",
    "classes": '<div class="site-menu"><a href=a>ba</a> <a href=b>be</a> <a href=c>bi</a></div><div class="post-content"><h1>Ka ko</h1>{}</div><div class="footer">&copy; Du da</div>',
    "comments": '<article><h1>Ka ko</h1>{}</article><section id="comments"><article class="comment"><p>Bo ba bu, da du.</p></article></section>',
    "adverts": '<div class="ad-box"><p>Bo ba bu da du</p></div><article><h1>Ka ko</h1>{}</article><div class="cookie-notice">Bi be ba <button>ok</button></div>',
}


@pytest.mark.parametrize("frame", FRAMES)
@pytest.mark.parametrize("body", BODIES)
def test_forty_layouts(extractor, body, frame):
    inside, want = BODIES[body]
    assert extractor.texts([f"<html><body>{FRAMES[frame].format(inside)}</body></html>"])[0] == f"Ka ko {want}"


def test_articles_that_are_comments_teach_no_article():
    assert pages.meaning("article", ' class="comment"') == 0
    assert pages.meaning("article", ' class="post"') == 1
    assert pages.meaning("main", ' id="top"') == 1
    assert pages.meaning("div", "") is None
