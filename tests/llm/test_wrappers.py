from __future__ import annotations

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimflow.llm import wrappers
from claimflow.llm.queries import queries


def matches(wrapper, tokens):
    """Whether a wrapper, as a regular expression, accepts a stream written out."""
    def pattern(nodes):
        return "".join(f"(?:{pattern(n[1])}){n[0]}" if isinstance(n, list) else re.escape(n) + ";" for n in nodes)

    return re.fullmatch(pattern(wrapper), "".join(t + ";" for t in tokens)) is not None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc#"), max_size=7), min_size=1, max_size=4))
def test_wrapper_accepts_its_streams(streams):
    wrapper = wrappers.collapsed(list(streams[0]))
    for s in streams[1:]:
        wrapper = wrappers.merge(wrapper, wrappers.collapsed(list(s)))
    for s in streams:
        assert matches(wrapper, s)


def wrapper_of(pages):
    wrapper = wrappers.stream_of(pages[0])
    for p in pages[1:]:
        wrapper = wrappers.merge(wrapper, wrappers.stream_of(p))
    return wrapper


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc#"), max_size=9), min_size=1, max_size=4))
def test_matcher_finds_every_slot(streams):
    wrapper = wrappers.collapsed(list(streams[0]))
    for s in streams[1:]:
        wrapper = wrappers.merge(wrapper, wrappers.collapsed(list(s)))
    matcher = wrappers.Matcher(wrapper)
    assert len(matcher.group) == len(list(wrappers.slots(wrapper)))
    for s in streams:
        assert len(matcher.match(s)) == s.count("#")
    for other in (["d"], ["a"] * 30 + ["d"]):
        assert matcher.match(other) is None


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdefgh#"), max_size=40), min_size=2, max_size=3))
def test_long_streams_are_cut(streams):
    cells, wrappers.CELLS = wrappers.CELLS, 20
    try:
        wrapper = wrappers.collapsed(list(streams[0]))
        for s in streams[1:]:
            wrapper = wrappers.merge(wrapper, wrappers.collapsed(list(s)))
    finally:
        wrappers.CELLS = cells
    assert all(wrappers.Matcher(wrapper).match(s) is not None for s in streams)


def test_two_long_pages_in_bounded_memory():
    import random
    import tracemalloc

    chance = random.Random(3)
    pages = [[chance.choice(["p", "/p", "#", "div.a", "/div.a", "ul", "li", "h2"]) for _ in range(20_000)] for _ in range(2)]
    streams = [wrappers.collapsed(p) for p in pages]
    tracemalloc.start()
    wrapper = wrappers.merge(*streams)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    matcher = wrappers.Matcher(wrapper)
    assert all(len(matcher.match(p)) == p.count("#") for p in pages)


def story(i, n, extra=""):
    """A page without article or main, with unnamed parts that are the same on all pages of its host."""
    return (
        f"<body><div class=top><ul><li>Home</li><li>News</li><li>About</li></ul></div><div class=a><p>We moved house.</p></div>"
        f"<div class=b><h1>Title {i}</h1>{extra}<p>Text {i} goes.</p>{''.join(f'<p>More {i} {k}.</p>' for k in range(n))}"
        f"<div class=c>Buy now</div></div><div class=z><p>All rights kept.</p></div></body>"
    )


def test_constant_slots_are_template(spark):
    rows = [(i, f"http://a.org/{i}", story(i, i % 4, "<ul><li>x</li></ul>" if i == 2 else "")) for i in range(9)]
    rows += [(100 + i, f"http://b.org/{i}", story(1, 2)) for i in range(5)]  # copies of one page: nothing tells template
    rows += [(200 + i, f"http://c.org/{i}", f"<article><h1>T {i}</h1><div class=promoted-box>Buy</div><p>w {i}</p></article>") for i in range(4)]
    rows += [(300 + i, f"http://d.org/{i}", f"<article><h1>Same</h1><p>w {i}</p></article>") for i in range(6)]
    rows += [(400 + i, f"http://e.org/{i}", f"<main><p>w {i}</p></main><article>teaser {i}</article>") for i in range(2)]
    got = {r.page_id: r.text for r in wrappers.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(9):
        lines = [f"Title {i}", *(["x"] if i == 2 else []), f"Text {i} goes.", *[f"More {i} {k}." for k in range(i % 4)]]
        assert got[i] == "\n".join(lines)
    assert all("Text 1 goes." in got[100 + i] and got[100 + i] == got[100] for i in range(5))
    assert [got[200 + i] for i in range(4)] == [f"T {i}\nw {i}" for i in range(4)]
    assert [got[300 + i] for i in range(6)] == [f"Same\nw {i}" for i in range(6)]  # one heading: pages may be copies
    assert [got[400 + i] for i in range(2)] == [f"w {i}" for i in range(2)]


def test_text_that_few_pages_share_stays(spark):
    rows = [
        (i, f"http://a.org/{i}", f"<article><h1>T {i}</h1><p>w {i}</p>{'<h2>Summary</h2><p>s</p>' if i < 4 else ''}</article>")
        for i in range(12)
    ]
    got = {r.page_id: r.text for r in wrappers.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"T {i}\nw {i}" + ("\nSummary\ns" if i < 4 else "") for i in range(12))


def test_repeats_and_optionals():
    a = wrappers.stream_of("<div><h1>t</h1><p>a</p><p>b</p><p>c</p></div>")
    b = wrappers.stream_of("<div><h1>t</h1><div class=note>n</div><p>a</p></div>")
    got = wrappers.expression(wrappers.merge(a, b))
    assert got == "<div> <h1> # </h1> (<div.note> # </div.note>)? (<p> # </p>)+ </div>"


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain   text\n here", "plain text here"), ("<p>a<p>b &amp; c<br>d</p>", "a\nb & c d"),
    ("<article><h1>T</h1><p><b>T<br><p>x &lt;y&gt;</p></article><footer>f</footer>", "T\nT\nx <y>"),
    ("<nav>n</nav><article>a<aside>s</aside>b<div class='ad'>x</div><p>c</article>z", "a\nb\nc"),
    ("<script>var t='<article>no</article>';</script><article>yes", "yes"), ("<article>a &nbsp; b 1 < 2</article>", "a b 1 < 2"),
    ("<article>a<!-- <p>no</p> -->b<form>q</form></article>", "ab"), ("<article><p>x<a href='>'>l</a></p><section id=comments>c</section></article>", "xl"),
    ("<body><header>h</header><div class='cookie-notice'>c</div><p>a</p></body>", "a"), ("<article><header><h1>t</h1></header>b</article>", "t\nb"),
    ("<article>&#x41;&eacute;&copy;</article>", "Aé©"), ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ("<article a='x>y", "y"),
])
def test_main_text(page, want):
    assert wrappers.main_text(page, "article" if "<article" in page else "") == want


def test_container_without_article():
    pages = [
        f"<body><div class=top><ul><li>x</li><li>y</li></ul></div><div class=story><p>{i}</p><p>b</p>{'<p>c</p>' * i}</div>"
        f"<div class=low>z</div></body>" for i in range(3)
    ]
    wrapper = wrappers.stream_of(pages[0])
    for p in pages[1:]:
        wrapper = wrappers.merge(wrapper, wrappers.stream_of(p))
    assert wrappers.container_of(wrapper) in ("div.story", "")
    assert "b" in wrappers.main_text(pages[0], wrappers.container_of(wrapper))


def test_edge_rows(spark):
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    rows = [
        (1, "http://a.org/1", "<nav>m</nav><article><p>x</p></article>"), (2, "http://a.org/2", None), (3, None, "<p>no host</p>"),
        (None, "http://a.org/3", ""), (4, "HTTP://A.org:80/4", "<article>y</article><div class=comments>c</div>"), (5, "junk", "<p>a<p>b"),
        (4, "HTTP://A.org:80/4", "<article>y</article><div class=comments>c</div>"), (6, "http://b.org/", long),
    ]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "page_id long, url string, html string, host string, salt int")
    got = wrappers.extract_main_text(df).collect()
    assert len(got) == len(rows)
    texts = {(r.page_id, r.url): r.text for r in got}
    assert texts == {
        (1, "http://a.org/1"): "x", (2, "http://a.org/2"): "", (3, None): "no host", (None, "http://a.org/3"): "",
        (4, "HTTP://A.org:80/4"): "y", (5, "junk"): "a\nb", (6, "http://b.org/"): "\n".join(["word"] * 20_000),
    }
    assert all(r.n_chars == len(r.text) for r in got)
    assert wrappers.extract_main_text(df.limit(0)).count() == 0


def test_query_against_the_pages_own_article(spark):
    """In these pages the article is one element; its blocks, read plainly, are the main text."""
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries()["op7_wrapper_main_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|ul|ol|li|div|pre|h2|table|tr|td)\b[^>]*>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.url == pages[r.page_id].url
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("page, want", [
    ("<div class='site has-sidebar'><article><p>a</p></article></div>", "a"),
    ("<div id=page class='no-comments'><p>a</p><p>b</p></div>", "a\nb"),
    ("<article><div class='article-header'><h1>t</h1></div><p>a</p></article>", "t\na"),
    ("<article><div class='header'><h1>t</h1></div><p>a</p></article>", "t\na"),
    ("<article><section id='related-work'><p>r</p></section><div class='form-group'>f</div></article>", "r\nf"),
    ("<article><p>a</p><div class='comments-area'>c</div><div class='ad-slot'>x</div><div class='share-links'>s</div></article>", "a"),
    ("<body><div class='header'>h</div><div class='site-footer'>f</div><p>a</p></body>", "a"),
    ("<div class='widget'><main><p>a</p></main></div>", "a"), ("<div class='search'><p>a</p><p>b</p></div><p>c</p>", "a\nb"),
    ("<article>a</article><section id=comments><article>c</article></section>", "a"),
])
def test_zones_are_whole_names(spark, page, want):
    df = spark.createDataFrame([(1, "http://a.org/", page)], "page_id long, url string, html string")
    assert wrappers.extract_main_text(df).first().text == want
