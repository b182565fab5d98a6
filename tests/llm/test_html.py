"""Wrappers and main text."""

from __future__ import annotations

import html
import re

from pyspark.sql import functions as F

from tallybook.llm import html_wrappers as hw
from tallybook.llm.queries import QUERIES


def page(title, paragraphs, extra=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<html><head><title>{title}</title><script>var x='</p>';</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        f"<div class='cookie-notice'>We use cookies</div><article><header><h1>{title}</h1></header>{body}{extra}<p>Read more on our site</p></article>"
        f"<aside>Side</aside><section id=comments><p>first!</p></section><form><p>Mail</p></form><footer>&copy; x</footer></body></html>"
    )


def test_wrapper_alignment():
    a = hw.page_wrapper("<div><h1>A</h1><p>x</p></div>")
    b = hw.page_wrapper("<div><h1>A</h1><h2>n</h2><p>y</p><p>z</p></div>")
    assert hw.expression(hw.align(a, b)) == "<div> <h1> 'A' </h1> ( <h2> 'n' </h2> )? ( <p> # </p> )+ </div>"


def test_blocks_of_broken_pages():
    blocks = lambda page: [e[1] for e in hw.events(page) if e[0] == "#"]
    assert blocks("<p>a<p>b &amp; <b>c</b>\n d<br>e<li>x<li>y&#33;<div") == ["a", "b & c d e", "x", "y!"]
    assert list(hw.events(None)) == [] and list(hw.events("")) == []
    assert blocks("x < y <!-- <p>no") == ["x < y"]
    assert blocks("<p>a</p><script>never closed <p>b") == ["a"]


def test_main_text(spark):
    pages = [(i, "http://h.x/a", page(f"T{i}", [f"one {i}", f"two&nbsp;{i}  b"], "<div class=ad>Buy</div>"), "t") for i in range(8)]
    pages += [(8, None, "<body><div><div><p>only text here</p></div><div class=menu>m</div></div></body>", "t"), (9, "http://h.x/", None, "t"), (10, "http://h.x/", "", "t")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string").withColumn("_place", F.lit(1)).withColumn("text", F.lit("own"))
    assert hw.extract(df).columns == ["page_id", "url", "html", "host", "_place", "text"]
    got = {r.page_id: r.text for r in hw.extract(df).collect()}
    for i in range(8):
        assert got[i] == f"T{i}\none {i}\ntwo {i} b\nRead more on our site", got[i]  # a line of the article, though all pages have it
    assert got[8] == "only text here" and got[9] == "" and got[10] == ""
    assert hw.extract(df.limit(0)).count() == 0
    assert {r.page_id: r.text for r in hw.extract(df.repartition(40, "page_id")).collect()} == got  # tasks without rows
    assert [r.text for r in hw.extract(df.where("html is null")).collect()] == [""]


def test_corpus_pages(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = {r.page_id: r for r in QUERIES["op2_html_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(b for b in want if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_copies_on_a_host_keep_their_text(spark):
    """A part that only some pages have is no template, though it reads the same on all of those."""
    own = [(i, page(f"T{i}", [f"one {i}", f"two {i}"])) for i in range(12)]
    copies = [(i, page("Same", ["one", "two"], "<blockquote>a quote of the copied article</blockquote>")) for i in range(20, 28)]
    df = spark.createDataFrame([(i, "http://h.x/a", p) for i, p in own + copies], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in hw.extract(df).collect()}
    assert got[20].split("\n")[:4] == ["Same", "one", "two", "a quote of the copied article"]
    assert got[3].split("\n")[:3] == ["T3", "one 3", "two 3"]


def test_linked_lists_and_names_in_the_article():
    """Lists of links and elements whose ids hold a word such as related stay; containers named so by class do not."""
    linked = "<article><h1>T</h1><p>one</p><ul><li><a href=/a>source one of the text</a></li><li><a href=/b>source two</a></li></ul></article>"
    plain = "<article><h1>U</h1><p>two</p><ul><li>plain item</li></ul></article>"
    wrapper = hw.page_wrapper(plain)
    for _ in range(3):
        wrapper = hw.align(wrapper, hw.page_wrapper(linked))
    place = hw.main_place(wrapper)
    assert hw.main_text(plain, place) == "U\ntwo\nplain item"
    assert hw.main_text(linked, place) == "T\none\nsource one of the text\nsource two"
    named = (
        "<article><h2 id='social-security-alert'>Alert</h2><p class=notice>text</p><section id='related-work'><p>work</p></section>"
        "<div class='related posts'><p>more</p></div><section id=comments><p>first!</p></section></article>"
    )
    assert hw.main_text(named, None) == "Alert\ntext\nwork\nmore"
    assert hw.main_text("<article><section id='related-work'><p>all of it</p></section></article><div><p>side</p></div>", None) == "all of it"


def test_text_does_not_depend_on_the_number_of_pages(spark):
    """Titles, headings and lines that all pages of a host share stay, on four pages as on five and fifty."""
    for n in (1, 4, 5, 50):
        shapes = [
            [f"<article><h1>T</h1><p>Introduction</p><p>body {i}</p></article>" for i in range(n)],
            [f"<article><h1>T</h1><p>a</p><h2>Sources</h2><p>body {i}</p></article>" for i in range(n)],
        ]
        rows = [(k * 1000 + i, f"http://h{k}.x/", p) for k, shape in enumerate(shapes) for i, p in enumerate(shape)]
        got = {r.page_id: r.text for r in hw.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        for i in range(n):
            assert got[i] == f"T\nIntroduction\nbody {i}" and got[1000 + i] == f"T\na\nSources\nbody {i}"


def test_only_the_named_parts_go():
    stays = ["social-history", "related", "share-of-market", "widget", "promotion", "alert-history", "pager", "commentary", "formula"]
    goes = ["menu", "cookie-notice", "ad-box", "sidebar left", "comments", "comment-list", "site-footer", "newsletter", "advert banner"]
    for name in stays:
        assert hw.main_text(f"<article><p>one</p><div class='{name}'><p>two</p></div></article>", None) == "one\ntwo", name
    for name in goes:
        assert hw.main_text(f"<article><p>one</p><div class='{name}'><p>two</p></div></article>", None) == "one", name
    kept = "<article><p hidden>a</p><p style='display:none'>b</p><noscript><p>c</p></noscript><object>d</object><template><p>e</p></template></article>"
    assert hw.main_text(kept, None) == "a\nb\nc\nd\ne"
    gone = "<article><p>x</p><aside>s</aside><form>f</form><script>j</script><style>c</style><nav>n</nav><footer>z</footer></article>"
    assert hw.main_text(gone, None) == "x"


def test_deep_and_long_pages():
    deep = "<article>" + "<div>" * 5000 + "<p>bottom</p>" + "</div>" * 5000 + "<p>end</p></article>"
    long = "<article>" + "".join(f"<h2>h {i}</h2><p>p {i}</p>" for i in range(10_000)) + "</article>"
    other = "<article>" + "".join(f"<p>q {i}</p><h2>g {i}</h2><h3>s</h3>" for i in range(7_000)) + "</article>"
    wrapper = hw.align(hw.align(hw.page_wrapper(deep), hw.page_wrapper(long)), hw.page_wrapper(other))
    wrapper = hw.from_flat(hw.flat(wrapper))
    assert len(hw.flat(wrapper)) < 5100 and hw.expression(wrapper)
    place = hw.main_place(wrapper)
    assert hw.main_text(long, place).split("\n")[-2:] == ["h 9999", "p 9999"] and hw.main_text(long, place).count("\n") == 19_999
    assert hw.main_text(deep, place) == hw.main_text(deep, None) == "bottom\nend"
    strange = "<article>" + "".join(f"<x{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{i}>t</x>" for i in range(20_000)) + "</article>"
    assert hw.main_text(strange, hw.main_place(hw.page_wrapper(strange))).count("t") == 20_000
    huge = "<article><p>" + "word " * 1_000_000 + "</p></article>"
    assert len(hw.main_text(huge, None)) == 4_999_999


def test_repeated_stretches():
    wrapper = hw.page_wrapper("<div><h1>A</h1><h2>b</h2><p>c</p><h2>d</h2><p>e</p><ul>f</ul></div>")
    assert hw.expression(wrapper) == "<div> <h1> 'A' </h1> ( <h2> # </h2> <p> # </p> )+ <ul> 'f' </ul> </div>"
    again = hw.align(wrapper, hw.page_wrapper("<div><h1>A</h1><ul>f</ul></div>"))
    assert hw.expression(again) == "<div> <h1> 'A' </h1> ( ( <h2> # </h2> )? ( <p> # </p> )? )+ <ul> 'f' </ul> </div>"
    assert hw.expression(hw.from_flat(hw.flat(again))) == hw.expression(again)
    # two orders of the same elements make one repeated stretch of both
    both = hw.align(hw.page_wrapper("<h1>A</h1><p>b</p>"), hw.page_wrapper("<p>b</p><h1>A</h1>"))
    assert hw.expression(both) == "( <h1> 'A' </h1> <p> 'b' </p> )+"
