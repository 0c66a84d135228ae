"""Main text extraction: the article of pages of many shapes, the density formula, and odd markup."""

import math
import re
from html import unescape

import pytest

from lociweave.llm import dom, maintext
from lociweave.llm.queries import QUERIES

BOILER = (
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/b">All our sections and more</a></li></ul></nav><div class="ad">Buy this now, it is very good.</div>'
)
LONG = "A long sentence about rivers that goes on for a while, as sentences in articles do. " * 3


def page(body, head="<title>T</title><style>p{x:1}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


CASES = {
    "article": (page(BOILER + "<article><h1>Title</h1><p>One.</p><p>Two &amp; three&hellip;</p></article><footer>&copy; me</footer>"), "Title\nOne.\nTwo & three…"),
    "left open": (page("<article><h1>Title</h1><p><b>One.<br><p>Two <i>more</i><p>Three"), "Title\nOne.\nTwo more\nThree"),
    "cut off": ("<html><body><article><p>Whole.</p><p>Half <a href='x", "Whole.\nHalf"),
    "no landmark": (
        page(f'<div id="top-menu"><a href="/">x</a></div><div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div id="footer">{LONG}</div>'),
        f"Title\n{LONG.strip()}\nShort.\n{LONG.strip()}",
    ),
    "links beside": (
        page("<div>" + "".join(f'<li><a href="{i}">An unmarked list of links {i}</a></li>' for i in range(40)) + f"</div><div><p>{LONG}</p><p>{LONG}</p></div>"),
        f"{LONG.strip()}\n{LONG.strip()}",
    ),
    "one paragraph": (page(BOILER + f'<main><p>Few <a href="a">links</a> <a href="b">here</a> <a href="c">are</a> fine.</p></main>{LONG}'), "Few links here are fine."),
    "comments": (
        page(f'<article><p>Text.</p><section id="comments"><article class="comment"><p>{LONG}</p></article></section><aside>{LONG}</aside></article>'),
        "Text.",
    ),
    "wrapped": (page('<div class="with-sidebar"><div class="sidebar main-menu"><article class="post comments-open no-ads"><p>Text.</p></article></div></div>'), "Text."),
    "page header": (page("<header><h1>The site</h1></header><article><header><h1>Title</h1></header><p>Text.</p></article>"), "Title\nText."),
    "forms and notices": (page('<div role="alert">Look!</div><article><p>Text.</p><form>Mail <input></form><div class="cookie-notice">Yes?</div></article>'), "Text."),
    "white space": (page("<article><p>  a\n\t b&nbsp;c<br>d<!-- e -->f </p>\n<pre>g\n  h</pre></article>"), "a b c df\ng h"),
    "table": (page("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e<ul><li>f</ul><li>g</ul></article>"), "a\nb\nc\nd\ne\nf\ng"),
    "lone signs": (page("<article><p>1 < 2 <3 a&b &am</p></article>"), "1 < 2 <3 a&b &am"),
    "plain text": ("just &lt;text&gt;", "just <text>"),
    "empty landmark": (page(f"<main> </main><div><p>{LONG}</p></div>"), LONG.strip()),
    "nothing": (page(BOILER), ""),
    "empty": ("", ""),
    "open comment": ("<body><p>a</p><!-- <p>b</p>", "a"),
    "unfinished script": ("<body><p>a</p><script>var x = '<p>b</p>'", "a"),
    "quoted sign": ('<body><article><p title="a > b" class=x>c</p></article>', "c"),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    html, want = CASES[name]
    assert maintext.main_text(html) == want


def test_deep_and_long_pages():
    assert maintext.main_text("<div>" * 50_000 + "deep" + "</div>" * 49_000 + "<p>after") == "deep\nafter"
    assert maintext.main_text("<p><b>" * 30_000 + "x") == "x"
    words = "word " * 400_000
    assert maintext.main_text(f"<article><p>{words}</p></article>") == words.strip()
    assert maintext.main_text("<a href='" * 20_000) == ""
    assert maintext.main_text("<td>a</div>" * 20_000).count("a") == 20_000


def test_densities_follow_the_formula():
    html = '<body><div><p>abcdef<a href="x">gh</a></p><p>ijkl</p></div><ul><li><a>mnopqr</a></li></ul></body>'
    read = dom.read_page(html)
    lengths = [len("".join(t.split())) for t in read.texts]
    stays = [True] * len(read.tags)
    density, sums = maintext.densities(read, stays, lengths, 1)

    def plain(chars, tags, link_chars, link_tags):
        share = 8 / 18
        base = math.log(chars / max(chars - link_chars, 1) * max(link_chars, 1) + share * chars + math.e)
        return chars / max(tags, 1) * math.log(chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)) / math.log(base)

    where = {f"{t}{read.tags[:i].count(t)}": i for i, t in enumerate(read.tags)}
    want = {"p0": plain(8, 1, 2, 1), "p1": plain(4, 0, 0, 0), "div0": plain(12, 3, 2, 1), "ul0": plain(6, 2, 6, 1), "body0": plain(18, 7, 8, 2)}
    for name, value in want.items():
        assert density[where[name]] == pytest.approx(value)
    assert sums[where["div0"]] == pytest.approx(want["p0"] + want["p1"])
    assert sums[1] == pytest.approx(want["div0"] + want["ul0"])


def test_rows_of_the_operator(spark):
    rows = [(1, "u", CASES["article"][0], 5), (1, "u", CASES["article"][0], 5), (None, None, None, None), (2, "v", "", 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(map(tuple, maintext.extracted(pages).collect()), key=str)
    text = CASES["article"][1]
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert maintext.extracted(pages.limit(0)).count() == 0


def test_query_gives_what_lies_in_the_article(spark):
    folder = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>)", r.html, re.S).group(1).replace("<br>", " ")
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        want[r.page_id] = (r.url, "\n".join(b for b in blocks if b))
    got = {r.page_id: (r.url, r.text) for r in QUERIES["op11_html_text"](spark, folder).collect()}
    assert got == want
