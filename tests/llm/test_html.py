"""HTML extraction: planted pages against a direct reading, and awkward markup."""

from __future__ import annotations

import re
import time
from html import unescape

import pandas as pd
import pytest

from parcelmart.llm.html_template import Page, deduce_templates, extract_main_text, host_of, main_text
from tests.conftest import SMALL

WILD = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1><nav>
<a href=1>Home</a></nav></header><div id="cookie-notice">We use cookies</div><aside>side</aside><article><header><h1>Title &amp;
more</h1></header><p>One <a href="x>y">two</a>&nbsp;three<p>Four<br>five <b>six</b></p><ul><li>a<li>b</ul><table><tr><td>1<td>2
</table><form><input>Subscribe</form><script>if (a<b) "</article>"</script><!-- <p>no</p> --><div class='advert'>Buy</div>
<section id="comments"><p>nice!</p></section><p>a < b &lt;c&gt;</p></article><div class="comments"><p>first</p></div>
<footer>f</footer></body>"""
WILD_TEXT = "Title & more\nOne two three\nFour five six\na\nb\n1\n2\na < b <c>"
DIVS = """<body><div class=top><a href=1>Home</a> <a href=2>Away</a></div><div id=content><h2>T</h2><p>Long {} text here, with words.
</p><p>More of it, and more again.</p></div><div class=foot>Imprint of the page</div></body>"""


def direct(html: str) -> str:
    inside = html[html.index("<article>") + 9 : html.index("</article>")]
    blocks = re.split("</?(?:p|h1)>", inside)
    plain = (" ".join(unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in blocks)
    return "\n".join(b for b in plain if b)


def test_planted_pages(spark):
    pages = pd.read_parquet(f"{SMALL}/pages.parquet").set_index("page_id")
    rows = extract_main_text(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == direct(pages.html[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_wild_page():
    assert main_text(WILD) == WILD_TEXT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b", "a\nb"),
        ("<article><p>x</article><article><p>longer one</article>", "longer one"),
        ("<main><p>m</main><p>outside", "m"),
        ("<article>a<br/>b &#233;&eacute; &copy;</article>", "a b éé ©"),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
        ("<article>a <!-- never closed", "a"),
        ("<article><script>never closed", ""),
        ('<article><p title="a > b">q</p><p class="x" id=\'y>p</p></article>', "q\np"),
    ],
)
def test_odd_pages(html, text):
    assert main_text(html) == text


def test_divs_and_messy_rows(spark):
    rows = [(i, f"http://a.b/{i}", DIVS.format(i), "clash") for i in range(6)]
    rows += [(0, "http://a.b/0", DIVS.format(0), "x"), (9, None, None, None), (10, "no address", "", ""), (None, "http://a.b:80/", WILD, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    found = sorted(extract_main_text(pages).collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0))
    expected = [f"T\nLong {i} text here, with words.\nMore of it, and more again." for i in (0, 0, 1, 2, 3, 4, 5)]
    assert [r["text"] for r in found] == [*expected, "", "", WILD_TEXT]
    assert extract_main_text(pages.limit(0)).count() == 0


def test_classes_of_a_template(spark):
    pages = spark.createDataFrame([(i, "h", DIVS.format(i) + "<i>" * (i % 2)) for i in range(5)], "page_id long, host string, html string")
    rows = {r["token"]: r for r in deduce_templates(pages).collect()}
    assert rows[">body>div.content"]["main"] and sum(r["main"] for r in rows.values()) == 1
    assert rows[">body"]["class_id"] == rows[">body>div.content"]["class_id"] != rows[">body>div.content>p"]["class_id"]


def test_hosts(spark):
    urls = ["HTTPS://User@Ex.Org:8/x?y", "http://a.b", "//c/d", None, "mailto:x", "http://[bad"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(host_of(frame.url)).collect()] == ["ex.org", "a.b", "", "", "", "[bad"]


PROSE = "Plenty of words number {} stand in this paragraph, which is the page's own."


def texts(spark, pages: list[str]) -> list[str]:
    rows = [(i, f"http://t.h/{i}", p) for i, p in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r["text"] for r in sorted(extract_main_text(frame).collect(), key=lambda r: r["page_id"])]


def test_text_on_every_page_is_template(spark):
    """Menus and notices without telling class words, in the body and within a slot, beside a layout with an article."""
    notice = "<div class=q>This site is run by volunteers and pays for itself.</div>"
    plain = ["<body><div class=x>Home and away</div>" + f"<p>{PROSE.format(i)}</p>" + notice + "</body>" for i in range(8)]
    inner = [f"<body><article><p>{PROSE.format(i)}</p>{notice}</article><div class=x>Home and away</div></body>" for i in range(4)]
    assert texts(spark, plain + inner) == [PROSE.format(i) for i in [*range(8), *range(4)]]
    copies = texts(spark, [plain[0]] * 4)
    assert all(PROSE.format(0) in t for t in copies)


@pytest.mark.parametrize("name", ["page has-sidebar", "content-sidebar-wrap", "no-sidebar", "comments"])
def test_wrappers_stay(name):
    assert main_text(f"<body><div class='{name}'><article><p>{PROSE}</p></article></div></body>") == PROSE
    assert main_text(f"<body><div class='{name}'><div><p>{PROSE}</p></div></div><nav>Home</nav></body>") == PROSE


@pytest.mark.parametrize("name", ["id=discussion", "class=related-work", "class=search-results"])
def test_real_sections_stay(name):
    assert main_text(f"<article><p>{PROSE}</p><section {name}><p>{PROSE}</p></section></article>") == f"{PROSE}\n{PROSE}"


COMMENTS = "".join(f"<div class=comment><p>I read number {{}} twice and have much more to say about it, says reader {i}.</p></div>" for i in range(3))


@pytest.mark.parametrize(
    "page",
    [
        "<body><article><p>{prose}</p><section class=comments><h3>Comments</h3>{comments}</section></article></body>",
        "<body><main><p>{prose}</p><section class=comments-wrap>{comments}</section></main></body>",
        "<body><div id=content><p>{prose}</p></div><div id=comments>{comments}</div></body>",
        "<body><div id=content><p>{prose}</p><h3>Comments</h3>{comments}</div></body>",
        "<body><article><p>{prose}</p></article><article class=comment-body>{comments}</article></body>",
        "<body><div id=content><p>{prose}</p></div><div class=comments><article>{comments}</article><article>{comments}</article></div></body>",
        "<body><div id=content><p>{prose}</p></div><footer>{comments}{comments}</footer></body>",
        "<body><form id=page><h1></h1><div id=content><p>{prose}</p></div></form><p></p><footer>{comments}</footer></body>",
    ],
)
def test_what_is_not_the_article_goes_whatever_its_share(spark, page):
    pages = [page.format(prose=PROSE.format(i), comments=COMMENTS.format(i, i, i)) for i in range(6)]
    assert texts(spark, pages) == [PROSE.format(i) for i in range(6)]


def test_headings_of_real_sections_stay():
    page = f"<article><h1>T</h1><p>{PROSE}</p><h2>S</h2><div class=advert>Buy</div><p>text</p><h2>Replies</h2><div class=comment>me</div></article>"
    assert main_text(page) == f"T\n{PROSE}\nS\ntext"


@pytest.mark.parametrize("unit", ["<div", "a<b;", "<!", "<!--", "</script ", "<a '>'"])
def test_unclosed_markup_costs_its_length(unit):
    began = time.process_time()
    main_text(unit * ((1 << 20) // len(unit)) + '"')
    main_text("<p>x</p>" + unit * ((1 << 20) // len(unit)))
    assert time.process_time() - began < 10


def test_deep_containers_are_told_apart():
    page = Page().read("<div>" * 70 + "<div class=a><p>x</p></div><div class=b><p>y</p></div>")
    a, b = (e for _, e, _ in page.blocks)
    assert a.path != b.path and a.path.rpartition(">")[0] == b.path.rpartition(">")[0]
