"""Main text of pages: whole pages of the table, layouts by hand, and the second
pass against a quadratic version of it."""

import html
import random
import re
import time

import pytest

from ledgerlens.llm import html_text
from ledgerlens.llm.html_blocks import HEADINGS, Block, blocks
from ledgerlens.llm.html_text import main_text
from ledgerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PROSE = "The river is wide at this point and it was crossed by a ferry for the people of the town"
MORE = "Die Stadt ist für den Handel mit Holz und Salz bekannt und liegt an der alten Straße"


def test_whole_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id])[1].replace("<br>", " ")
        parts = ["".join(html.unescape(x) for x in re.split(r"<[^>]*>", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(" ".join(p.split()) for p in parts if p.split())
        assert r.n_chars == len(r.text)


def test_page_without_an_article_element():
    page = f"""<html><head><title>Town - Site</title><style>p {{}}</style></head><body class="has-sidebar">
      <div id="header"><h2>The Site of the Town</h2></div><ul class="main-nav"><li><a href="/">Home</a><li><a href="/x">The news</a></ul>
      <div id="content"><h1>Ferry &amp; town</h1><p>{PROSE}.<p>Yes.</p><p>{MORE}<br>am Fluss&nbsp;.</p><ul><li>salt</li><li>wood</li></ul><p>{PROSE}</p></div>
      <div class="side-bar sidebar-left"><p>{PROSE}</p></div><section id="comments"><article class="comment"><p>{PROSE} I think.</p></article></section>
      <form><p>{PROSE}</p><button>Send the form</button></form><div role="alert">{PROSE}</div><div style="display: none">{PROSE}</div>
      <!-- <p>{PROSE}</p> --><script>document.write("<p>{PROSE}</p>")</script><footer>&copy; {PROSE}</footer></body></html>"""
    assert main_text(page) == "\n\n".join(["Ferry & town", PROSE + ".", "Yes.", MORE + " am Fluss .", "salt", "wood", PROSE])


def test_article_element():
    page = f"""<div>{PROSE}</div><main><header><h1>One</h1><p>By the writer of the town</p></header><p>a | b | c</p><p><a href=x>{PROSE}, {MORE}</a></p>
      <ul><li><a href=1>Next page of the list</a></li></ul><p>{PROSE}<aside>{PROSE}</aside><p>end &lt;p&gt;<footer>{PROSE}</footer></main>
      <p>{MORE}</p>"""
    assert main_text(page) == "\n\n".join(["One", "a | b | c", f"{PROSE}, {MORE}", PROSE, "end <p>"])
    assert main_text("<article><p>x | y</p></article>") == "x | y"  # nothing decided: the marked part is the text
    assert main_text("<nav>n</nav><p>x | y</p>") == ""


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<script>x", "</", "<p class='", "&", "<>", "</p></p></div>", "\x00", "<title>t</title>"])
def test_no_text(page):
    assert main_text(page) in ("", "<", "&", "<>", "\x00")


def test_unfinished_markup():
    assert [b.text for b in blocks(f"a < b & c &amp d &#233;&bogus; <p title=\"x>y\">{PROSE}<!-- no end")] == ["a < b & c & d é&bogus;", PROSE]
    assert [b.text for b in blocks("one<script>two</p></scrip>three")] == ["one"]
    assert [b.text for b in blocks("x<br/>y<td>z<b>w</td>v")] == ["x y", "zw", "v"]


def nearest(i, page, labels, allowed):
    """By trying all blocks: label of the nearest decided allowed one."""
    before = max(((j, labels[j]) for j in range(i) if allowed(j) and labels[j] is not None), default=None)
    after = min(((j, labels[j]) for j in range(i + 1, len(page)) if allowed(j) and labels[j] is not None), default=None)
    if before is None or after is None:
        return (before or after or (0, None))[1]
    if before[1] == after[1] or page[i].kind in HEADINGS:
        return after[1]
    if i - before[0] == after[0] - i:
        return True
    return (before if i - before[0] < after[0] - i else after)[1]


def test_second_pass():
    rnd = random.Random(4)
    for _ in range(300):
        page = [Block("w", 0, rnd.randrange(3), rnd.choice(["p", "h2"]), rnd.random() < 0.2, rnd.random() < 0.5) for _ in range(rnd.randint(0, 25))]
        labels = [False if b.aside else rnd.choice([None, None, True, False]) for b in page]
        want = []
        for i, (b, label) in enumerate(zip(page, labels)):
            if label is None:
                label = nearest(i, page, labels, lambda j: page[j].parent == b.parent and not page[j].aside)
            if label is None:
                label = nearest(i, page, labels, lambda j: page[j].article == b.article and not (b.article and page[j].aside))
            want.append(b.article if label is None else label)
        assert html_text.inherit(page, labels) == want


@pytest.mark.parametrize("piece", ["<div>", "<p class=\"a", "<!--", "<", "<li><a>y", "</div><b>", "&", "<i class=ad>", f"<p>{PROSE}</p><div><b>"])
def test_very_long_pages_take_linear_time(piece):
    start = time.monotonic()
    main_text(piece * 30_000)
    assert time.monotonic() - start < 30


def test_frame(spark):
    rows = [(1, None, f"<p>{PROSE}</p>", "clash", 0), (None, "u", None, "clash", 0), (None, "u", None, "clash", 0), (2, "u", "<p>" + f"{PROSE}. " * 60_000, "t", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(df).collect()
    assert sorted((r.row.page_id or 0, r.row.text, r.n_chars) for r in got) == [(0, "clash", 0), (0, "clash", 0), (1, "clash", len(PROSE)), (2, "t", (len(PROSE) + 2) * 60_000 - 1)]
    assert html_text.extract(df.limit(0), ["page_id"]).collect() == []
