from __future__ import annotations

import time

import numpy as np
import pytest
from checks import TABLES, duck, duck_rows, spark_rows

from loadgrain.llm.oracle import ORACLE
from loadgrain.llm.page_text import WINDOW, between_surge_and_dive, extract_main_text, main_texts
from loadgrain.llm.queries import QUERIES

LONG = "This paragraph is long enough for a surge of the distribution, as it has more characters than menus and notices do."
TWO = "Another paragraph follows it, and it is as long, so that the sum over three lines stays high until the article ends."
MENU = "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(8))


def one(html):
    return main_texts([html])[0]


def test_article_among_everything_else():
    page = f"""<!DOCTYPE html><html><head><title>A &amp; B</title><style>p {{ x: "</p>" }}</style><script>if (a < b) x("<p>no</p>")</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul>{MENU}</ul></nav>
    <div class="cookie-notice">We use cookies, and this notice says at length why that is so and what you may do about it now.</div>
    <main><article><header><h1>Title &eacute;&#233;&#xe9;</h1></header><p>{LONG}</p><p>Hi.</p>
    <aside><p>{TWO}</p></aside><div class="ad">Buy this {TWO}</div><form><input value="x"><label>Your name</label></form>
    <p>white\n\t space&nbsp;<b>in</b><i>line</i><br>and a break</p><!-- <p>{TWO}</p> --><p hidden>{TWO}</p><p style="display: none">{TWO}</p>
    <ul><li>one</li><li><a href="x">two</a></li></ul><section id="comments"><p>{TWO}</p></section>
    <article><p>{TWO}</p></article><footer>by me</footer></article></main>
    <div id="sidebar">{TWO}</div><footer><p>{TWO}</p></footer></body></html>"""
    assert one(page) == "\n\n".join(["Title ééé", LONG, "Hi.", "white space inline and a break", "one", "two"])


def test_page_without_known_elements():
    """Nothing but the distribution tells the text from what stands around it."""
    page = f"""<body><div><div>{MENU}</div></div><div><div><div><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{TWO}</p></div></div></div>
    <div><div><div><p>Imprint, terms</p></div></div></div></body>"""
    assert one(page) == "\n\n".join(["Head", LONG, "Short.", TWO])


def test_hints_that_hold_the_article():
    assert one(f'<body><form class="page comments"><div class="ad-free"><article><p>{LONG}</p></article></div></form></body>') == LONG
    assert one(f'<body><form id="f"><p>{LONG}</p></form></body>') == LONG  # nothing else is there


def test_broken_markup():
    assert one(f"<article><p>{LONG}<p>{TWO}") == f"{LONG}\n\n{TWO}"
    assert one(f'<div class="ad">unclosed advert <article><p>{LONG}</p></article>') == LONG
    assert one(f"<article><p>{LONG}</p></article><footer>cut off") == LONG
    assert one(f'<article><p title="a > b" data-x=\'</p>\'>{LONG}</p><p>cut <b') == f"{LONG}\n\ncut"
    assert one(f'<article><p class="a"">{LONG}</p></article><script>never closed <p>{TWO}</p>') == LONG
    assert one(f"<article><p>{LONG}</p><!-- never closed <p>{TWO}</p></article>") == LONG
    assert one(f"</div></p><article></b><p>3 < 4 &amp; 5 &lt; 6 &am &quo; &unknown; {LONG}</p></article>") == (
        f"3 < 4 & 5 < 6 &am &quo; &unknown; {LONG}"
    )


@pytest.mark.parametrize("html", [None, "", " \n ", "<p></p>", "<html><body><nav>menu</nav></body></html>", "<script>x</script>", "<", "<!", "&"])
def test_pages_without_text(html):
    assert one(html) in ("", "<", "&")


def test_short_and_plain_pages():
    assert one("<article><h1>A</h1><p>B</p></article>") == "A\n\nB"
    assert one("just text") == "just text"
    assert one(f"<article><p>tiny</p></article><p>{LONG}</p><article><p>{TWO}</p></article>") == f"tiny\n\n{TWO}"


def test_distribution_against_a_plain_one():
    rng = np.random.default_rng(5)
    for _ in range(200):
        pages = [np.where(rng.random(n) < 0.6, 0, rng.integers(1, 60, n)) for n in rng.integers(0, 40, 4)]
        surge = rng.integers(1, 100, 4)
        padded = [np.append(p, np.zeros(WINDOW, int)) for p in pages]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in padded])])
        found = between_surge_and_dive(np.concatenate(padded), starts, surge)
        for page, least, a in zip(pages, surge, starts, strict=False):
            expected, stretch = [], []
            for i in [*range(len(page)), None]:
                if i is not None and (page[i : i + WINDOW].sum() or page[i]):
                    stretch.append(i)
                    continue
                if stretch and max(page[j : j + WINDOW].sum() for j in stretch) >= least:
                    heavy = [j for j in stretch if page[j]]
                    expected += range(heavy[0], heavy[-1] + 1)
                stretch = []
            assert np.flatnonzero(found[a : a + len(page)]).tolist() == expected


@pytest.mark.parametrize("piece", ["<p>", "<div class='ad'>", "<!--", "<a \"", "</div>", "<script>", "&amp", "<p title='", "<x ="])
def test_long_pages_take_linear_time(piece):
    def seconds(n):
        began = time.perf_counter()
        one(piece * n)
        return time.perf_counter() - began

    seconds(100)
    assert seconds(40_000) < 25 * seconds(4_000) + 0.5


def test_rows_are_kept(spark):
    rows = [(1, "u", None, 7), (1, "u", f"<p>{LONG}</p>", 8), (None, None, "", 9)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = extract_main_text(table)
    assert found.columns == ["page_id", "url", "html", "text"]
    assert sorted((r["page_id"], r["text"]) for r in found.collect() if r["page_id"]) == [(1, ""), (1, LONG)]
    assert found.count() == 3 and extract_main_text(table.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_and_sql(spark, sf):
    sf = str(TABLES / sf)
    assert spark_rows(QUERIES["op13_line_blocks"](spark, sf)) == duck_rows(duck(sf), ORACLE["op13_line_blocks"])
