"""Main text of pages: hand-written pages, the densities against plain recursion, dirt."""

from __future__ import annotations

import html
import math
import random
import re

import pytest
from conftest import same_rows

from starwash.llm import maintext
from starwash.llm.maintext import main_text

LOREM = "Far out in the western bay the old ferry still runs twice a day, and the crew knows every passenger by name."
PARAGRAPHS = "".join(f"<p>{LOREM} Paragraph {i}.</p>" for i in range(6))
TEXT = " ".join(f"{LOREM} Paragraph {i}." for i in range(6))
MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(9)) + "</ul></nav>"
FOOTER = "<footer>&copy; 2024 Someone, all rights reserved, with a rather long sentence of legal words.</footer>"


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("body,expected", [
    (f"{MENU}<article><h1>Ferry</h1>{PARAGRAPHS}</article>{FOOTER}", f"Ferry {TEXT}"),
    (f"{MENU}<article><h1>Ferry</h1><p>Be.</p></article>{FOOTER}", "Ferry Be."),
    (f"<article>{MENU}<header><h1>Ferry</h1></header>{PARAGRAPHS}<footer>By me</footer></article>", f"Ferry {TEXT}"),
    (f'<div id="page"><div class="menu">A B C</div><div id="content">{PARAGRAPHS}</div></div>', TEXT),
    (f'<header><h1>Site</h1></header><main>{PARAGRAPHS}<p>End.</p></main><aside><p>{LOREM}</p></aside>', f"{TEXT} End."),
    (f'<article>{PARAGRAPHS}<section class="comments"><p>{LOREM * 9}</p></section></article>', TEXT),
    (f'<div class="cookie-notice"><p>{LOREM * 20}</p></div><article>{PARAGRAPHS}</article>', TEXT),
    (f'<div class="ad">{LOREM}</div><article>{PARAGRAPHS}</article><div role="complementary">{LOREM}</div>', TEXT),
    (f'<article>{PARAGRAPHS}<form><label>Name</label><input><textarea>x</textarea></form></article>', TEXT),
    (f'<article>{PARAGRAPHS}<script>var a = "</p>" + 1 < 2;</script><style>p{{}}</style><!-- no --></article>', TEXT),
    (f"<nav><ul><li>never closed<article>{PARAGRAPHS}</article>", f"{TEXT}"),
    (f'<form action="/"><h1>Ferry</h1>{PARAGRAPHS}</form>', f"Ferry {TEXT}"),
    ("<article><p><b>One<br>two<p>th<i>re</i>e</p> four&nbsp;&amp;&lt;b&gt;&#233;&amp</article>", "One two three four &<b>é&"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p hidden>x</p><p style='display: none'>y</p><p aria-hidden=true>z</p><p>w</p></article>", "w"),
    (f"<article></article>{MENU}{FOOTER}", ""),
    ("", ""),
])
def test_pages(body, expected):
    assert main_text(page(body)) == expected


def test_selected_by_density_alone():
    """No telling names: plain elements only."""
    links = "".join(f'<div><a href="/{i}">Another story of the day {i}</a></div>' for i in range(30))
    body = f"<div>{links}</div><div><div>{PARAGRAPHS}</div></div><div><a href='/'>home</a> <a href='/x'>imprint</a></div>"
    assert main_text(page(body)) == TEXT


def test_no_markup_and_no_body():
    assert main_text("just   text\n of a page") == "just text of a page"
    assert main_text(f"<article>{PARAGRAPHS}") == TEXT
    assert main_text("<p>a<p>b") == "a b"
    assert main_text("a < b <") == "a < b <"


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + LOREM + "</div>" * 20_000
    assert main_text(page(deep)) == LOREM
    long = "".join(f"<p>word{i} {LOREM}</p>" for i in range(20_000))
    assert main_text(page(f"<article>{long}</article>")).count("word") == 20_000
    assert len(main_text(page("<article>" + "x" * 3_000_000 + "</article>"))) == 3_000_000


def test_densities_against_plain_recursion():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randint(1, 40)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        chars, links = [rng.choice([0, 3, 50]) for _ in range(n)], [i > 0 and rng.random() < 0.3 for i in range(n)]

        def below(i):
            return [i] + [k for j in range(n) if parent[j] == i for k in below(j)]

        def linked(j):
            while j > 0:
                if links[j]:
                    return True
                j = parent[j]
            return False

        def sums(i):
            own = below(i)
            return (
                sum(chars[j] for j in own), len(own) - 1, sum(chars[j] for j in own if linked(j)),
                sum(links[j] for j in own if j != i),
            )

        whole = sums(0)
        expected = []
        for i in range(n):
            c, t, lc, lt = sums(i)
            if not c:
                expected.append(0.0)
                continue
            base = math.log(c / max(1, c - lc) * max(1, lc) + max(1, whole[2]) / max(1, whole[0]) * c + math.e)
            expected.append(c / max(1, t) * math.log(c / max(1, lc) * max(1, t) / max(1, lt)) / math.log(base))
        assert maintext.densities(parent, chars, links, 0) == pytest.approx(expected)


def test_given_pages_hold_their_article_element(spark, small):
    """A regular expression for these pages' own markup, over whole tables."""
    pages = spark.read.parquet(f"{small}/pages.parquet")
    expected = []
    for i, url, text in pages.select("page_id", "url", "html").collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", text)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner)))
        expected.append((i, url, " ".join(plain.split()), len(" ".join(plain.split()))))
    same_rows(maintext.extract_main_text(pages).collect(), expected)


def test_dirt(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "u", None), (2, None, ""), (None, None, None), (3, "u", f"<p>{LOREM}"), (3, "u", f"<p>{LOREM}"), (4, "u", " \n ")]
    expected = [(i, u, LOREM if h and "<" in h else "", len(LOREM) if h and "<" in h else 0) for i, u, h in rows]
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as text", "2 as n_chars", "3 as row")
    same_rows(maintext.extract_main_text(df).collect(), expected)
    assert maintext.extract_main_text(spark.createDataFrame([], schema)).collect() == []
