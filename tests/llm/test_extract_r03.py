"""Operator 5: what the ratios decide, names, several articles, and a plain selector over whole tables."""

import html
import re

import numpy as np
import pytest

from reviewlens.llm import extract

LONG = "A paragraph of running text that goes on for a good while, so that its ratio is high, and on. " * 2
P = LONG.strip()
FOUR_LINKS = "<p><a href=1>One</a> <a href=2>Two</a> <a href=3>Three</a> <a href=4>Four</a>"
LOOSE = f"<body><div><a href=/>Home</a></div><div><a href=/a>About</a></div><div>{P}</div><div><h2>H</h2><p>{P}<p>End.</div><div>(c) me</div></body>"


@pytest.mark.parametrize(("page", "text"), [
    (f'<body><div class="has-sidebar"><article><p>{P}</article></div></body>', P),
    (f'<article class="post no-comments"><p>{P}</article>', P),
    (f'<body class="with-comments"><p>{P}</body>', P),
    # a name does not take away what wraps the body of the page
    (f'<body><div class="sidebar"><article><h1>T</h1><p>{P}<p>x</article></div></body>', f"T\n{P}\nx"),
    (f'<body><div class="widget"><h1>T</h1><p>{P}<p>{P}<p>x</div><div class="ad">Buy.</div></body>', f"T\n{P}\n{P}\nx"),
    # but does take away an advert that is longer than the article, and comments however long
    (f'<article><p>Word</article><div class="ad">{P}</div>', "Word"),
    (f'<article></article><div class="ad">{P}</div>', ""),
    (f'<article><h1>T</h1><p>{P}</article><div class="comments"><article class="comment-body"><p>{P}{P}{P}</article></div>', f"T\n{P}"),
    (f'<article><h1>T</h1><p>{P}</article><article class="comment"><p>{P}{P}{P}</article>', f"T\n{P}"),
    # two articles; a teaser beside a body in divs
    (f"<article><h1>A</h1><p>{P} {P} {P}</article><article><h1>B</h1><p>{P}</article>", f"A\n{P} {P} {P}\nB\n{P}"),
    (f"<main><h1>T</h1><div><p>{P}<p>Short.<p>{P}</div><article><a href=x>Teaser</a> words</article></main>", f"T\n{P}\nShort.\n{P}"),
    # lead in its own div, short closing line, heading; menu and footer lines without names go by their ratio
    (LOOSE, f"{P}\nH\n{P}\nEnd."),
    (f"<article><p>{P}{FOUR_LINKS}<p>{P}</article>", f"{P}\n{P}"),
    (f'<article><p>{P}<p>See <a href="x">this</a>.</article>', f"{P}\nSee this."),
])
def test_regions(page, text):
    assert extract.main_text(page) == text


def test_ratios_decide(monkeypatch):
    assert "Home" not in extract.main_text(LOOSE)
    monkeypatch.setattr(extract, "smoothed", lambda ratio, sigma=1.0: np.ones(len(ratio)))
    assert "Home" in extract.main_text(LOOSE)


def plain_selector(page: str) -> str:
    """Lines between block tags of the article, by regular expressions."""
    found = re.search(r"(?is)<article\b[^>]*>(.*?)(</article>|\Z)", re.sub(r"(?is)<!--.*?-->|<(script|style|title)\b.*?</\1>", "", page or ""))
    lines = re.split(r"(?i)</?(?:p|h1|div|ul|li|article)\b[^>]*>", found[1] if found else "")
    lines = [" ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", "", re.sub(r"(?i)<br[^>]*>", " ", x))).split()) for x in lines]
    return "\n".join(x for x in lines if x)


def test_table_against_plain_selector(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = {r.page_id: (r.text, r.n_chars) for r in extract.extract_pages(pages).collect()}
    rows = pages.select("page_id", "html").collect()
    assert len(out) == len(rows) > 0
    for r in rows:
        want = plain_selector(r.html)
        assert out[r.page_id] == (want, len(want))


def test_odd_rows(spark):
    long = f"<article><p>{'word ' * 400_000}</article>"
    rows = [(1, "u", None), (1, "u", None), (2, None, ""), (None, "v", f"<article><p>{P}</article>"), (4, "w", long), (4, "w", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "7 AS n_chars", "'y' AS _html_")
    out = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract.extract_pages(pages).collect()), key=str)
    body = ("word " * 400_000).strip()
    assert out == sorted([(1, "u", "", 0)] * 2 + [(2, None, "", 0), (None, "v", P, len(P))] + [(4, "w", body, len(body))] * 2, key=str)
