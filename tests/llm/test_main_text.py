import html
import re

import numpy as np
import pytest

from forumlens.llm.main_text import between_surge_and_dive, extract_main_text, main_text
from forumlens.llm.queries import QUERIES

LONG = "Rain fell on the hills all night and the river rose slowly towards the old stone bridge. "


def test_query_returns_whole_articles(spark):
    """The test pages hold one article each: all its text, nothing around it."""
    sf = "/root/testdata/sf0.1"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op11_main_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"(?s)<article>(.*)</article>", pages[r.page_id])[1]
        want = " ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", " ", inside)).split())
        assert r.text == want and r.n_chars == len(want)


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), (" \n ", ""), ("<p></p>", ""), ("plain text", "plain text"),
    ("<script>var a='</p>';</script><p>x</p>", "x"),
    ("<SCRIPT>if (a</b>) x</ScRiPt ><P>y", "y"),
    ("<style>p{}</style><title>t</title><p>a&amp;b &lt;i&gt;&nbsp; &eacute;&#x41;&#66; &am</p>", "a&b <i> éAB &am"),
    ("<p>one<br>two</p><p>th<b>re</b>e</p>", "one two three"),
    ("a < b and <3", "a < b and <3"),
    ("<!-- <p>no</p> --><p>yes</p><!-- cut", "yes"),
    ("<!--><p>yes</p>", "yes"), ("<?php x ?><!DOCTYPE html><p>y</p></>z", "y z"),
    ("<p title='a>b' alt=\"</p>\">t</p>", "t"), ("<p title=\"never closed>t</p>", "t"),
    ("<p>kept</p><p clas", "kept"),
    ("<noscript>turn it on</noscript><textarea>typed</textarea><p>p</p>", "p"),
    ("<p>a<span hidden>b</span>c</p><div style='display: none'>d</div><p aria-hidden=true>e</p>", "a c"),
])
def test_markup(page, want):
    assert main_text(page) == want


def test_article_without_what_stands_around_it():
    page = f"""<body class="has-sidebar"><header><h1>Site</h1><p>{LONG}</p></header>
      <nav><a href=/>Home</a></nav><div id="cookie-notice"><p>{LONG}</p></div>
      <main><div class="breadcrumbs">You are here</div>
      <article class="post no-comments"><header class="entry-header"><h1 class="header">Flood &amp; bridge</h1><p>By A. B.</p></header>
      <p>First <a href="/x">linked words</a> stay.<p>{LONG}
      <div class="ad-slot">Buy now {LONG}</div>
      <ul><li>one<li>two</ul><table><tr><td>cell<td>next</table>
      <aside>See also {LONG}</aside><form><label>Mail</label><input><button>Go</button></form>
      <p>Last words.</p><footer>Filed under rivers</footer></article>
      <section class="comments"><article class="comment"><p>{LONG}{LONG}</p></article></section></main>
      <div class="sidebar"><p>{LONG}</p></div><footer>&copy; Site</footer>"""
    assert main_text(page) == ("Flood & bridge First linked words stay. " + LONG.strip()
                               + " one two cell next Last words.")


def test_page_without_article_by_surge_and_dive():
    menu = "".join(f"<li><a href=/{i}>section {i}</a></li>" for i in range(8))
    page = (f"<div>Top line</div><ul>{menu}</ul><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}{LONG}</p>"
            f"<ul>{menu}</ul><div>Imprint and terms</div>")
    assert main_text(page) == f"Title {LONG.strip()} Short. {(LONG + LONG).strip()}"
    assert main_text(f"<main><h1>T</h1><p>x</p></main><p>{LONG}</p>") == "T x"


def test_distribution_finds_the_articles_without_their_element(spark):
    """Surge and dive alone give the same texts when no page marks its article."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    for r in pages:
        bare = re.sub(r"<(/?)article>", r"<\1div>", r.html)
        assert bare != r.html and main_text(bare) == main_text(r.html)


def test_articles_are_chosen_by_surge():
    cards = "".join(f"<article class=card><h2>Other news {i}</h2></article>" for i in range(4))
    advert = "<div class=ad><p>Buy</p><p>now</p><p>or</p><p>never</p></div>"
    story = f"<article><h1>Title</h1>{advert}<p>{LONG}{LONG}</p>{advert}<p>End.</p></article>"
    assert main_text(f"{cards}{story}{cards}") == f"Title {(LONG + LONG).strip()} End."
    assert main_text(f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article>") == f"{LONG}{LONG}".strip()
    assert main_text("<article><p>short</p></article>") == "short"


def test_main_without_article():
    menu = "".join(f"<li><a href=/{i}>section {i}</a></li>" for i in range(8))
    page = f"<main><ul>{menu}</ul><h1><a href=/t>Title</a></h1><p>{LONG}</p><ul>{menu}</ul><p>Terms</p></main>"
    assert main_text(page) == f"Title {LONG.strip()}"


def test_surges_and_dives():
    kept = between_surge_and_dive(np.array([2, 0, 0, 0, 50, 0, 0, 3, 0, 0, 0, 4]), 20)
    assert kept[4] and kept[7] and not kept[0] and not kept[11]
    assert not between_surge_and_dive(np.zeros(5, int), 1).any()
    assert len(between_surge_and_dive(np.zeros(0, int), 1)) == 0


def test_very_long_and_broken_pages():
    for piece in ('<a "', '<a b="', "<div>", "<p><span>x", "<li><ul>", "</p>", "<!--", "<b", "&amp"):
        main_text(piece * 100_000)
    assert main_text(f"<article>{'<p>word ' * 100_000}</article>") == " ".join(["word"] * 100_000)


def test_tables(spark):
    rows = [(1, "<p>a</p>", "x"), (1, "<p>a</p>", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, main_text string")
    got = extract_main_text(df)
    assert got.columns == ["page_id", "html", "main_text", "main_text_"]
    assert sorted(tuple(r) for r in got.where("page_id = 1").collect()) == [(1, "<p>a</p>", "x", "a")] * 2
    assert got.where("page_id is null").first()["main_text_"] == ""
    assert extract_main_text(df.limit(0)).count() == 0
    odd = df.withColumnRenamed("page_id", "a`b c")
    assert extract_main_text(odd).count() == 3
