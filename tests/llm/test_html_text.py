"""HTML extraction: the cut against all labellings, and pages of several shapes."""

import itertools
import random
import re

import pytest
from compare import SF_DIR

from vecloom.llm import html_text as h
from vecloom.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(40))
def test_cut_is_the_cheapest_labelling(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    scores = [rng.uniform(-3, 3) for _ in range(n)]
    edges = [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 3)) for _ in range(2 * n)]

    def cost(side):
        ends = sum(-s if keep and s < 0 else s if not keep and s > 0 else 0 for s, keep in zip(scores, side, strict=True))
        return ends + sum(w for i, j, w in edges if side[i] != side[j])

    best = min(cost(side) for side in itertools.product([True, False], repeat=n))
    assert cost(h.minimum_cut(scores, edges)) == pytest.approx(best)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><p>no</p>";</script></head>
<body class="has-sidebar"><header><a href=/>Site</a> Tagline of the site, which is long enough.</header>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
<div id="cookie-notice">We use cookies. Read our long policy about them before you go on reading this page.</div>
<article><header><h1>Title &amp; more</h1></header><p>First   para&shy;graph with <b>bold<br>text</b>.<p>Short.
<aside>Related: something else to read, with a full sentence.</aside><div class="ad">Buy this now.</div>
<p>Last &lt;p&gt; of the&nbsp;article.</p><form>Your name <input> please.</form>
<section class="comments"><p>A reader's comment, which is also a long sentence.</p></section></article>
<footer><p>&copy; Someone. All rights reserved, everywhere and for ever.</p></footer>"""


def test_article_without_its_surroundings():
    assert h.main_text(PAGE) == "Title & more\nFirst para­graph with bold text.\nShort.\nLast <p> of the article."


def test_page_without_article_element():
    body = "".join(f"<p>This is sentence number {i} of the text, which goes on for a while.</p>" for i in range(6))
    page = f"<div class=menu><a href=1>Home page</a> <a href=2>About us</a></div><div class=content>{body}</div><div id=footer>Imprint</div>"
    assert h.main_text(page).count("\n") == 5 and "Imprint" not in h.main_text(page) and "Home" not in h.main_text(page)


SENTENCES = [f"This is sentence number {i} of the text, which goes on for a while." for i in range(6)]
BODY = "".join(f"<p>{s}</p>" for s in SENTENCES)


@pytest.mark.parametrize("page", [
    f"<!DOCTYPE html><html><head><title>T</title><meta charset=utf-8><body><article>{BODY}</article></body></html>",
    f"<head><title>T</title><script>var a</script><noscript><img src=x></noscript><article>{BODY}</article>",
    f"<head><title>T</title><template><p>No, not this sentence here.</p></template>{BODY}",
    f"<head><title>T</title><noscript><p>No, not this.</p><body>{BODY}</body>",
    f"<div class='layout has-sidebar'><article>{BODY}</article></div>",
    f"<div class='page-with-sidebar no-ads'><div>{BODY}</div></div>",
    f"<div id=search><div class='author legal'><article>{BODY}</article></div></div>",
    f"<div class=notice><main>{BODY}</main></div>",
    f"<main><div class='share bio'><article>{BODY}</article></div></main>",
    f"<div class=sidebar><div role=main>{BODY}</div></div>",
    f"<div class='header-layout'><article>{BODY}</article></div>",
    f"<form id=whole><article>{BODY}</article></form>",
])
def test_articles_in_open_heads_and_named_wrappers_stay(page):
    assert h.main_text(page).split("\n") == SENTENCES


@pytest.mark.parametrize("around", [
    "<aside><article>{}</article></aside>",
    "<div class=comments-area><article>{}</article></div>",
    "<div class='sidebar'><article>{}</article></div>",
    "<article>" + BODY + "<div class=author-bio><article>{}</article></div></article>",
    "<div class=share>{}</div>",
    "<article>" + BODY + "<form>{}</form></article>",
])
def test_secondary_articles_still_go(around):
    assert "Another" not in h.main_text(f"<article>{BODY}</article>" + around.format("<p>Another text, which is also a long sentence.</p>"))


def test_head_content_stays_unseen():
    assert h.main_text(f"<head> <title>T</title>\n<style>p</style> <noscript><p>{SENTENCES[0]}</p></noscript></head><body>{BODY}").split("\n") == SENTENCES


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<<<a<b", "</p></div>", "<script>", "<!-- open", "&#0; &bogus;", "<a " * 30_000, "<div>" * 3000, "<p>x" * 3000])
def test_broken_pages_give_a_text(page):
    assert isinstance(h.main_text(page), str)


def test_query_keeps_articles_whole(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = QUERIES["op8_min_cut_html_text"](spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        assert r.n_chars == len(r.text)
        assert r.text.split("\n") == [b.text for b in h.read_blocks(inside)]


def test_nulls_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, None, 5), (2, "<p>Hello there, this is a sentence about nothing.</p>", 6)], "page_id long, html string, text int")
    assert [r.n_chars for r in h.extract_text(pages).orderBy("page_id").collect()][0] == 0
    assert h.extract_text(pages.where("false")).count() == 0
