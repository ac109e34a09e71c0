"""Cuts against brute force; pages of known content."""

import itertools
import random
import time

import pytest

from staylens.llm import html_extract as H

LONG = "One two three four five six seven eight nine ten, eleven twelve thirteen fourteen."


def cut_cost(scores, links, labels):
    return sum(max(0, s) if not k else max(0, -s) for s, k in zip(scores, labels)) + sum(
        w for a, b, w in links if labels[a] != labels[b])


def test_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 9)
        scores = [rng.choice([-3, -1.5, -.5, 0, .5, 1, 2.5]) + rng.random() for _ in range(n)]
        links = [(i - 1, i, rng.random() * 3) for i in range(1, n)]
        links += [(*sorted(rng.sample(range(n), 2)), rng.random() * 2) for _ in range(rng.randrange(4)) if n > 1]
        best = min(cut_cost(scores, links, x) for x in itertools.product([False, True], repeat=n))
        assert abs(cut_cost(scores, links, H.min_cut(scores, links)) - best) < 1e-6


def test_long_chain_is_quick():
    scores = [1.0 if i % 3 else -1.5 for i in range(20000)]
    assert len(H.min_cut(scores, [(i - 1, i, .7) for i in range(1, 20000)])) == 20000


PAGES = {
    f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>Home</a>"
    f"</ul></nav><!-- ad --><div class=\"ad\">Buy {LONG}</div><article><h1>Title here</h1><p><b>{LONG}<br><p>Short.</p><p>{LONG}</p>"
    f"</article><footer>&copy; site &middot; words</footer>": f"Title here\n{LONG}\nShort.\n{LONG}",
    f"<div id=content><p>{LONG}</p><p>Yes.</p><p>A&amp;B &lt;tag&gt; &eacute;&#233;&nbsp;x &unknown; &amp</p><form>Name <input></form></div>"
    f"<div class='user-comments'><p>{LONG}</p></div>": f"{LONG}\nYes.\nA&B <tag> éé x &unknown; &",
    f"<body><header><h1>Site name</h1></header><p>{LONG}</p>\n\n<p>{LONG} More  \n text.</p><aside>{LONG}</aside>": f"{LONG}\n{LONG} More text.",
    f"<article><header><h2>Head</h2></header><p>{LONG}</p><aside><p>{LONG}</p></aside><div class='cookie-notice'>{LONG}</div>"
    f"<ul><li>first item<li>second item</ul></article><div class=sidebar><a href=x>{LONG}</a></div>": f"Head\n{LONG}\nfirst item\nsecond item",
    f"<div class='page has-sidebar'><div class='entry'><header class='entry-header'><h1>Head</h1></header><p>{LONG}</p><ul><li><a href=x>one</a>"
    f"<li><a href=y>two</a></ul></div><ol class='commentList'><li><p>{LONG}</ol><div role=navigation>{LONG}</div></div>":
        f"Head\n{LONG}\none\ntwo",
    "<nav>only menu</nav>": "", "": "", "plain": "", f"{LONG} <b>bold</b>text <i": f"{LONG} boldtext",
    f"<p>{LONG}</p><!-- never closed <p>x": LONG, f"<p>{LONG}</p><script>x": LONG,
    f"<main><p>a < b and {LONG}</p></main>": f"a < b and {LONG}",
}


#: Articles without an element or word of their own, misleading words, unfinished markup.
HARD = {
    f"<article><p>{LONG}</p></article><section id=comments><article class=comment><p>{LONG}</p></article></section>": LONG,
    f"<article><p>{LONG}</p><div class='post-comments'><div class=content><p>{LONG}</p></div></div></article>": LONG,
    f"<article class='post tag-comments'><p>{LONG}</p></article>": LONG,
    f"<div class='social-history-post'><article><p>{LONG}</p><p>{LONG}</p></article></div>": f"{LONG}\n{LONG}",
    f"<main><h1>Head</h1><div class=search><p>{LONG}</p><p>{LONG}</p></div></main>": f"Head\n{LONG}\n{LONG}",
    f"<form action=x><nav>menu</nav><div><p>{LONG}</p><p>{LONG}</p></div></form>": f"{LONG}\n{LONG}",
    f"<article><p>{LONG}</p></article><form><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></form>": LONG,
    f"<p>{LONG}</p><div class=related><article class=teaser>{LONG}</article></div>": LONG,
    f"<body><p>{LONG}</p><p>Yes it is.</p><footer>Words of a footer</footer>": f"{LONG}\nYes it is.",
    f"<head><title>t</title><body><p>{LONG}</p><p title=\"open>Last words here.</p>": f"{LONG}\nLast words here.",
    f"<p>{LONG}</p><p>He said <b class=x don't>no</b> twice.</p>": f"{LONG}\nHe said no twice.",
    f"<p>{LONG}</p><p data-id='share' title='a > b'>Last words here.</p>": f"{LONG}\nLast words here.",
    f"<p>{LONG}</p><a href=x words and words without an end": LONG,
}


@pytest.mark.parametrize("page", HARD)
def test_hard_pages(page):
    assert H.main_text(page) == HARD[page]


@pytest.mark.parametrize("page", [
    "<div>" * 100000 + LONG, "<p><i>" + "<b>" * 100000 + LONG + "</i>" * 100000, LONG + "<a" * 500000, LONG + "<a b='" * 200000,
    LONG + "<a b=\"x' " * 100000, "<ul><li>" * 50000 + LONG + "</ul>" * 50000, LONG + "<!--" * 250000, LONG + "<" * 1000000,
    LONG + "<a " + "= " * 300000, "</b>" * 200000 + LONG])
def test_work_grows_with_the_page(page):
    begin = time.process_time()
    assert H.main_text(page).startswith(LONG)
    assert time.process_time() - begin < 10


@pytest.mark.parametrize("instead, least", [("div", 0.97), ("", 0.97)])
def test_articles_without_their_element(instead, least):
    """The given pages of a size that chose no weight, their article element renamed or gone."""
    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet").column("html").to_pylist()
    right = 0
    for page in pages:
        bare = page.replace("<article>", f"<{instead}>" * bool(instead)).replace("</article>", f"</{instead}>" * bool(instead))
        right += H.main_text(bare) == H.main_text(page)
    print(instead, right, len(pages))
    assert right >= least * len(pages)


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert H.main_text(page) == PAGES[page]


def test_given_pages_keep_the_article_alone(spark):
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in H.extract(pages).collect():
        inside = re.search("<article>(.*?)</article>", raw[r["page_id"]], re.S)[1]
        inside = re.sub(r"</?(?:p|h1)>", "\n", inside)
        import html
        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in inside.split("\n\n")]
        want = " ".join(w for w in want if w)
        assert " ".join(r["text"].split()) == " ".join(want.split())


def test_rows(spark):
    rows = [(1, "u", None), (None, None, "<article>x</article>"), (1, "u", "<article>x</article>"), (2, "v", "<p>" * 20000 + LONG)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["text"]) for r in H.extract(df).collect())
    assert got == [("1", ""), ("1", "x"), ("2", LONG), ("None", "x")]
    assert H.extract(df.where("false")).count() == 0
