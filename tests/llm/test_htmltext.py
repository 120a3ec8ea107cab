"""HTML extraction: parsing, labelling against exhaustive search, whole pages."""

import itertools
import random
import re
from html import unescape

from odgraph.llm import htmltext


def test_minimum_cut_equals_exhaustive_search():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 9)
        score = [rng.choice([-1, 1]) * rng.random() * rng.choice([0.2, 1, 4]) for _ in range(n)]
        edges = [(i, j, rng.random()) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(label):
            return (sum(abs(s) for s, x in zip(score, label) if x != (s > 0))
                    + sum(w for i, j, w in edges if label[i] != label[j]))

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(htmltext.minimum_cut(score, edges)) - best) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>Head</title><style>p > b {}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href=/>Home</a></header><div id="cookie-notice">We use cookies here. <button>OK</button></div>
<div class=wrapper><div class="sidebar"><h3>Related</h3><ul><li><a href=1>A link here</a></ul></div>
<main><article class="post no-sidebar"><header>By someone, today</header><h1>Real title</h1><p>First <i>in</i>line &amp; &lt;tags&gt;&#33;
and   spaces.<p>Short.<script>var t="</p>";</script><!-- <p>no</p> --><div class="advert">Buy this product now, it is good.</div>
<blockquote>Said by someone.</blockquote><ul><li>one<li>two</ul><form><label>Mail</label><input></form>
</article><section class="comments"><h2>Comments</h2><div>I, a reader, find this quite interesting and worth
reading twice.</div></section></main></div><footer>&copy; 2020</footer>"""
TEXT = "Real title First inline & <tags>! and spaces. Short. Said by someone. one two"


def test_article_of_a_page():
    assert htmltext.main_text(PAGE) == TEXT


def test_odd_pages():
    main = htmltext.main_text
    assert main(None) == main("") == main("<div></div>") == ""
    assert main("<p>unclosed <b>bold text of a page <a href='x>y'>here") == "unclosed bold text of a page here"
    assert main("<nav><a>x</a></nav>") == ""
    assert main("<article><p>a < b and <!-- cut") == "a < b and"
    assert main("<article>" + "<div>" * 3000 + "<p>deep words</p>") == "deep words"
    assert main("<article><p>The story itself, told at length.</p><article class='comment'><p>A reader's long comment on "
                "this story, which has many words.</p></article></article>") == "The story itself, told at length."
    long = "<article>" + "<p>one line of text.</p>" * 5000 + "</article>"
    assert main(long) == " ".join(["one line of text."] * 5000)


def _decided(page):
    """Blocks' texts with the classifier's label and the cut's."""
    blocks = htmltext.parse(page)
    score = htmltext.scores(blocks)
    return [(b.text, x > 0, y) for b, x, y in zip(blocks, score, htmltext.minimum_cut(score, htmltext.ties(blocks)))]


def test_neighbours_decide_what_the_text_leaves_open():
    told = "<p>A paragraph of the story that is told in several words, as stories are.</p>"
    page = "<body><div>" + told + "<div>Short line</div>" + told + "</div></body>"
    assert _decided(page)[1] == ("Short line", False, True)
    link = "<div><a href=x>Some place to go</a></div>"
    page = "<body><div>" + link * 3 + "<div>Fifteen words with no mark at their end that stand between links of a long menu</div>" + link * 3 + "</div></body>"
    assert [x[1:] for x in _decided(page)] == [(False, False)] * 3 + [(True, False)] + [(False, False)] * 3


def test_cut_on_pages_without_marked_articles():
    """The driver's pages with plain elements in place of those that name their
    purpose: labels as in the marked page, many of them only by the cut."""
    import pyarrow.parquet as pq

    wrong = by_score = blocks = 0
    for html in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        marked = htmltext.parse(html)
        truth = htmltext.minimum_cut(htmltext.scores(marked), htmltext.ties(marked))
        plain = re.sub(r"<(/?)(?:article|nav|footer|header|ul|li)\b[^>]*>", r"<\1div>", html).replace(' class="ad"', "")
        got = _decided(plain)
        assert [x[0] for x in got] == [b.text for b in marked]
        blocks += len(got)
        by_score += sum(x[1] != y for x, y in zip(got, truth))
        wrong += sum(x[2] != y for x, y in zip(got, truth))
    assert by_score >= 100 and wrong <= blocks // 1000


def test_words_that_articles_share_with_boilerplate():
    main = htmltext.main_text
    assert main("<article><p>Euler showed that <math>e</math> is irrational.</p></article>") == "Euler showed that e is irrational."
    assert main("<article><p>Press <button>Start</button> to begin the run.</p></article>") == "Press Start to begin the run."
    assert main('<article><p>The river rose.</p><div class="story-alert"><p>Roads north of the town stay closed until the '
                'water falls, the council said.</p></div></article>').endswith("the council said.")
    assert main('<article><p>The river rose.</p><div class="advert"><p>Boots that keep dry in any water, now at half '
                'their price in every shop.</p></div></article>') == "The river rose."


def test_pages_table_keeps_whole_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in htmltext.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>)", r.html, re.S)[1]
        text = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", article))
        want = " ".join(unescape(text).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 0), (1, "u", PAGE, 0), (None, None, None, None)],
                               "page_id long, url string, html string, n_chars int")
    rows = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in htmltext.extract(df).collect()), key=str)
    assert rows == [(0, None, "", 0), (1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT))]
    assert htmltext.extract(df.where("false")).count() == 0
    bad = df.selectExpr("page_id", "url", "cast(concat(cast('<article><p>a ' as binary), X'FF', cast(' b.' as binary)) as string) html")
    assert {r.text for r in htmltext.extract(bad).collect()} == {"a \ufffd b."}
