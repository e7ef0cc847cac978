"""Main text of pages: parsing, the field against enumeration, held-out layouts, the table."""

import html
import itertools
import re

import numpy as np
import pytest
from conftest import SF_MID

from gradeflow.llm import extraction, layouts
from gradeflow.llm.htmlblocks import blocks
from gradeflow.llm.registry import op11_html_extraction


@pytest.fixture(scope="module")
def model():
    return extraction.fit()


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_broken_markup():
    assert texts("<p>a<p>b <b>c<br>d<p>e") == ["a", "b c d", "e"]
    assert texts("<ul><li>x<li>y</ul>z") == ["x", "y", "z"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert texts("a &amp; b&nbsp;&lt;c&gt; &copy &#233; &am") == ["a & b <c> © é &am"]
    assert texts("<script>var t='</p><p>no';</script><style>p{}</style><!-- no --><p>yes") == ["yes"]
    assert texts("<title>t</title><textarea>no</textarea><noscript>no</noscript><select><option>no</select>yes") == ["yes"]
    assert texts("<p class='a>b'>x</p><p title=\"y\">z</p>") == ["x", "z"]
    assert texts("<p>cut <a href='x") == ["cut <a href='x"] or texts("<p>cut <a href='x") == ["cut"]
    assert texts("</div></p>x</span>") == ["x"]
    assert texts("<b><p>one</b> two</p>") == ["one two"]
    assert texts("") == texts(None) == texts("  \n ") == texts("<p> &nbsp; </p>") == []


def test_deep_and_long_pages(model):
    deep = "<div>" * 20000 + "x" + "</div>" * 20000
    assert texts(deep) == ["x"]
    long = "<article>" + "<p>word word, word.</p>" * 30000 + "</article>"
    assert model.extract(long).count("\n") == 29999


def best_by_enumeration(model, page):
    found = extraction.features(page)
    score = [sum(model.weights.get(f, 0.0) for f in fs) for fs in found]

    def total(labels):
        return model.first[labels[0]] + sum(s for s, v in zip(score, labels) if v) + sum(model.step[a][b] for a, b in zip(labels, labels[1:]))

    return max(itertools.product((0, 1), repeat=len(page)), key=total)


def test_viterbi_against_enumeration(model):
    tried = 0
    for page in layouts.labelled_pages(60, seed=3):
        found = list(blocks(page))[:12]
        if found:
            assert tuple(map(int, model.labels(found))) == best_by_enumeration(model, found)
            tried += 1
    assert tried > 40


def test_learned_weights_are_a_maximum():
    """The slope of the likelihood, by enumeration of all labellings, is near the penalty's."""
    pages = ['<p data-main="1">a</p><div class="ad">b</div>', '<div class="ad">c</div><p data-main="1">d</p><p data-main="1">e</p>'] * 6
    model = extraction.fit(pages, steps=3000, rate=0.3, penalty=1.0)

    def likelihood(m):
        out = -0.5 * (sum(w * w for w in m.weights.values()) + (m.step**2).sum() + (m.first**2).sum())
        for page in pages:
            found = list(blocks(page))
            score = [sum(m.weights.get(f, 0.0) for f in fs) for fs in extraction.features(found)]

            def total(labels):
                return m.first[labels[0]] + sum(s for s, v in zip(score, labels) if v) + sum(m.step[a][b] for a, b in zip(labels, labels[1:]))

            every = [total(x) for x in itertools.product((0, 1), repeat=len(found))]
            out += total([int(bool(b.main)) for b in found]) - np.logaddexp.reduce(every)
        return out

    here = likelihood(model)
    for f in list(model.weights)[:6]:
        for d in (-0.05, 0.05):
            assert likelihood(extraction.BlockModel(model.weights | {f: model.weights[f] + d}, model.step, model.first)) < here
    for d in (-0.05, 0.05):
        assert likelihood(extraction.BlockModel(model.weights, model.step + np.array([[d, 0], [0, 0]]), model.first)) < here


def test_unseen_layouts(model):
    wrong = n = 0
    for page in layouts.labelled_pages(300, seed=1234):
        found = list(blocks(page))
        wrong += sum(a != bool(b.main) for a, b in zip(model.labels(found), found))
        n += len(found)
    assert wrong < 0.015 * n


def test_handmade_pages(model):
    page = """<body><div id="top" class="masthead"><a href="/">Daily Planet</a><p>All the news that fits, every day.</p></div>
    <div class="cookie-banner"><p>We use cookies, and we share data.</p><button>Accept</button></div><ul class="nav"><li><a>Home</a><li><a>World</a></ul>
    <div class="layout"><div class="post-body"><h1>Council votes &amp; decides</h1><p>The council met on Monday,   and voted.<p>It was a <em>long</em> night&nbsp;indeed.
    <div class="ad-box"><p>Great shoes for a great price.</p></div><ul><li>One item</li><li>Second item</li></ul></div>
    <div class="sidebar"><h3>More stories</h3><p>Another story that you may like to read, it is quite long too.</p></div></div>
    <div id="comments"><h2>2 comments</h2><div class="comment"><p>I think that this is wrong, as the council never met.</p></div></div>
    <form action="/subscribe"><p>Subscribe to our newsletter, it is free.</p><input></form><div class="footer"><p>Copyright 2020.</p></div></body>"""
    assert model.extract(page).split("\n") == ["Council votes & decides", "The council met on Monday, and voted.", "It was a long night indeed.", "One item", "Second item"]
    page = "<header><h2>Site</h2></header><main><h1>Title</h1><p>One.</p><section><h2>Sub</h2><p>Two.</p></section><aside><p>An aside, by us.</p></aside><p>Three.</p></main><section class='reader-comments'><p>Me too!</p></section><footer><p>Bye.</p></footer>"
    assert model.extract(page).split("\n") == ["Title", "One.", "Sub", "Two.", "Three."]


def article_by_pattern(page):
    """What the given pages hold in their article, cut out by patterns."""
    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    out = (" ".join(html.unescape(re.sub(r"<br>", " ", p).replace("<b>", "").replace("</b>", "")).split()) for p in parts)
    return "\n".join(p for p in out if p)


def test_whole_table(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = op11_html_extraction(spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article_by_pattern(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_rows(spark, model):
    rows = [(1, "u", None, "x", 1), (1, "u", None, "x", 1), (2, None, "", "x", 1), (None, "v", "<article><p>Some text here.</p></article>", "x", 1), (3, "w", "<nav><a>x</a></nav>", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in extraction.main_texts(pages, model).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (2, None, "", 0), (None, "v", "Some text here.", 15), (3, "w", "", 0)], key=str)
    assert extraction.main_texts(pages.limit(0), model).count() == 0


def test_nothing_to_learn_from():
    assert extraction.fit([]).extract("<p>x</p>") == ""
