"""Operator 5: pages with known articles, and the cut against all labellings."""

import html
import itertools
import random
import re
import time

import pytest

from pyspark.sql import functions as F

from reelsync.llm import html_text as H


def article(page):
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    text = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside[1] if inside else ""))
    return " ".join(html.unescape(text).split())


def test_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = H.extract(pages).collect()
    assert len(got) == len(want)
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_boilerplate_goes_and_broken_markup_loses_nothing():
    page = """<head><title>No</title><style>p{}</style><body class="page"><div id="top-menu"><ul><li><a href=x>Home</a>
    <li><a href=y>More</a></ul></div><div class=content><h2>A head</h2><p>One &amp; <b>tw<i>o</b></i> three.<p>Four
    &nbsp;five</p></p><form><p>Search it</form><aside>Aside.</aside><div class="ad banner">Buy now, it is cheap.</div>
    <section id="comments"><p>A reader says this is a very nice article.</p></section></div><footer>&copy; x"""
    assert H.main_text(page) == "A head One & two three. Four five"
    assert H.main_text("plain text < 3 and nothing else.") == "plain text < 3 and nothing else."
    assert H.main_text("<script>var a = '</p>';</script><p>Shown text is here.") == "Shown text is here."
    assert H.main_text("<!-- <p>gone</p> --><p>A sentence that is long enough.</p><!-- open") == \
        "A sentence that is long enough."
    assert H.main_text("") == ""


LONG = "This paragraph is the text of the article, and it is long enough to be told from a menu or a footer."


def test_names_of_the_layout_do_not_silence_the_article():
    for page in ('<body class="single has-sidebar"><p>{}</p>', '<html class="js no-menu"><body id="search"><p>{}</p>',
                 '<div class="content with-sidebar"><p>{}</p></div>', '<article class="post tag-news"><p>{}</p></article>',
                 '<main class="main sidebar"><p>{}</p></main>', '<div class="has-sidebar"><p>{}</p></div>'):
        assert H.main_text(page.format(LONG)) == LONG, page
    for page in ('<div class="content"><div class="related-content"><p>{}</p></div></div>', '<nav class="content"><p>{}</p></nav>',
                 '<div class="comments"><div class="comment-text"><p>{}</p></div></div>', '<div class="sidebar"><p>{}</p></div>'):
        assert H.main_text(page.format(LONG)) == "", page


def test_a_form_around_the_page_and_unclosed_elements_hide_nothing():
    web_form = ('<body><form id="aspnetForm" action="x"><input type="hidden" name="state"><div id="top"><input type=text>'
                f'<button>Go</button></div><div class="page"><p>{LONG}</p><p>{LONG}</p></div></form></body>')
    assert H.main_text(web_form) == f"{LONG} {LONG}"
    for name in ("form", "button", "svg", "select", "textarea", "title"):
        assert H.main_text(f"<body><p>{LONG}</p><{name}><p>{LONG}</p><p>{LONG}</p></body>") == f"{LONG} {LONG} {LONG}", name
    contact = (f'<div class="content"><p>{LONG}</p><form><p>Your name: <input></p><p>Your message: <textarea>x</textarea></p>'
               '<select><option>one</select><button>Send it now.</button></form></div>')
    assert H.main_text(contact) == LONG


def test_the_cut_is_the_cheapest_labelling():
    draw = random.Random(4)
    for _ in range(200):
        n = draw.randint(1, 7)
        content = [draw.choice([0, draw.random() * 4]) for _ in range(n)]
        other = [draw.choice([0, draw.random() * 4]) for _ in range(n)]
        edges = [(a, b, draw.random() * 2) for a, b in itertools.combinations(range(n), 2) if draw.random() < 0.5]

        def cost(labels):
            return (sum(c if keep else o for keep, c, o in zip(labels, content, other))
                    + sum(w for a, b, w in edges if labels[a] != labels[b]))

        best = min(cost(labels) for labels in itertools.product([False, True], repeat=n))
        assert abs(cost(H.minimum_cut(content, other, edges)) - best) < 1e-6


def test_smoothness_decides_a_weak_block():
    """Short text between long paragraphs of one element stays."""
    inside = "<div><p>" + "A long paragraph of text. " * 5 + "<p>ok<p>" + "Another long paragraph. " * 5 + "</div>"
    assert " ok " in H.main_text(inside)
    assert H.main_text("<div><a href=x>ok</a></div>") == ""


def test_an_ordinary_word_is_weighed_with_the_text():
    for name in ("social-history", "legal-theory", "search-for-meaning", "response-to-critics"):
        assert H.main_text(f'<div id="{name}"><p>{LONG}</p><p>{LONG}</p></div>') == f"{LONG} {LONG}", name
    for name in ("social-links", "responses", "search-box", "legal", "related_items", "header-top", "promo-box-2"):
        assert H.main_text(f'<article><p>{LONG}</p></article><div class="{name}"><p>{LONG}</p></div>') == LONG, name


def test_rights_line():
    for line in ("© 2024 The Press Company Ltd.", "Copyright 2023 by the authors of this page.",
                 "(c) 1999 A person. All rights reserved."):
        assert H.main_text(f"<body><p>{LONG}</p><p>{LONG}</p><p>{line}</p></body>") == f"{LONG} {LONG}"
        assert H.main_text(f"<article><p>{LONG}</p><p>{line}</p></article>") == f"{LONG} {line}"
    law = "Copyright law is the subject of this long paragraph, which therefore begins with that very word."
    assert H.main_text(f"<body><p>{LONG}</p><p>{law}</p></body>") == f"{LONG} {law}"


def plain_tag_end(page, at):
    """Direct reading: quoted values are skipped, from each tag anew."""
    while at < len(page):
        if page[at] == ">":
            return at
        if page[at] in "\"'":
            at = page.find(page[at], at + 1)
            if at < 0:
                return None
        at += 1
    return None


def test_tag_ends_equal_a_direct_reading():
    draw = random.Random(6)
    for _ in range(3_000):
        page = "".join(draw.choice("<a>\"' =") for _ in range(draw.randint(0, 30)))
        tags = H.Tags(page)
        for at in range(len(page)):
            assert tags.end(at) == plain_tag_end(page, at), (page, at)


def test_shared_elements_and_edges():
    """Numbers of common elements, and the edges over them, from whole paths."""
    draw = random.Random(8)
    names = ["div", "p", "ul", "li", "section", "b", "body", "button"]
    for _ in range(400):
        page = "".join(draw.choice([f"<{n}>", f"</{n}>", "text "]) for n in draw.choices(names, k=draw.randint(1, 60)))
        found = H.blocks(page)
        paths = []
        for b in found:
            path, e = [], b.element
            while e is not None and e.name:
                path[:0] = [e] * (e.name not in H.OUTER)
                e = e.parent
            paths.append(path)
            assert b.element.depth == len(path)
        for (i, b), before in zip(list(enumerate(found))[1:], paths):
            common = sum(1 for _ in itertools.takewhile(lambda xy: xy[0] is xy[1], zip(before, paths[i])))
            assert b.shared == common, page
        edges = H.smoothness(found)
        assert len(edges) <= 2 * len(found) and all(a < b for a, b, _ in edges)


@pytest.mark.parametrize("piece", [
    "<div>Some text here. ", '<a title="x ', "<a <b 'x \"y ", "<a<b", "<b><i>x", "<b><div></b></i></x>t", "<b><li>t</li>",
    "<form><p>text", "<!-", "<p>A sentence of the text.</p><div class=ad>x"])
def test_a_megabyte_of_broken_markup_takes_linear_time(piece):
    times = []
    for n in (250_000, 1_000_000):
        start = time.process_time()
        H.main_text(piece * (n // len(piece)))
        times.append(time.process_time() - start)
    assert times[1] < 8 * times[0] + 1  # a square would take sixteen times as long
    assert times[1] < 10


def test_tables(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "u", "<p>Some text that is kept.</p>"), (1, "u", "<p>Some text that is kept.</p>"), (2, None, None),
            (None, None, ""), (3, "v", "<p>" + "long text here. " * 20_000 + "</p>"), (4, "w", "<div>" * 5_000 + "x.")]
    pages = spark.createDataFrame(rows, schema)
    for frame in (pages, pages.withColumns({"text": F.lit(1), "N_chars": F.lit("x")})):
        got = H.extract(frame)
        assert got.columns == ["page_id", "url", "text", "n_chars"]
        by = {r.page_id: r for r in got.collect()}
        assert got.count() == 6 and by[1].text == "Some text that is kept." and by[2].text == "" and by[None].n_chars == 0
        assert by[3].n_chars == len("long text here. ") * 20_000 - 1
    assert H.extract(spark.createDataFrame([], schema)).collect() == []
