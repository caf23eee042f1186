import html
import re
import time

import pytest

from quarry.llm import htmltext
from quarry.llm.queries import op10_main_text
from tests.llm.data import SF01, table


@pytest.fixture(scope="module")
def model():
    return htmltext.train(htmltext.labelled_pages(htmltext.TRAINING_PAGES))


def article(page):
    """The text of the article element by plain rules, for pages that have one."""
    m = re.search(r"<article[^>]*>(.*?)(</article>|<footer|\Z)", page or "", re.S)
    if not m:
        return ""
    body = re.sub(r"<!--.*?-->|<(script|style)[^>]*>.*?</\1>", "", m[1], flags=re.S)
    body = re.sub(r"</?(b|i|em|strong|a|span|u)(\s[^>]*)?>", "", body)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_query_extracts_the_articles(spark):
    pages = {p["page_id"]: p["html"] for p in table("pages")}
    rows = op10_main_text(spark, SF01).collect()
    assert len(rows) == len(pages)
    same = sum(r["text"] == article(pages[r["page_id"]]) for r in rows)
    assert same >= 0.99 * len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_held_out_pages(model):
    right = total = 0
    for blocks, labels in htmltext.labelled_pages(300, seed=991):
        got = model.decode(htmltext.block_features(blocks))
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total > 0.97


CASES = {
    "": "", "plain text": "plain text",
    "<html><body><header><h2>Site</h2></header><nav><a href=/>Home</a></nav><article><h1>Title &amp; more</h1><p>First  para\n with <b>bold</b>face.<p>Second &lt;one&gt;.</article>"
    "<aside><p>Side note here.</p></aside><section class=comments><p>Nice post!</p></section><form><label>Name</label></form><footer>&copy; me</footer></body></html>":
        "Title & more First para with boldface. Second <one>.",
    "<body><video src=x><article><h1>Seen</h1><p>An article, behind a film.</p></article>": "Seen An article, behind a film.",
    "<body><div><object data=x></div><article><p>One, two and three.</p><svg><svg></svg><text>inner</text></svg><p>Four, then five.</p></article>": "One, two and three. Four, then five.",
    "<article><p don't>First, it was.</p><p>It's the second one, here.</p></article>": "First, it was. It's the second one, here.",
    "<article><noscript><p>Turn it on, please.</p></noscript><p>Some words of text, here.</p><select><option>One</option></select></article>": "Some words of text, here.",
    "<article><p class=\"a>b\" title='<p>x</p>'>Words, with marks.</p><textarea><p>no</p></textarea></article>": "Words, with marks.",
    "<body><div class='cookie-notice'><p>We use cookies.</p><button>OK</button></div><main><h1>News</h1><p>It happened today, they said.</p><script>var a='<p>no</p>';</script>"
    "<style>p{}</style><div class=ad>Buy now!</div><p>More of it.</p></main><div id=comments><div class=comment><p>First!</p></div></div><div class=footer>Imprint</div>":
        "News It happened today, they said. More of it.",
}


def test_cases(model):
    for page, want in CASES.items():
        assert htmltext.main_text(page, model) == want


def test_awkward_pages(spark, model):
    pages = [(1, "u", None), (2, None, ""), (None, "u", "<p>Some words of text, here.</p>"), (3, "u", "<article><p>" + "word " * 50_000 + "</p>"), (3, "u", "<"),
             (4, "u", "<!-- never closed"), (5, "u", "<script>x"), (6, "u", "</p></div>&#0;&nope;&#x110000;"), (7, "u", "<a title=\"x>y</a><p>z"), (8, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([p + (5, "t") for p in pages], "page_id long, url string, html string, n_chars long, text string")
    rows = htmltext.extract_main_text(df, model).collect()
    assert [(r["page_id"], r["url"]) for r in rows] == [p[:2] for p in pages]
    by = {r["page_id"]: r["text"] for r in rows}
    assert by[1] == by[2] == by[4] == by[5] == "" and len([r for r in rows if r["n_chars"] == 249_999]) == 1
    assert htmltext.extract_main_text(df.limit(0), model).collect() == []


HOSTILE = {"tags without an end": "<a " * 330_000, "nested": "<div>" * 200_000, "nested, all names different": "".join(f"<div class=x{i}>t" for i in range(60_000)),
           "closed by another": "<b>" * 150_000 + "</i>" * 150_000, "closed outside": "<i><div>" + "<b>" * 150_000 + "</i>" * 150_000, "quotes": "<p title=\"" * 100_000 + "'>",
           "hidden": "<svg>" * 100_000 + "</svg>" * 100_000, "never closed": "<video>" * 140_000 + "x", "comments": "<!--" * 250_000, "references": "&" * 1_000_000,
           "cells": "<td>x" * 150_000, "tags all different": "".join(f"<t{i}>u" for i in range(90_000)), "brackets": "<" * 1_000_000}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_linear_time(model, name):
    began = time.process_time()
    htmltext.main_text(HOSTILE[name], model)
    assert time.process_time() - began < 15


def test_known_names_do_not_change_labels(model):
    for p in table("pages")[:100]:
        every, some = htmltext.leaf_blocks(p["html"]), htmltext.leaf_blocks(p["html"], model.known)
        assert [b.text for b in every] == [b.text for b in some]
        assert model.decode(htmltext.block_features(every)) == model.decode(htmltext.block_features(some))


def test_viterbi_is_the_best_path(model):
    from itertools import product
    for blocks, _ in htmltext.labelled_pages(15, seed=5):
        f = htmltext.block_features(blocks)[:9]
        u = [sum(model.weights.get(x, 0.0) for x in names) for names in f]

        def score(path):
            s = model.start[path[0]] + sum(x for x, y in zip(u, path) if y)
            return s + sum(model.pairs[a][b] for a, b in zip(path, path[1:]))
        assert abs(score(model.decode(f)) - max(score(p) for p in product((0, 1), repeat=len(f)))) < 1e-9
