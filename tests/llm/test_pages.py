import re

import numpy as np
import pytest

from tableferry.llm import pages
from tableferry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def article(html):
    found = re.search(r"<article\b.*?(?:</article>|\Z)", html, re.S)
    tree = pages.Tree(found[0] if found else "")
    return pages.text_of(tree, np.ones(len(tree.tag), bool))


@pytest.fixture(scope="module")
def model(spark):
    return pages.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_the_whole_table(spark):
    got = {r.page_id: r for r in QUERIES["op9_main_text"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    right = [got[r.page_id].text == article(r.html) for r in rows]
    assert np.mean(right) > 0.99
    assert all(got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url for r in rows)


def test_foreign_blocks_of_other_pages(spark, model):
    """Grafted pages with seeds that nothing was trained on."""
    right = total = 0
    for r in spark.read.parquet(f"{SF}/pages.parquet").limit(150).collect():
        html = pages.grafted(r.html, -7 - r.page_id)
        if html:
            tree = pages.Tree(html)
            total += 1
            right += pages.main_text(html, model) == pages.text_of(tree, pages.labels(tree) > 0)
    assert total > 100 and right / total > 0.85


def test_blocks_and_references(model):
    tree = pages.Tree("<body><p>a &amp; b&nbsp;&#233;\n\t <b>c</b>d<br>e<p>f<ul><li>g<li>h</ul>i<script>var x='<p>no</p>'</script><style>p{}</style><!-- no --><p>j &lt;k<span")
    assert pages.text_of(tree, np.ones(len(tree.tag), bool)) == "a & b é cd e\nf\ng\nh\ni\nj <k"
    tree = pages.Tree("<table><tr><td>a<td>b<tr><td>c</table><b>x<p>y</b>z</p>")
    assert pages.text_of(tree, np.ones(len(tree.tag), bool)) == "a\nb\nc\nx\nyz"


def test_choices_hold_together():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(2, 11))
        parent = [-1, *(int(rng.integers(0, i)) for i in range(1, n))]
        z = rng.normal(size=n) * 2
        kept = pages.choose(parent, z)
        best = max((sum(z[i] for i in range(1, n) if mask >> i & 1) for mask in range(1, 1 << n, 2) if all(not mask >> i & 1 or mask >> parent[i] & 1 for i in range(1, n))))
        assert kept[0] and all(not kept[i] or kept[parent[i]] for i in range(1, n))
        assert abs(sum(z[i] for i in range(1, n) if kept[i]) - best) < 1e-9


def test_trees_learn():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = pages.boost(x[:3000], y[:3000])
    assert ((pages.log_odds(model, x[3000:]) > 0) == (y[3000:] > 0.5)).mean() > 0.95


def test_odd_pages(spark, model):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text"), (3, "u", "plain text"), (None, "u", "<p>"), (5, "u", "</p></div>\x00<"), (6, "u", deep), (7, "u", "<article><p>" + "word " * 200_000 + "</article>"), (8, "u", "&#xD800; &#0; &bogus;")]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = pages.extract(frame, model).collect()
    assert len(got) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in got)
    assert [r.n_chars for r in got if r.page_id in (1, 2)] == [0, 0]
    assert next(r for r in got if r.page_id == 7).n_chars == 999_999
    assert pages.extract(frame.limit(0), model).collect() == [] and pages.train(frame.limit(0)) is None
    assert len(pages.extract(frame, None).collect()) == len(rows)


def whole(html):
    tree = pages.Tree(html)
    return pages.text_of(tree, np.ones(len(tree.tag), bool))


def test_what_is_shown_in_articles_is_text_and_players_swallow_no_page():
    assert whole("<p>see <math>x = 2</math> and <object>a figure</object> <button>more</button></p>") == "see x = 2 and a figure more"
    for tag in ("svg", "audio", "video", "canvas"):
        assert whole(f"<p>first <{tag}> lost<p>second<p>third") == "first\nsecond\nthird"
        assert whole(f"<div>first <{tag}><p>fallback</p></{tag}> on<p>second</div>") == "first\non\nsecond"


@pytest.mark.parametrize("html", ["<div>" * 200_000, "<b>" * 200_000, "<div>" * 100_000 + "<li>" * 100_000, "<p><table>" + "<div>" * 100_000 + "<b></i>" * 50_000, "<ul><li><div>" * 60_000, "<p>" + "<b>" * 100_000 + "</p><p>" * 100_000])
def test_many_open_elements_take_time_in_proportion(html):
    import time

    start = time.perf_counter()
    tree = pages.Tree(html + "end")
    pages.choose(tree.parent, np.ones(len(tree.tag)))
    pages.features(tree)
    assert time.perf_counter() - start < 10
    assert pages.text_of(tree, np.ones(len(tree.tag), bool)) == "end"


def text_by_force(html):
    """Blocks, white space and references by patterns alone, for pages of well-formed paragraphs."""
    import html as references

    shown = re.sub(r"<(script|style)>.*?</\1>", "", html, flags=re.S)
    parts = re.split(r"</?(?:p|div|h2|ul|li)\b[^>]*>", shown)
    plain = [" ".join(references.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
    return "\n".join(p for p in plain if p)


def test_text_assembly_equals_brute_force():
    import random

    rng = random.Random(9)
    for _ in range(300):
        inner = lambda: "".join(rng.choice(["word ", "a&amp;b", "&#233;", "<b>bold</b>", "<br>", " \n\t", "<i>x</i>y", "<script>var p = '<p>';</script>", "&nbsp;", "5 &lt; 6"]) for _ in range(rng.randint(0, 8)))
        html = "".join(rng.choice([f"<p>{inner()}</p>", f"<div>{inner()}<p>{inner()}</p>{inner()}</div>", f"<ul><li>{inner()}</li><li>{inner()}</li></ul>", f"<h2 class='x'>{inner()}</h2>", inner()]) for _ in range(rng.randint(0, 8)))
        assert whole(html) == text_by_force(html)
