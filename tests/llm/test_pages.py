"""Main text of pages: held-out accuracy, whole articles, broken and hostile markup."""

import time
import tracemalloc

import numpy as np
import pytest

from postmill.llm.block_labeller import _path_rows, extract, label, labelled, main_text, path_vectors, trained
from postmill.llm.html_blocks import blocks
from postmill.llm.queries import QUERIES
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def net():
    return trained()


def test_held_out_accuracy(net):
    random = np.random.default_rng(99)
    pages = [labelled(random) for _ in range(400)]
    kept = np.concatenate(label([p for p, _ in pages], net))
    wanted = np.concatenate([marks for _, marks in pages])
    assert (kept == wanted).mean() > 0.98


def test_training_is_reproducible(net):
    again = trained.__wrapped__(60)
    assert all((again[k] == v).all() for k, v in trained.__wrapped__(60).items())


def test_pages_give_their_articles(spark, net):
    """The given pages keep their article in one element; nothing else of them is main text."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    got = QUERIES["op1_main_text"](spark, SF).toPandas().set_index("page_id")
    assert len(got) == len(pages)
    wrong = 0
    for page_id, html in zip(pages.page_id, pages.html, strict=True):
        text = " ".join(b.text for b in blocks(html) if "article" in b.path)
        wrong += got.text[page_id] != text
        assert got.n_chars[page_id] == len(got.text[page_id])
    assert wrong <= 0.01 * len(pages)


def test_parts_around_an_article_go(net):
    page = (
        '<body><header><h1>Site name</h1></header><nav><a href=/>Home</a> <a href=/n>News</a></nav>'
        '<div class="cookie-notice">We use cookies to improve.</div><article><h1>Title</h1><p>One &amp; <b>two</b>s\n three.</p>'
        '<form><p>Subscribe now</p></form><p>Four &lt;b&gt; five&nbsp;six.</p></article>'
        '<section class="comments"><p>Nice text indeed, it is a great one.</p></section><footer>&copy; x</footer></body>'
    )
    assert main_text([page], net)[0][0] == "Title One & twos three. Four <b> five six."


def test_markup_rules():
    def texts(page):
        return [b.text for b in blocks(page)]

    assert texts("<p>a<p>b<br>c</p>d<!-- x --><script>if (a<b) '</p>'</script><style>p{}</style>") == ["a", "b c", "d"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul>") == ["a", "b", "c", "d"]
    assert texts("a < b & c &am &amp") == ["a < b & c &am &"]
    assert texts('<div title="a>b" class=x>t</div>') == ["t"]
    assert texts("<p>cut <b>off") == ["cut off"]
    assert texts("<p>x <a href='/never") == ["x"]
    assert blocks('<div class="Side-Bar w2" id=y><p>t</p></div>')[0].path == ("div", "side", "bar", "w", "2", "y", "p")


def test_hostile_markup_is_linear():
    start = time.time()
    for part in ('<a "', "<a", "<", '<p class="', "<!--", "<div>", "<script>", "&amp", "</p>", "<p><b>"):
        blocks(part * 30_000)
    assert time.time() - start < 10


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>T</title><p>Hello there</p>", ["Hello there"]),
        ("<head><meta charset=utf-8><link href=x><h1>A</h1>b", ["A", "b"]),
        ("<head><title>T</title></head><p>a", ["a"]),
        ("<head><noscript><p>n</p></noscript><title>T</title><body><p>a", ["a"]),
        ("<p>a</p><svg><path d=x><p>b</p><div>c</div>", ["a", "b", "c"]),
        ("<p>a</p><math><mi>x<h2>b</h2>", ["a"]),
        ("<p>a</p><math><mi>x</mi><h2>b</h2>", ["a", "b"]),
        ("<p>a <svg><text>no</text></svg> b</p>", ["a", "b"]),
        ("<svg><foreignObject><div>in</div></foreignObject></svg><p>b", ["b"]),
    ],
)
def test_tags_that_may_be_left_out(page, want):
    assert [b.text for b in blocks(page)] == want


@pytest.mark.parametrize("page", ["<div>a" * 60_000, "<div>" * 60_000 + "a" + "</i>" * 60_000, "".join(f"<div class=z{i}>a" for i in range(20_000)), "<p>a" * 60_000])
def test_nests_are_labelled_in_linear_time_and_space(net, page):
    start = time.time()
    tracemalloc.start()
    text, n = main_text([page], net)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == page.count(">a")
    assert time.time() - start < 90 and peak < 300 << 20


def test_paths_summed_along_the_tree(net):
    random = np.random.default_rng(5)
    for _ in range(60):
        found, _ = labelled(random)
        rows = [np.array(_path_rows[b.path]) for b in found]
        want = np.array([net["path"][r].sum(axis=0) for r in rows]).reshape(len(found), -1)
        assert np.allclose(path_vectors(found, net["path"]), want, atol=1e-5)


def test_stretches_make_no_difference(net, monkeypatch):
    random = np.random.default_rng(6)
    pages = [labelled(random)[0] for _ in range(20)]
    want = label(pages, net)
    monkeypatch.setattr("postmill.llm.block_labeller.STEP_BLOCKS", 3)
    assert all((a == b).all() for a, b in zip(label(pages, net), want, strict=True))


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>Only a short text.</p>"), (3, "u", "<p>One story of words.</p>" * 3000)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'y' AS n_chars")
    got = extract(df).orderBy("page_id").collect()
    assert [r.page_id for r in got] == [None, None, 1, 1, 2, 2, 3, 3]
    assert [(r.text, r.n_chars) for r in got[2:6]] == [("", 0)] * 4
    assert got[6] == got[7] and got[6].n_blocks == 3000
    assert extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("letter", ["", "\u0130", "\u1e9e", "\u212a"])
def test_raw_elements_end_in_any_case(letter):
    page = f"<TITLE>{letter}</Title><SCRIPT>x</SCRIPT><style>y</STYLE><p>The article {letter} goes on.</p>"
    assert [b.text for b in blocks(page)] == [" ".join(f"The article {letter} goes on.".split())]
