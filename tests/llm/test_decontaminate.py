"""Leaks against a comparison of every text with every item at every shift."""

import itertools
import random
import time

import pytest

from postmill.llm.decontaminate import FORGIVING, MASKS, SAME, SHORTEST, WINDOW, Block, leaks, without_leaks
from postmill.llm.queries import QUERIES
from tests.llm.conftest import SF


def leaked(text, item):
    d, q = text.encode().lower().split(), item.encode().lower().split()
    if len(q) < SHORTEST:
        return False
    for shift in range(-len(q), len(d) + 1):
        first, last = max(0, -shift), min(len(q), len(d) - shift)
        same = [q[i] == d[i + shift] for i in range(first, last)]
        if len(q) < WINDOW:
            if len(same) == len(q) and sum(same) >= len(q) - (len(q) >= 8):
                return True
        elif any(sum(same[i : i + WINDOW]) >= SAME for i in range(len(same) - WINDOW + 1)):
            return True
    return False


def test_masks_hit_every_window_that_counts():
    places = range(WINDOW)
    for n in range(WINDOW - SAME + 1):
        for gone in itertools.combinations(places, n):
            assert any(all(o + p not in gone for p in mask) for mask in MASKS for o in range(WINDOW - mask[-1]))


def test_masks_hit_short_items_with_one_word_replaced():
    for n in range(SHORTEST, WINDOW):
        for gone in [None, *range(n)] if n >= FORGIVING else [None]:
            assert any(all(o + p != gone for p in mask) for mask in MASKS for o in range(n - mask[-1]))


def test_repeated_words_are_compared_by_diagonals():
    items = ["a " * 1000, "a b " * 300, "one of the other items here " * 20, "a a a a a"]
    block = Block.of(list(range(4)), items)
    start = time.time()
    for text in ("a " * 20_000, "a b " * 8000 + "x " * 20 + "a " * 13, "a " * 7 + "one of the other items here " * 3):
        assert {f[0] for f in block.search(text)} == {i for i, q in enumerate(items) if leaked(" ".join(text.split()[:40] + text.split()[-40:]), q)}
    assert time.time() - start < 30
    start = time.time()
    assert block.search("a " * 20_000)[0] == (0, 0, 0, 1000, 1000)
    assert time.time() - start < 2


def planted(r, items, words):
    text = [r.choice(words) for _ in range(r.randint(0, 60))]
    for _ in range(r.randint(0, 3)):
        own = r.choice(items).split()
        start = r.randint(0, max(0, len(own) - 5))
        part = [w if r.random() > 0.15 else r.choice(words) for w in own[start : start + r.randint(5, 30)]]
        at = r.randint(0, len(text))
        text[at:at] = part
    return " ".join(text)


def test_search_finds_what_brute_force_finds():
    r = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    items = [" ".join(r.choice(words) for _ in range(r.choice([0, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 20, 40]))) for _ in range(30)]
    block = Block.of(list(range(30)), items)
    for _ in range(250):
        text = planted(r, items, words)
        assert {f[0] for f in block.search(text)} == {i for i, q in enumerate(items) if leaked(text, q)}


ITEM = "the quick brown fox jumps over the lazy dog and runs far away from here today"
ROWS = [(1, None), (2, ""), (None, ITEM), (3, "a b " + ITEM.upper()), (3, "a b " + ITEM.upper()), (4, "clean " * 30_000), (5, ITEM.replace("fox", "cat"))]


@pytest.mark.parametrize("block_words", [1 << 18, 8])
def test_odd_rows(spark, docs_of, block_words):
    items = [(7, ITEM), (8, None), (9, "one two"), (None, "clean clean clean clean clean"), (7, ITEM)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    got = {tuple(r) for r in leaks(docs_of(ROWS), bench, block_words).collect()}
    assert got == {(None, 7, 0, 0, 16, 16), (3, 7, 2, 0, 16, 16), (4, None, 0, 0, 5, 5), (5, 7, 0, 0, 16, 15)}
    kept = without_leaks(docs_of(ROWS), bench, block_words)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, None), (2, "")]
    assert kept.columns == docs_of(ROWS).columns
    assert leaks(docs_of([]), bench).count() == 0
    assert leaks(docs_of(ROWS), bench.limit(0)).count() == 0
    assert without_leaks(docs_of(ROWS), bench.limit(0)).count() == len(ROWS)


def test_query_agrees_with_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    grams = {i.item_id: {tuple(w[k : k + 5]) for w in [i.text.encode().lower().split()] for k in range(len(w))} for i in items}
    want = set()
    for d in docs:
        words = d.text.encode().lower().split()
        own = {tuple(words[k : k + 5]) for k in range(len(words))}
        # thirteen words with at most three replaced need not share five in a row: share two
        pairs = {w[:2] for w in own}
        for i in items:
            if any(g[:2] in pairs for g in grams[i.item_id]) and leaked(d.text, i.text):
                want.add((d.doc_id, i.item_id))
    assert {(r.doc_id, r.item_id) for r in QUERIES["op5_decontamination"](spark, SF).collect()} == want
