"""Periodic runs against a plain search."""

import hashlib
import random
import time
import zlib

import pytest

from postmill.llm.common import table
from postmill.llm.periodic_runs import find_runs, periodic_runs, planted, run_digests, without_repeats
from tests.llm.conftest import SF


def plain_runs(words):
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def test_runs_of_random_words():
    rng = random.Random(5)
    texts = []
    for _ in range(400):
        few = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        words = [rng.choice(few) for _ in range(rng.randint(0, 40))]
        root = [rng.choice(few) for _ in range(rng.randint(1, 6))]
        texts.append(words[: len(words) // 2] + root * rng.randint(0, 6) + root[: rng.randint(0, len(root))] + words[len(words) // 2 :])
    found = find_runs(texts)
    for words, runs in zip(texts, found, strict=True):
        assert runs == plain_runs(words)
        assert without_repeats(words, runs) == plain_collapse(words, runs)


def test_edges():
    assert find_runs([[], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 3, [b"a", b"b"] * 4]) == [[], [], [(0, 6, 1)], [], [(0, 8, 2)]]
    # the same words on both sides of a boundary of texts are no run
    assert find_runs([[b"a"] * 4, [b"a"] * 4]) == [[], []]


@pytest.mark.parametrize("words", [[b"a"] * 100_000, [b"%d" % (i % 997) for i in range(100_000)], [b"a", b"b"] * 30_000 + [b"a"] * 40_000])
def test_long_texts_take_no_square(words):
    start = time.perf_counter()
    (runs,) = find_runs([words])
    assert runs and time.perf_counter() - start < 20


def replanted(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def check(rows, docs):
    assert len(rows) == len(docs)
    want = {}
    for doc_id, text in docs:
        words = replanted(doc_id, text)
        runs = plain_runs(words) if len(words) < 1500 else None
        want.setdefault(doc_id, []).append((words, runs))
    for r in rows:
        words, runs = want[r.doc_id].pop()
        if runs is None:  # too long for the plain search
            continue
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(plain_collapse(words, runs))).hexdigest()


def test_query_on_whole_table(spark):
    from postmill.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    check(QUERIES["op11_periodic_runs"](spark, SF).collect(), docs)


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    same = "x y x y x y x y x y"
    docs = [(None, same, 1), (30, None, 1), (31, "", 2), (32, " \t\n", 2), (33, same, 3), (33, same, 3), (34, "é é " * 9, 4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, runs int")
    changed = df.withColumn("text", planted(df.text, df.doc_id))
    check(run_digests(periodic_runs(changed)).orderBy("doc_id").collect(), [d[:2] for d in docs])
    assert run_digests(periodic_runs(changed.limit(0))).collect() == []
