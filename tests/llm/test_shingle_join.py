"""Similar documents against all pairs."""

import random

import numpy as np
import pytest

from postmill.llm import shingle_join as join
from postmill.llm.components import components
from postmill.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF
from tests.oracle import connect, differences


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain(rows):
    """doc_id, set size, smallest id reachable, of (doc_id, text) rows."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same_doc = rows[i][0] == rows[j][0] and rows[i][0] is not None
            linked = a and b and 100 * len(a & b) >= 75 * len(a | b) and None not in (rows[i][0], rows[j][0])
            if same_doc or linked:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def found(docs):
    return sorted((tuple(r) for r in join.similar_documents(docs).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def edited(r, words, rate):
    return [w if r.random() > rate else f"x{r.randrange(10**6)}" for w in words]


def family(r, n, size, rate):
    base = [f"b{r.randrange(10**6)}" for _ in range(size)]
    return [" ".join(edited(r, base, rate)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_all_pairs(docs_of, seed):
    r = random.Random(seed)
    texts = []
    for size in (3, 5, 6, 7, 9, 12, 20, 45, 100, 300):
        for rate in (0.01, 0.03, 0.06):
            texts += family(r, 6, size, rate)
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [f"{shared} " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.choice([5, 20, 120]))) for _ in range(60)]
    texts += [texts[3]] * 5 + [texts[40].upper()] * 3 + ["", " \n", None, "one", "ONE", "one two"]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(docs_of(rows)) == plain(rows)


def test_hot_pieces_lose_no_link(docs_of):
    """Documents that consist of a shared passage for the most part."""
    r = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(40))
    texts = [f"{shared} " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.choice([4, 9, 16]))) for _ in range(50)]
    for _ in range(12):
        texts += [f"{shared} {t}" for t in family(r, 3, 14, 0.02)]
    rows = list(enumerate(texts))
    assert found(docs_of(rows)) == plain(rows)


def test_keys_are_shared_by_every_similar_pair():
    r = random.Random(4)
    for _ in range(1500):
        n = r.choice([3, 4, 5, 6, 7, 8, 13, 14, 15, 33, 34, 60, 79, 80, 81, 200])
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(a)
        for x in r.sample(sorted(a), r.randint(0, n // 4)):
            b.discard(x)
        b |= {r.getrandbits(64) for _ in range(r.randint(0, n // 3))}
        if a == b or 100 * len(a & b) < 75 * len(a | b):
            continue
        # an order that knows half of what they share, and one that knows nothing
        some = np.array(sorted(set(join.keys_of(np.array(sorted(a), np.uint64))[0].tolist()[::2])), np.uint64)
        for order in (join.Order(some, np.arange(len(some)) + 4), join.Order(some[:0], some[:0])):
            keys = [join.keys_of(np.array(sorted(s), np.uint64), order) for s in (a, b)]
            shared = set(keys[0][0].tolist()) & set(keys[1][0].tolist())
            assert len(shared) > max(keys[0][1], keys[1][1])


def test_sketch_distance_is_a_lower_bound():
    r = random.Random(8)
    for _ in range(300):
        n, m = r.choice([1, 5, 200, 256, 257, 700, 3000]), r.choice([0, 3, 100, 900])
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(r.sample(sorted(a), r.randint(0, n))) | {r.getrandbits(64) for _ in range(m)}
        sketches = [join.sketch_of(np.array(sorted(s), np.uint64)) for s in (a, b)]
        assert (len(a ^ b) - join.distance(*sketches)) % 2 == 0 <= len(a ^ b) - join.distance(*sketches)


def test_a_pair_across_components_is_made_once(spark):
    """Documents that share some of a passage's pieces, with others between them."""
    r = random.Random(6)
    have = {d: {k for k in range(30) if r.random() < 0.5} for d in range(60)} | {60: set(range(200)), 61: {0, 199}, 62: set(range(5, 200, 40))}
    pieces = spark.createDataFrame([(k, d) for d, keys in have.items() for k in keys], "key long, doc_id long")
    texts = spark.createDataFrame([(d, 100, bytes(64)) for d in have], "doc_id long, size int, sketch binary")
    alone = spark.createDataFrame([], "node long, component long")
    want = {(a, b) for a in have for b in have if a < b and have[a] & have[b]}
    rows = join.spread(pieces, texts, alone)
    made = [tuple(p) for p in join.meetings(rows).collect()]
    assert set(made) == want and len(made) <= 1.02 * len(want)
    assert sorted(tuple(p) for p in join.across(rows).collect()) == sorted(want)


def test_odd_rows(docs_of):
    text = "a text of some words that is long enough for a few shingles"
    rows = [(5, text), (5, text), (5, "another text of words"), (None, text), (7, text + " more"), (8, None), (9, ""), (9, "z"), (10, "w " * 60_000), (11, "w " * 50_000), (4, "another text OF words")]
    assert found(docs_of(rows)) == plain(rows)
    assert found(docs_of([])) == []
    kept = join.one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1 for r in kept.collect()))
    # of id 5 the text that id 7 has too stays, the one that id 4 has goes; nothing resembles the texts of id 9
    assert ids == [-1, 4, 5, 8, 9, 9, 10]


def test_texts_that_share_an_id_are_judged_each(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(30)) for k in "abcd")
    near = a.replace("a29", "a30")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, d), (5, b), (0, near), (None, a), (None, a), (9, ""), (9, ""), (9, None), (9, " ")]
    names = "doc_id long, text string, _times int, _gone int, _slot int, row int, mark int, place int, gone int, `a.b` int"
    docs = spark.createDataFrame([(*r, *range(8)) for r in rows], names)
    kept = join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(0, near), (5, b), (7, c), (7, d), (None, a), (None, a), (9, ""), (9, ""), (9, None), (9, " ")], key=repr)
    assert all(tuple(r)[2:] == tuple(range(8)) for r in kept.collect())
    assert join.one_of_each(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 200), (300, 299)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = dict(map(tuple, components(df).collect()))
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 0 for i in range(50)) and got[300] == got[299] == 299
    assert components(df.limit(0)).count() == 0


def test_query_agrees_with_sql(spark):
    got = QUERIES["op7_shingle_join"](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(SQL["op7_shingle_join"]).df()) is None
