"""Mixing against SQL and against sorting in memory."""

import math
import random
from hashlib import md5

import pytest

from postmill.llm import mixing
from postmill.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF
from tests.oracle import connect, differences


def plain_targets(sizes):
    """Resharing round by round, as the rule says it."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


def key(doc_id, text):
    u = (int(md5(f"mix:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    symbols = sum(c in "#*$%&|<>" for c in text)
    return -math.log(u) / max(0.05, 1 - 5 * symbols / max(len(text), 1))


def check(rows, got):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = plain_targets(sizes)
    for source, size in sizes.items():
        own = sorted((r for r in rows if r[2] == source), key=lambda r: (key(r[0], r[1] or ""), r[0] is not None, r[0] or 0))
        epochs = math.floor(targets[source] / size) if size else 0
        rest, so_far = targets[source] - epochs * size, 0
        for doc_id, text, _ in own:
            n = len((text or "").split())
            so_far += n
            row = got[doc_id]
            assert row.target == pytest.approx(targets[source], rel=1e-12) and (row.size, row.source_size) == (n, size)
            assert row.copies == epochs + (rest > 0 and so_far - n / 2 <= rest)
            assert row.taken == n * row.copies <= 2 * n


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_agrees_with_sorting_in_memory(docs_of, seed):
    r = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "É", "zz", None, "tiny"]
    rows = [
        (i, " ".join(["w"] * r.choice([0, 1, 3, 40, 400])) + " #" * r.choice([0, 0, 9]), s if s != "tiny" or i < 3 else "hot")
        for i, s in enumerate(r.choice(sources) for _ in range(250))
    ]
    got = {r.doc_id: r for r in mixing.mix(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    check(rows, got)


def test_taken_words_come_near_the_targets(spark):
    rows = QUERIES["op8_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source").toPandas()
    for _, own in rows.merge(docs, on="doc_id").groupby("source", dropna=False):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= own["size"].max() / 2 + 1
        assert (own.taken <= 2 * own["size"]).all()


def test_better_documents_are_likelier(docs_of):
    """Of equal sizes, a third of the words is taken once more: prose rather than markup."""
    rows = [(i, ("a b c d" if i % 2 else "# # # #"), "x" if i < 600 else "y") for i in range(1200)]
    got = {r.doc_id: r.copies for r in mixing.mix(docs_of(rows)).collect()}
    extra = [sum(got[i] - min(got.values()) for i in range(k, 600, 2)) for k in (0, 1)]
    assert extra[1] >= extra[0]


def test_odd_rows(docs_of):
    rows = [(1, None, None), (2, "", "a"), (None, "x y", "a"), (3, "x y z", "a"), (3, "x y z", "a"), (4, "w " * 60_000, "b")]
    got = mixing.mix(docs_of(rows))
    assert got.count() == len(rows) and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)
    again = mixing.mix(docs_of(rows))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)
    mixed = mixing.mixed_documents(docs_of(rows))
    assert mixed.columns == docs_of(rows).columns
    times = {r.doc_id: 0 for r in got.collect()}
    for r in mixed.collect():
        times[r.doc_id] += 1
    want = {}
    for r in got.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    assert times == want
    assert mixing.mix(docs_of([])).count() == 0 and mixing.mixed_documents(docs_of([])).count() == 0


def test_many_sources_are_joined_without_broadcast(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    rows = [(i, "w " * (i % 7), f"s{i % 5}" if i % 11 else None) for i in range(120)]
    check(rows, {r.doc_id: r for r in mixing.mix(docs_of(rows)).collect()})


def test_query_agrees_with_sql(spark):
    got = QUERIES["op8_mixing"](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(SQL["op8_mixing"]).df()) is None
