"""Nearest neighbours: grid, lists and exact search agree."""

import numpy as np
import pytest

from postmill.operators import vector_join as VJ
from postmill.operators import vectors as VC
from postmill.operators.reconcile import same_rows
from postmill.plans.catalog import QUERIES, Inputs
from postmill.session import work_dir

SF = "/root/testdata/sf0.001"


def _args(spark):
    i = Inputs(spark, SF)
    data = i.table("embeddings")
    return data, VC.label_centres(data, "label", "embedding")


def test_blocks_of_queries_agree(spark):
    data, centres = _args(spark)
    direct = VC.knn(data, "vec_id", "embedding", centres, "label", "centre", 7)
    blocks = VC.knn(data, "vec_id", "embedding", centres, "label", "centre", 7, query_block=3)
    keys = ["query_id", "id", "rank"]
    assert same_rows(direct.select(*keys), blocks.select(*keys)).first().equal


def test_queries_meet_vectors_of_their_length(spark):
    data = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [])], "id long, v array<float>")
    ask = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0])], "q long, w array<double>")
    for block in (1, 100):
        rows = VC.knn(data, "id", "v", ask, "q", "w", 5, query_block=block).collect()
        assert sorted((r.query_id, r.id, r["rank"]) for r in rows) == [(1, 1, 1), (1, 3, 2), (2, 2, 1)]
    centres = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], VC.CENTRES)
    path = work_dir(spark, "lists")
    VC.write_lists(data, "v", centres, path)
    rows = VC.knn_ivf(path, centres, "id", "v", ask, "q", "w", 5, probes=1).collect()
    assert sorted((r.query_id, r.id) for r in rows) == [(1, 1), (1, 3)]


def test_all_lists_give_exact_answer_and_some_are_pruned(spark):
    data, centres = _args(spark)
    lists = VC.train_lists(data, "embedding", 8)
    path = work_dir(spark, "lists")
    VC.write_lists(data, "embedding", lists, path)
    exact = VC.knn(data, "vec_id", "embedding", centres, "label", "centre", 5)
    full = VC.knn_ivf(path, lists, "vec_id", "embedding", centres, "label", "centre", 5, probes=8)
    assert {r.recall for r in VC.recall(exact, full).collect()} == {1.0}
    some = VC.knn_ivf(path, lists, "vec_id", "embedding", centres.limit(1), "label", "centre", 5, probes=2)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list_id" in plan or "list_id" in plan.split("PartitionFilters")[1][:60]


def test_ties_go_to_the_lower_id(spark):
    data = spark.createDataFrame([(n, [1.0, 0.0]) for n in range(50, 0, -1)], "id long, v array<float>")
    ask = spark.createDataFrame([(1, [2.0, 0.0])], "q long, w array<double>")
    rows = VC.knn(data, "id", "v", ask, "q", "w", 3).orderBy("rank").collect()
    assert [r.id for r in rows] == [1, 2, 3]


def test_join_of_packets_is_the_exact_search(spark, monkeypatch):
    """Also with small packets, a vector that a third of the rows have, and odd rows."""
    rng = np.random.default_rng(3)
    rows = [(i, None if i % 17 == 0 else [1.0, 2.0, 0.0, 0.0] if i % 3 == 0 else rng.normal(size=4 if i % 19 else 3).tolist(), "x") for i in range(300)]
    df = spark.createDataFrame(rows + [(None, [1.0, 0.0, 0.0, 0.0], "x"), (900, [0.0] * 4, "x")], "id bigint, v array<double>, list_id string")
    ask = df.filter("id % 7 = 0 or id = 900")
    want = VC.knn(df, "id", "v", ask.filter("size(v) = 4"), "id", "v", 5)
    for packet, queries in ((1 << 15, 256), (64, 3)):
        monkeypatch.setattr(VJ, "PACKET", packet)
        monkeypatch.setattr(VJ, "QUERIES", queries)
        got = VJ.search_exact(df, "id", "v", ask, "id", "v", 5, 4)
        assert {(r.query_id, r.id, r["rank"], round(r.similarity, 9)) for r in got.collect()} == {(r.query_id, r.id, r["rank"], round(r.similarity, 9)) for r in want.collect()}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_codes_for_a_query_load(spark, sf):
    """Queries are rows of the table, not its list centres."""
    row = QUERIES["knn_recall"].run(Inputs(spark, f"/root/testdata/{sf}")).first()
    assert row.enough and row.n_exact == 10 * row.n_queries


def test_codes_of_every_list_lose_little(spark):
    i = Inputs(spark, "/root/testdata/sf0.01")
    rows, path = i.table("embeddings"), work_dir(spark, "codes")
    centres, books = VC.train_lists(rows, "embedding", 8), VJ.train_codebooks(rows, "vec_id", "embedding")
    VJ.write_codes(rows, "vec_id", "embedding", centres, books, path)
    ask = rows.filter("vec_id % 50 = 0")
    found = VJ.search_lists(path, centres, books, rows, "vec_id", "embedding", ask, "vec_id", "embedding", 10, 8)
    exact = VC.knn(rows, "vec_id", "embedding", ask, "vec_id", "embedding", 10)
    assert VC.recall(exact, found).agg({"recall": "avg"}).first()[0] > 0.99
    assert found.filter("rank = 1 and (query_id <> id or abs(similarity - 1) > 1e-9)").count() == 0
