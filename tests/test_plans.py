"""What the physical plans must and must not contain."""

import pytest

from postmill.plans.catalog import QUERIES, Inputs

SF = "/root/testdata/sf0.001"
# these write files or train a model while they are built
EAGER = ("_sink", "stream_", "upsert_table", "knn_ivf", "knn_recall", "_indexed", "queue_claims")
PYTHON = {
    "page_extract",
    "page_cards",
    "page_jobs_row",
    "page_pagination",
    "search_forms",
    "selector_usage",
    "html_fallback",
    "knn_exact",
    "knn_grid",
    "knn_join",
}


def plan(spark, name):
    df = QUERIES[name].run(Inputs(spark, SF))
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not any(e in n for e in EAGER)])
def test_no_cross_join_and_python_only_where_declared(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert any(w in text for w in ("ArrowEvalPython", "MapInArrow", "CoGroupsInPandas")) == (name in PYTHON)


@pytest.mark.parametrize("name", ["dedup_first_wins", "cap_per_company", "representative", "redirect_chain", "dedup_uids"])
def test_first_wins_is_reduced_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize(("name", "scans"), [("job_entities", 1), ("norm_discovery", 1), ("norm_greenhouse", 1), ("payload_totals", 1), ("detail_overlay", 2), ("norm_recruitee", 1)])
def test_bodies_are_parsed_once(spark, name, scans):
    text = QUERIES[name].run(Inputs(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert text.lower().count("parsejson") == scans


def test_columns_are_pruned(spark):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(spark, "flagship_provider_distribution")
    assert "text" not in plan(spark, "queue_company").split("ReadSchema")[1]


def test_every_inventory_row_has_a_query():
    sizes = dict(A=18, B=21, C=17, D=15, E=9, F=15, G=12, H=4, I=37, J=7, K=4, L=8, M=3, N=2)
    rows = {f"{letter}{n}" for letter, size in sizes.items() for n in range(1, size + 1)}
    assert rows == {c for q in QUERIES.values() for c in q.covers.split()}
