"""Streams over several micro-batches."""

import pytest
from pyspark.sql import functions as F

from postmill.operators.crawls import before_block
from postmill.operators.upsert import upsert_table
from postmill.session import work_dir
from postmill.streaming import jobs as ST

LOG = "crawl_id long, seq long, url string, status int"


def _land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_latch_holds_across_batches(spark):
    landed, out, latches, check = (work_dir(spark, n) for n in ("landed", "out", "latches", "check"))
    schema = spark.createDataFrame([], LOG).schema

    def go():
        log = ST.landing(spark, landed, schema, files_per_batch=1)
        ST.stream_block_latch(log, out, latches, check).awaitTermination()

    _land(spark, landed, [(1, 1, "https://x/jobs", 200), (1, 2, "https://x/login", 200), (2, 1, "https://x/jobs", 200)], LOG)
    go()
    _land(spark, landed, [(1, 3, "https://x/jobs", 200), (2, 2, "https://x/jobs", 200)], LOG)
    go()
    rows = ST.latched(spark, out, latches).collect()
    assert sorted((r.crawl_id, r.seq) for r in rows) == [(1, 1), (2, 1), (2, 2)]


def test_late_blocks_count_when_the_table_is_read(spark):
    landed, out, latches, check = (work_dir(spark, n) for n in ("landed", "out", "latches", "check"))
    schema = spark.createDataFrame([], LOG).schema
    batches = [[(1, 5, "https://x/jobs", 200), (1, 2, "https://x/jobs", 200)], [(1, 4, "https://x/login", 200), (2, 9, "https://x/jobs", 200)], [(1, 3, "https://x/jobs", 429), (1, 1, "https://x/jobs", 200)]]
    for rows in batches:
        _land(spark, landed, rows, LOG)
        ST.stream_block_latch(ST.landing(spark, landed, schema), out, latches, check).awaitTermination()
    whole = spark.createDataFrame([r for b in batches for r in b], LOG)
    want = sorted((r.crawl_id, r.seq) for r in before_block(whole).collect())
    assert sorted((r.crawl_id, r.seq) for r in ST.latched(spark, out, latches).collect()) == want == [(1, 1), (1, 2), (2, 9)]


def test_upsert_stream_keeps_one_row_per_key(spark):
    landed, path, check = (work_dir(spark, n) for n in ("landed", "table", "check"))
    columns = "ats_source string, company_slug string, job_id string, job_title string"
    schema = spark.createDataFrame([], columns).schema
    for n, rows in enumerate([[("s", "c", "1", "a"), ("s", "c", "2", "b")], [("s", "c", "1", "a2"), ("t", "c", "1", "z")]]):
        _land(spark, landed, rows, columns)
        stream = ST.landing(spark, landed, schema)
        ST.stream_upsert(stream, path, check, ["job_title"], now=F.lit(f"2024-0{n + 1}-01").cast("timestamp"), n_buckets=2).awaitTermination()
    rows = spark.read.parquet(path).collect()
    assert sorted((r.ats_source, r.job_id, r.job_title) for r in rows) == [("s", "1", "a2"), ("s", "2", "b"), ("t", "1", "z")]


def test_dedup_stream_keeps_the_first(spark):
    landed, out, check = (work_dir(spark, n) for n in ("landed", "out", "check"))
    columns = "company_name string, job_id string, seq long"
    schema = spark.createDataFrame([], columns).schema
    for rows in ([("A", "1", 7), ("a", "1", 5)], [("A", "1", 2), ("B", "1", 3), ("b", "1", 4)], [("C", "9", 1)]):
        _land(spark, landed, rows, columns)
        ST.stream_dedup(ST.landing(spark, landed, schema), out, check, ["seq"]).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.company_key, r.job_id, r.seq) for r in rows) == [("a", "1", 5), ("b", "1", 3), ("c", "9", 1)]


TABLE = "ats_source string, company_slug string, job_id string, job_title string"


def test_upsert_refuses_null_keys_and_loses_nothing(spark):
    path = work_dir(spark, "table")
    now = F.lit("2024-01-01").cast("timestamp")
    rows = spark.createDataFrame([("s", "c", str(n), "a") for n in range(20)], TABLE)
    upsert_table(spark, path, rows, now, ["job_title"], 2)
    with pytest.raises(ValueError, match="null"):
        upsert_table(spark, path, spark.createDataFrame([(None, "c", "1", "x"), ("s", "c", "99", "y")], TABLE), now, ["job_title"], 2)
    assert spark.read.parquet(path).count() == 20


def test_upsert_into_an_unreadable_table_fails(spark, tmp_path):
    path = tmp_path / "table"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"not a table")
    rows = spark.createDataFrame([("s", "c", "1", "a")], TABLE)
    with pytest.raises(Exception):  # noqa: B017, PT011
        upsert_table(spark, str(path), rows, F.lit("2024-01-01").cast("timestamp"), ["job_title"], 2)
    assert (path / "part-0.parquet").read_bytes() == b"not a table"
