"""Streams with keyed state against their batch twins."""

import random
import time

from pyspark.sql import functions as F

from postmill.operators.crawls import before_block
from postmill.session import work_dir
from postmill.streaming import jobs as ST
from postmill.streaming import stateful as SF

LOG = "crawl_id long, seq long, url string, status int"
POSTINGS = "company_name string, job_id string, seq long, at timestamp"


def _run(spark, batches, columns, start):
    """Each batch is landed and the query started anew, as after a restart; returns the rows read by each run."""
    landed, schema = work_dir(spark, "landed"), spark.createDataFrame([], columns).schema
    progress = []
    for rows in batches:
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(landed)
        query = start(ST.landing(spark, landed, schema))
        if not query.awaitTermination(60):
            query.stop()
            raise AssertionError("the stream did not end")
        progress.append(sum(p["numInputRows"] for p in query.recentProgress))
    return progress


def test_first_of_key_is_the_batch_twin_and_reads_no_old_rows(spark):
    out, check = work_dir(spark, "out"), work_dir(spark, "check")
    rng = random.Random(4)
    batches = [[(rng.choice("aAbB") + str(rng.randint(0, 3)), str(rng.randint(0, 9)), 1000 * n + k, None) for k in rng.sample(range(40), 12)] for n in range(4)]
    progress = _run(spark, batches, POSTINGS, lambda s: SF.stream_first_of_key(s, out, check, ["seq"]))
    want = {}
    for rows in batches:
        for company, job, seq, _ in sorted(rows, key=lambda r: r[2]):
            want.setdefault((company.lower(), job), (seq, rows))
    got = {(r.company_key, r.job_id): r.seq for r in spark.read.parquet(out).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    # a batch reads its own rows only
    assert progress == [12] * 4


def test_dedup_within_a_watermark(spark):
    out, check = work_dir(spark, "out"), work_dir(spark, "check")
    at = lambda m: __import__("datetime").datetime(2024, 6, 1, 12 + m // 60, m % 60)
    batches = [[("A", "1", 1, at(0)), ("a", "1", 2, at(1))], [("A", "1", 3, at(5)), ("B", "1", 4, at(200))], [("B", "1", 5, at(205)), ("A", "1", 6, at(210))]]
    _run(spark, batches, POSTINGS, lambda s: SF.stream_dedup_within(s, out, check, "at", "30 minutes"))
    got = sorted((r.company_key, r.job_id) for r in spark.read.parquet(out).collect())
    assert got == [("a", "1"), ("a", "1"), ("b", "1")]  # three hours later it counts as new


def test_latch_is_the_batch_twin(spark):
    out, check = work_dir(spark, "out"), work_dir(spark, "check")
    rng = random.Random(9)
    rows = [(c, s, "https://x/login" if rng.random() < 0.08 else "https://x/jobs", 429 if rng.random() < 0.02 else 200) for c in range(6) for s in range(30)]
    rng.shuffle(rows)  # blocks come late and rows out of order
    batches = [rows[i::3] for i in range(3)]
    _run(spark, batches, LOG, lambda s: SF.stream_latch(s, out, check, slots=3))
    want = sorted((r.crawl_id, r.seq) for r in before_block(spark.createDataFrame(rows, LOG)).collect())
    assert sorted((r.crawl_id, r.seq) for r in SF.open_rows(spark, out).collect()) == want
    assert spark.conf.get(SF.PROVIDER) != SF.ROCKSDB


def test_state_of_a_crawl_expires(spark, monkeypatch):
    monkeypatch.setattr(SF, "EVERY", "1 second")
    out, check, landed = (work_dir(spark, n) for n in ("out", "check", "landed"))
    schema = spark.createDataFrame([], LOG).schema

    def add(*rows):
        spark.createDataFrame(list(rows), LOG).coalesce(1).write.mode("append").parquet(landed)

    add((1, 5, "https://x/login", 200), (1, 3, "https://x/jobs", 200))
    def wait(condition):  # a query with a clock has no end to wait for
        for _ in range(40):
            time.sleep(1)
            if spark.read.schema(SF.LATCHED).parquet(out).filter(condition).count():
                return
        raise AssertionError(condition)

    query = SF.stream_latch(ST.landing(spark, landed, schema), out, check, ttl_seconds=1, slots=2)
    try:
        time.sleep(3)
        wait("seq = 3")
        assert [(r.crawl_id, r.seq) for r in SF.open_rows(spark, out).collect()] == [(1, 3)]
        time.sleep(3)
        add((1, 9, "https://x/jobs", 200))
        wait("seq = 9")
    finally:
        query.stop()
    rows = spark.read.schema(SF.LATCHED).parquet(out)
    assert rows.filter("not blocked and seq = 9").count() == 1  # the latch was forgotten
    assert rows.filter(F.col("blocked")).count() == 2
