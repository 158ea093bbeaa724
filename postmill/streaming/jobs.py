"""Structured Streaming jobs; the row rules are the batch functions.

Checkpoints and tables live in the shared folder, so a lost executor or a
restarted query goes on from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from postmill.operators.crawls import first_blocks
from postmill.operators.joins import lookup
from postmill.operators.normalize import normalize_postings
from postmill.operators.reconcile import company_key, first_by
from postmill.operators.upsert import upsert_table
from postmill.session import read_if_there
from postmill.sources.payloads import scan_payloads


def landing(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a landing folder (or glob) as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _start(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_ingest(payloads: DataFrame, path: str, checkpoint: str, keep: tuple[str, ...] = ()) -> StreamingQuery:
    """Landed payloads -> posting rows. Stateless, no shuffle."""
    return _start(normalize_postings(scan_payloads(payloads), keep=keep), path, checkpoint)


def stream_dedup(postings: DataFrame, path: str, checkpoint: str, order: list) -> StreamingQuery:
    """First posting per company and job id: the earliest batch wins, then ``order``.

    The keys seen are those of the rows already written, a table and no executor state, so no
    late row is lost, nothing expires, and a large company is a join that Spark can split. A
    replayed batch ignores what it wrote itself and gives the same rows.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        keys = ["company_key", "job_id"]
        fresh = first_by(batch.withColumn("company_key", company_key()), keys, order)
        nothing = StructType([*fresh.schema.fields, StructField("batch", LongType())])
        seen = read_if_there(batch.sparkSession, path, nothing).filter(F.col("batch") < batch_id)
        kept = fresh.join(seen.select(*keys), keys, "left_anti")
        kept.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _each(postings, step, checkpoint)


def _each(df: DataFrame, step, checkpoint: str) -> StreamingQuery:
    return df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


LATCHES = "crawl_id bigint, first_block_seq bigint"


def stream_block_latch(captures: DataFrame, path: str, latches: str, checkpoint: str) -> StreamingQuery:
    """Emit captures before the first block of their crawl, across micro-batches.

    The latch is a table, first blocked seq per crawl, rather than keyed state: a crawl with a
    third of all rows is then an aggregate and a join that Spark can split. Each batch writes
    the whole latch anew from the last one, so it reads one small folder however many batches
    there were, and overwrites its own folders, so a replayed batch gives the same result. A
    block that comes late, in a later batch but earlier in its crawl, cannot call back rows
    that are written: ``latched`` leaves them out when the table is read.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = first_blocks(batch).select(F.col("crawl_id").cast("bigint"), "first_block_seq")
        known = _latch(spark, latches, batch_id)
        latch = known.unionByName(new).groupBy("crawl_id").agg(F.min("first_block_seq").alias("first_block_seq"))
        latch.write.mode("overwrite").parquet(f"{latches}/batch={batch_id}")
        latch = spark.read.schema(LATCHES).parquet(f"{latches}/batch={batch_id}")
        _open(batch, latch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _each(captures, step, checkpoint)


def _latch(spark: SparkSession, latches: str, before: int | None = None) -> DataFrame:
    """The last whole latch, or that before a batch."""
    rows = read_if_there(spark, latches, f"{LATCHES}, batch bigint")
    rows = rows if before is None else rows.filter(F.col("batch") < before)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.filter(F.col("batch") == (-1 if last is None else last)).select("crawl_id", "first_block_seq")


def _open(rows: DataFrame, latch: DataFrame) -> DataFrame:
    rows = lookup(rows, latch, ["crawl_id"])
    return rows.filter(F.col("first_block_seq").isNull() | (F.col("seq") < F.col("first_block_seq"))).drop("first_block_seq")


def latched(spark: SparkSession, path: str, latches: str) -> DataFrame:
    """What the latch stream wrote, without rows after blocks that came late."""
    return _open(spark.read.parquet(path).drop("batch"), _latch(spark, latches))


def stream_upsert(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    order: list,
    now: Column | None = None,
    n_buckets: int = 64,
    order_only: tuple[str, ...] = (),
) -> StreamingQuery:
    """Upsert each micro-batch into the published table; replaying a batch changes nothing."""

    def step(batch: DataFrame, batch_id: int) -> None:
        at = now if now is not None else F.current_timestamp()
        upsert_table(batch.sparkSession, path, batch, at, order, n_buckets, order_only)

    return _each(rows, step, checkpoint)
