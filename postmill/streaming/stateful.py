"""Streams with keyed state in RocksDB: running dedup and the block latch.

State is kept on the executors' disks and in the checkpoint, and a micro-batch looks up the keys it
brings and no other: its work does not grow with the stream's length. Where ``ttl_seconds`` is given,
what was not seen for so long is forgotten, which bounds the state, and the query runs until it is
stopped; without it nothing expires and the query ends when it has read what is there.

The table forms in ``streaming.jobs`` need no state store and give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from postmill.functions import urls as U
from postmill.operators.joins import lookup
from postmill.operators.reconcile import company_key
from postmill.session import run_on_workers, ship_package

run_on_workers(__name__)

SLOTS = 8  # keys over which the rows of one crawl are dealt
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocksdb(spark: SparkSession):
    """The state store of the queries started within; the setting is put back."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _start(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """What is there, then the end; with ``every``, a query that goes on until it is stopped."""
    ship_package(df.sparkSession)
    with _rocksdb(df.sparkSession):
        writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


EVERY = "10 seconds"  # between the micro-batches of a query whose state expires by the clock, which never ends by itself


class FirstOfKey(StatefulProcessor):
    """The first row of a key by ``order`` in the first micro-batch that has it."""

    def __init__(self, order: list[str], ttl_seconds: int | None):
        self.order, self.ttl = order, ttl_seconds

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", ttlDurationMs=None if self.ttl is None else 1000 * self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:  # noqa: N802
        if not self.seen.exists():
            yield min(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in self.order))
        self.seen.update((True,))

    def close(self) -> None:
        pass


def stream_first_of_key(postings: DataFrame, path: str, checkpoint: str, order: list[str], ttl_seconds: int | None = None) -> StreamingQuery:
    """First posting per company and job id (the rows of ``stream_dedup``), by keyed state."""
    rows = postings.withColumn("company_key", company_key())
    names = [c for c in rows.columns if c not in ("company_key", "job_id")]
    first = rows.groupBy("company_key", "job_id")
    mode = "ProcessingTime" if ttl_seconds else "None"
    kept = first.transformWithState(FirstOfKey(order, ttl_seconds), rows.select("company_key", "job_id", *names).schema, "Append", mode)
    return _start(kept, path, checkpoint, EVERY if ttl_seconds else None)


def stream_dedup_within(postings: DataFrame, path: str, checkpoint: str, time: str, lateness: str) -> StreamingQuery:
    """First arrival per company and job id; a repeat that comes later than ``lateness`` counts as new.

    For feeds whose repeats come soon: the state holds the keys of that time only.
    """
    rows = postings.withColumn("company_key", company_key()).withWatermark(time, lateness)
    return _start(rows.dropDuplicatesWithinWatermark(["company_key", "job_id"]), path, checkpoint)


class Latch(StatefulProcessor):
    """Rows before the first block of a crawl that is known so far, and the block itself when it moves."""

    def __init__(self, ttl_seconds: int | None):
        self.ttl = ttl_seconds

    def init(self, handle) -> None:
        self.first = handle.getValueState("first_block_seq", "seq bigint", ttlDurationMs=None if self.ttl is None else 1000 * self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:  # noqa: N802
        known = self.first.get()[0] if self.first.exists() else None
        first, waiting = known, []
        for r in rows:  # rows wait until the batch's blocks are known
            if r.blocked:
                first = r.seq if first is None else min(first, r.seq)
            elif first is None or r.seq < first:
                waiting.append(r)
        if first != known:
            self.first.update((first,))
            yield Row(crawl_id=key[0], seq=first, blocked=True)
        for r in waiting:
            if first is None or r.seq < first:
                yield Row(crawl_id=key[0], seq=r.seq, blocked=False)

    def close(self) -> None:
        pass


LATCHED = "crawl_id bigint, seq bigint, blocked boolean"


def stream_latch(captures: DataFrame, path: str, checkpoint: str, ttl_seconds: int | None = None, slots: int = SLOTS) -> StreamingQuery:
    """Sequence numbers before the first block of each crawl, by keyed state; read with ``open_rows``.

    The rows of a crawl are dealt over ``slots`` keys and its few blocks go to all of them, so a crawl
    with a third of a batch is not one task.
    """
    blocked = U.block_reason("status", "url").isNotNull()
    every = F.sequence(F.lit(0), F.lit(slots - 1))
    own = F.array(F.pmod(F.xxhash64("seq"), F.lit(slots)).cast("int"))
    rows = captures.select(F.col("crawl_id").cast("bigint"), F.col("seq").cast("bigint"), blocked.alias("blocked"), F.explode(F.when(blocked, every).otherwise(own)).alias("slot"))
    kept = rows.groupBy("crawl_id", "slot").transformWithState(Latch(ttl_seconds), LATCHED, "Append", "ProcessingTime" if ttl_seconds else "None")
    return _start(kept, path, checkpoint, EVERY if ttl_seconds else None)


def open_rows(spark: SparkSession, path: str) -> DataFrame:
    """(crawl_id, seq) of what the latch stream let pass, without rows after blocks that came later."""
    rows = spark.read.schema(LATCHED).parquet(path)
    latch = rows.filter("blocked").groupBy("crawl_id").agg(F.min("seq").alias("first"))
    found = lookup(rows.filter("not blocked"), latch, ["crawl_id"])
    return found.filter("first is null or seq < first").select("crawl_id", "seq")
