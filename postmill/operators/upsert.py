"""Insert-or-update by natural key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.normalize import surrogate_id
from postmill.operators.reconcile import first_by
from postmill.schemas import EMPTY_ARRAY_DEFAULTS, INSERT_DEFAULTS, NATURAL_KEY
from postmill.session import discard, read_if_there, work_dir

AUDIT = ["id", "created_at", "updated_at"]


def _defaults() -> dict[str, Column]:
    empty = F.array().cast("array<string>")
    return {**{c: F.lit(v) for c, v in INSERT_DEFAULTS.items()}, **{c: empty for c in EMPTY_ARRAY_DEFAULTS}}


def upsert(
    current: DataFrame,
    batch: DataFrame,
    now: Column,
    order: list,
    keys: list[str] = NATURAL_KEY,
) -> DataFrame:
    """Current rows updated by the batch, new rows inserted; one row per key.

    Of several batch rows with one key the first in ``order`` counts. ``updated_at`` moves
    only when a value really changed, ``created_at`` never; defaults fill inserted rows
    only. Columns the batch lacks keep their value.
    """
    values = [c for c in batch.columns if c in current.columns and c not in [*AUDIT, *keys]]
    unique = first_by(batch, keys, order)
    new = unique.select(*keys, *[F.col(c).alias(f"new_{c}") for c in values], F.lit(True).alias("in_batch"))
    both = current.withColumn("in_table", F.lit(True)).join(new, keys, "full_outer")
    is_new, is_hit = F.col("in_table").isNull(), F.col("in_batch").isNotNull()
    # compare values only where both sides exist; <=> treats two nulls as equal
    changed = F.lit(False)
    for c in values:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"new_{c}"))
    defaults = _defaults()

    def column(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c == "id":
            return surrogate_id()
        if c == "created_at":
            return F.when(is_new, now).otherwise(F.col(c))
        if c == "updated_at":
            return F.when(is_new | (is_hit & changed), now).otherwise(F.col(c))
        value = F.when(is_hit, F.col(f"new_{c}")).otherwise(F.col(c)) if c in values else F.col(c)
        return F.when(is_new, F.coalesce(value, defaults[c])).otherwise(value) if c in defaults else value

    return both.select(*[column(c).alias(c) for c in current.columns])


def bucket_of(n_buckets: int, keys: list[str] = NATURAL_KEY) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    now: Column,
    order: list,
    n_buckets: int = 64,
    order_only: tuple[str, ...] = (),
) -> None:
    """Upsert a batch into a Parquet table partitioned by source and key bucket.

    The batch is reduced to one row per key (the first in ``order``) and staged once; a null in
    the natural key is refused before anything is written. Only the partitions it touches are
    read and rewritten. The merged rows are staged, large partitions spread over several tasks
    by their real size, and put in place by a dynamic partition overwrite that needs no further
    shuffle: a job that fails in between can be run again. Both staged folders are removed at
    the end. Only a path that does not exist counts as a new table; a table that cannot be read
    is an error. Plain Parquet has no snapshots: readers should not read while it is rewritten.
    ``order_only`` names batch columns that only serve the order and are no part of the table.
    """
    parts = ["ats_source", "bucket"]
    rows = first_by(batch, NATURAL_KEY, order).withColumn("bucket", bucket_of(n_buckets)).drop(*order_only)
    staged_batch, staged = work_dir(spark, "upsert-batch"), work_dir(spark, "upsert")
    rows.write.parquet(staged_batch)
    rows = spark.read.schema(rows.schema).parquet(staged_batch)
    null_key = F.exists(F.array(*[F.col(k).isNull() for k in NATURAL_KEY]), lambda x: x)
    if not rows.filter(null_key).isEmpty():
        discard(spark, staged_batch)
        raise ValueError(f"batch rows with a null in {NATURAL_KEY}")
    current = read_if_there(spark, path, rows.schema)
    # at most sources x n_buckets pairs, whatever the size of the batch
    touched = rows.select(*parts).distinct().collect()
    by_source: dict[str, list[int]] = {}
    for t in touched:
        by_source.setdefault(t["ats_source"], []).append(t["bucket"])
    wanted = F.lit(False)
    for source, buckets in by_source.items():
        wanted = wanted | ((F.col("ats_source") == source) & F.col("bucket").isin(buckets))
    if touched:
        merged = upsert(current.filter(wanted), rows.drop("bucket"), now, list(NATURAL_KEY))
        merged = merged.withColumn("bucket", bucket_of(n_buckets))
        merged.hint("rebalance", *parts).write.partitionBy(*parts).parquet(staged)
        in_place = spark.read.schema(merged.schema).parquet(staged).write.mode("overwrite")
        in_place.option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
        discard(spark, staged)
    discard(spark, staged_batch)
