"""Taking work from a queue: claims with an owner, a lease and a retry counter, acknowledgements, dead letters.

What is claimed is a small table beside the queue: a row per id that is held, waits for another try or is
dead; acknowledged rows leave it (the queue's own status column keeps them out of the queue from then on). It is
written as a whole into a new version folder; a version exists from the moment its marker has been
renamed into place, and readers never see half a version. Where a rename never replaces a file (HDFS), one of
two writers loses, takes the new state and tries again, so two claims never share a row; on stores
without such a rename (local disks, object stores) one process should claim at a time.

Every step can be repeated: a claim that is run again returns the rows it still holds, an
acknowledgement of rows that are not held any more (a lease that ran out, a second call) does nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "id bigint, claim_id string, owner string, tries int, lease_until timestamp, dead boolean"
KEPT_VERSIONS = 8


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, folder) of the versions that exist, in order. Markers are named ``number-folder``."""
    folder, files = _folder(spark, f"{path}/versions")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted((int(n), _content(spark, f"{path}/versions/{n}")) for n in names if n.isdigit())


def _content(spark: SparkSession, path: str) -> str:
    """What a marker says: the folder of its version."""
    return spark.read.text(path).first()[0]


def _publish(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Create the marker of a version; false where another writer was first."""
    jvm = spark.sparkContext._jvm
    draft, files = _folder(spark, f"{path}/drafts/{folder}")
    out = files.create(draft, True)
    out.write(bytearray(folder.encode()))
    out.close()
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{number}")
    files.mkdirs(marker.getParent())
    if files.exists(marker):
        return False
    try:
        return bool(files.rename(draft, marker))
    except Py4JJavaError:
        return False


def state(spark: SparkSession, path: str) -> DataFrame:
    """The claims as of the last version."""
    known = _versions(spark, path)
    return spark.read.schema(STATE).parquet(f"{path}/data/{known[-1][1]}") if known else spark.createDataFrame([], STATE)


def _change(spark: SparkSession, path: str, step: Callable[[DataFrame], DataFrame | None]) -> None:
    """Publish what ``step`` makes of the last state; from the newer state once more where another writer was first."""
    while True:
        known = _versions(spark, path)
        before = spark.read.schema(STATE).parquet(f"{path}/data/{known[-1][1]}") if known else spark.createDataFrame([], STATE)
        after = step(before)
        if after is None:
            return
        folder = uuid.uuid4().hex
        after.select(*[f.split()[0] for f in STATE.split(", ")]).write.parquet(f"{path}/data/{folder}")
        if _publish(spark, path, known[-1][0] + 1 if known else 1, folder):
            for _, old in known[: -KEPT_VERSIONS + 1]:
                gone, files = _folder(spark, f"{path}/data/{old}")
                files.delete(gone, True)
            return


def claim(queue: DataFrame, path: str, claim_id: str, owner: str, n: int, now: Column, lease_seconds: int, max_tries: int = 3) -> DataFrame:
    """Hold the first ``n`` free rows of a queue (a unique column ``id``): (id, tries).

    Free is what no claim holds; a lease that has run out frees its row until it has been tried
    ``max_tries`` times, then the row is dead. Run again with the same ``claim_id``, it returns what it holds.
    """
    spark = queue.sparkSession

    def step(before: DataFrame) -> DataFrame | None:
        if not before.filter(F.col("claim_id") == claim_id).isEmpty():
            return None
        over = ~F.col("dead") & (F.col("lease_until") <= now)
        marked = before.withColumn("dead", F.col("dead") | (over & (F.col("tries") >= max_tries)))
        held = marked.filter(F.col("dead") | (F.col("lease_until") > now))
        again = marked.filter(~F.col("dead") & (F.col("lease_until") <= now)).select("id", "tries")
        rows = queue.select(F.col("id").cast("bigint").alias("id")).join(held.select("id"), "id", "left_anti")
        rows = rows.orderBy("id").limit(n).join(again, "id", "left")
        picked = rows.select(
            "id",
            F.lit(claim_id).alias("claim_id"),
            F.lit(owner).alias("owner"),
            (F.coalesce("tries", F.lit(0)) + 1).alias("tries"),
            F.timestamp_seconds(F.unix_seconds(now) + lease_seconds).alias("lease_until"),
            F.lit(False).alias("dead"),
        )
        waiting = marked.join(picked.select("id"), "id", "left_anti")
        return waiting.select(*picked.columns).union(picked)

    _change(spark, path, step)
    return state(spark, path).filter((F.col("claim_id") == claim_id) & ~F.col("dead")).select("id", "tries")


def acknowledge(done: DataFrame, path: str, claim_id: str, now: Column) -> DataFrame:
    """Drop the rows ``done`` (a column ``id``) of a claim that it still holds; returns the state after it.

    The caller writes its result first and then acknowledges: a row whose lease ran out meanwhile stays
    with whoever has it now.
    """
    spark = done.sparkSession
    mine = (F.col("claim_id") == claim_id) & ~F.col("dead") & (F.col("lease_until") > now)

    def step(before: DataFrame) -> DataFrame | None:
        gone = before.filter(mine).join(done.select(F.col("id").cast("bigint")).distinct(), "id", "left_semi").select("id")
        return None if gone.isEmpty() else before.join(gone, "id", "left_anti")

    _change(spark, path, step)
    return state(spark, path)


def release(failed: DataFrame, path: str, claim_id: str, now: Column) -> DataFrame:
    """End the lease of failed rows at once; the tries count. Returns the state after it."""
    spark = failed.sparkSession
    ids = failed.select(F.col("id").cast("bigint"), F.lit(True).alias("failed")).distinct()

    def step(before: DataFrame) -> DataFrame | None:
        rows = before.join(ids, "id", "left")
        hit = F.col("failed").isNotNull() & (F.col("claim_id") == claim_id) & ~F.col("dead") & (F.col("lease_until") > now)
        return None if rows.filter(hit).isEmpty() else rows.withColumn("lease_until", F.when(hit, now).otherwise(F.col("lease_until")))

    _change(spark, path, step)
    return state(spark, path)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Rows that were tried as often as allowed."""
    return state(spark, path).filter("dead").select("id", "tries", "owner")
