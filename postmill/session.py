"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
import uuid
from pathlib import Path

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime settings the jobs rely on. All are Spark defaults or size-checked by
# Spark itself; nothing here forces a broadcast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizeNullAwareAntiJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("postmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{os.environ.get('TMPDIR', '/tmp')}/postmill-{os.getpid()}")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """New folder for checkpoints and staged tables, under a root that all executors share.

    The cluster names the root in ``spark.checkpoint.dir``. Where that is unset (tests on one
    machine), the warehouse, which is shared as well, holds it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from there.

    For results that are read more than once: they are computed once, and a lost executor
    costs no recomputation of what lies before.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table, or no rows where the path does not exist; any other trouble is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as trouble:
        if trouble.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged folder from whatever store holds it."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context.hadoopConfiguration()).delete(folder, True)


def unstage(df: DataFrame) -> None:
    """Remove the folder of a staged table that nothing reads any more, and let Spark's cleaner drop the
    shuffle files of finished jobs, which it keeps as long as the driver remembers them."""
    files = df.inputFiles()
    if files:
        discard(df.sparkSession, files[0].rsplit("/", 1)[0])
    df.sparkSession.sparkContext._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that their Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_postmill_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="run-postmill-")  # on the driver alone; Spark serves the file
    package = Path(__file__).resolve().parent
    context.addPyFile(shutil.make_archive(f"{folder}/postmill", "zip", package.parent, package.name))
    context._postmill_shipped = True


def run_on_workers(module: str) -> None:
    """Send the functions of a module with each task, so executors need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
