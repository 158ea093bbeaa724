"""What the operators share: input columns, batches of bounded size, Arrow in and out."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import ship_package

BATCH_BYTES = str(8 << 20)  # of rows that go to a Python task at once
SLICE_CHARS = 1 << 20  # texts that one step of a Python task handles together


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, null texts as empty; other columns are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def trim() -> None:
    """Hand memory that Python and Arrow have freed back to the system: workers outlive tasks and stages."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # the C library may have no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with about ``SLICE_CHARS`` of text each (one row at least)."""
    start, size = 0, 0
    texts: list[str] = []
    values = batch.column(column)
    for i in range(batch.num_rows):
        text = values[i].as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield batch.slice(start, i + 1 - start), texts
            start, size, texts = i + 1, 0, []
    if texts:
        yield batch.slice(start), texts
    trim()


def map_texts(
    df: DataFrame, work: Callable[[pa.RecordBatch, list[str]], dict[str, list]], schema: str, column: str = "text"
) -> DataFrame:
    """Apply ``work`` to slices of the rows; it returns the columns of ``schema``, one list each."""
    types = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, column):
                out = work(part, texts)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in types], schema=types)

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string of plain types; the workers that use it get this package, and
    batches of a size that leaves room for two of them beside an executor's heap."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
