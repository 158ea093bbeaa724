"""Token ids of a corpus as files of Simple-8b blocks, in ascending order of documents.

``write_tokens`` deals the documents out by ranges of ``doc_id``, encodes each range in order and
writes its blocks (see ``simple8b``) as rows of Parquet files, so that Spark's own committer puts
them into any store and a lost executor's work is done again without leaving half a file.
``read_tokens`` decodes them, one row per document.

Null text is empty: its document holds the end id alone. A null ``doc_id`` sorts first. Repeated
rows are all written; rows of one ``doc_id`` are ordered by text. A document longer than a block
has a block to itself. An empty table gives no blocks. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.llm.bpe import Cache, encoder
from postmill.llm.common import pa_schema, texts_of, trim
from postmill.llm.simple8b import read_block, write_block
from postmill.session import work_dir

BLOCKS = "shard string, block long, shard_pos long, n_ids long, payload binary"
DECODED = "doc_id long, shard string, shard_start long, n_tokens long, ids_crc32 long"
BLOCK_IDS = 1 << 16  # ids after which a block is closed
END_ID = 0


def write_tokens(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Encode all texts, append the end id to each document, and write the block files."""
    spark = docs.sparkSession
    types = pa_schema(spark, BLOCKS)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, position = "", 0, 0
        held_docs: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = [[shard], [number], [position], [size], [write_block(held_docs, held)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, types, strict=True)], schema=types)

        for batch in batches:
            found = encoder(vocabulary).encode(batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                if not shard:
                    shard = f"from-{doc_id}"  # ranges do not overlap, so this names the range
                held_docs.append(doc_id)
                held.append(np.append(ids, np.array([END_ID], "<u4")))
                size += len(ids) + 1
                if size >= BLOCK_IDS:
                    yield close()
                    number, position = number + 1, position + size
                    held_docs, held, size = [], [], 0
            trim()
        if held:
            yield close()

    ordered = texts_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""
    files = spark.read.schema(BLOCKS).parquet(path)
    types = pa_schema(spark, DECODED)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Cache.only("files")
        for batch in batches:
            for row in range(batch.num_rows):
                docs, ends, ids = read_block(batch.column("payload")[row].as_py())
                ends = ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                data = memoryview(ids.tobytes())
                arrays = [
                    pa.array(docs, pa.int64()),
                    pa.array([batch.column("shard")[row].as_py()] * len(docs)),
                    pa.array(starts + batch.column("shard_pos")[row].as_py()),
                    pa.array(ends - starts),
                    pa.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=types)

    # one row per file: as many as the write had tasks, whatever the size of the corpus
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    first = F.regexp_extract("shard", "from-(.*)", 1).try_cast("long")
    earlier = Window.orderBy(first.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))
    decoded = files.select("shard", "shard_pos", "payload").mapInArrow(decode, DECODED)
    return decoded.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_corpus(docs: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Write the block files of a corpus (to the shared folder unless told) and read them back."""
    path = path or work_dir(docs.sparkSession, "tokens")
    write_tokens(docs, vocabulary, path)
    return read_tokens(docs.sparkSession, path)
