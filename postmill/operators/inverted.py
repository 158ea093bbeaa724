"""Indexed search: postings of trigrams or array elements beside the table, so that a search reads hits, not rows.

An index is a Parquet table (bucket, term, ids): partitioned by a hash of the term, sorted by term within
each partition, with a list of ids for each stretch of rows, and a small table of how many ids each term has. A search reads the counts of
its terms, takes the rarest, reads only their buckets (a partition filter, and the term's row groups), and checks
the candidates against the rows themselves: results are exactly those of the scan.

An index is kept up by adding the postings of new and changed rows (``extend_index``). Postings of rows that
are gone or have changed since are harmless, as every candidate is checked; ``write_index`` anew drops them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.functions.text import col
from postmill.operators.filters import contains_all, contains_any, keyword_match
from postmill.session import run_on_workers

run_on_workers(__name__)

GRAM = 3
BLOCK = 1 << 20  # terms (or characters) that a task takes at once
BUCKETS = 64
RAREST = 3  # terms whose postings are intersected
POSTINGS = "term string, ids array<bigint>, bucket int"
COUNTS = "term string, n bigint, bucket int"


def _grams(texts: list[bytes | None]) -> pa.Array:
    """Distinct trigrams of each text, as lists of strings."""
    found = []
    for text in texts:
        chars = np.frombuffer((text or b"").decode(errors="replace").encode("utf-32-le"), "<u4").astype(np.int64)
        found.append(np.unique(chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:]) if len(chars) >= GRAM else chars[:0])
    codes, which = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_inverse=True)
    strings = pa.array(["".join(chr(c >> shift & 0x1FFFFF) for shift in (42, 21, 0)) for c in codes.tolist()], pa.string())
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), strings.take(pa.array(which)))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _trigrams(texts: pa.Array) -> pa.Array:
    parts, at, size = [], [], 0
    for text in texts.cast(pa.binary()):
        at.append(text.as_py())
        size += len(at[-1] or b"")
        if size >= BLOCK:
            parts.append(_grams(at))
            at, size = [], 0
    return pa.concat_arrays([*parts, _grams(at)])


def trigrams(text: Column | str) -> Column:
    """Distinct sequences of three characters, in one pass over the text."""
    return _trigrams(col(text))


def search_text(title: Column | str = "title", description: Column | str = "description") -> Column:
    """What a keyword is searched in."""
    return F.lower(F.concat_ws(" ", F.coalesce(col(title), F.lit("")), F.coalesce(col(description), F.lit(""))))


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each term, from rows (id, terms): one row per term and stretch of rows."""
    for batch in batches:
        start = 0
        lengths = pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        while start < batch.num_rows:
            begun = ends[start] - lengths[start]
            stop = max(start + 1, int(np.searchsorted(ends, begun + BLOCK, "right")))
            part, start = batch.slice(start, stop - start), stop
            terms = pc.list_flatten(part.column("terms")).dictionary_encode()
            codes = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = pc.list_parent_indices(part.column("terms")).to_numpy(zero_copy_only=False)
            order = np.argsort(part.column("id").to_numpy(), kind="stable")
            pairs = np.unique((codes << 32 | np.argsort(order)[rows])[codes >= 0])
            codes, rows = pairs >> 32, order[pairs & 0xFFFFFFFF]
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            ids = part.column("id").take(pa.array(rows))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(codes)), pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([terms.dictionary.take(pa.array(codes[first])), lists], names=["term", "ids"])


def _append(rows: DataFrame, id_col: str, terms: Column, path: str, buckets: int) -> None:
    # ids are gathered by term before the shuffle, so lists are sorted and written, far fewer than the postings; a term
    # that a third of all rows have is spread by rebalancing, which splits large partitions
    pairs = rows.select(F.col(id_col).cast("bigint").alias("id"), terms.alias("terms")).filter("id is not null")
    lists = pairs.mapInArrow(_gathered, "term string, ids array<bigint>").withColumn("bucket", bucket_of(F.col("term"), buckets))
    lists = lists.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", F.col("ids")[0])
    lists.select("term", "ids", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/postings")


def _count(spark: SparkSession, path: str) -> None:
    counts = spark.read.schema(POSTINGS).parquet(f"{path}/postings").groupBy("bucket", "term").agg(F.sum(F.size("ids").cast("bigint")).alias("n"))
    counts.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").select("term", "n", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/counts")


def write_index(rows: DataFrame, id_col: str, terms: Column, path: str, buckets: int = BUCKETS) -> None:
    """Index the terms (an array column) of rows with a unique id into a new folder."""
    spark = rows.sparkSession
    spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{path}/layout")
    _append(rows, id_col, terms, path, buckets)
    _count(spark, path)


def extend_index(rows: DataFrame, id_col: str, terms: Column, path: str) -> None:
    """Add the postings of new or changed rows. A repeated call adds them again, which changes no result.

    Counts only order the terms of a search, so those of new terms are enough until the index is written
    anew: a term without a count is taken as the rarest.
    """
    _append(rows, id_col, terms, path, rows.sparkSession.read.parquet(f"{path}/layout").first()[0])


def _rarest(spark: SparkSession, path: str, terms: list[str], most: int) -> list[str]:
    """The rarest of a search's terms by the index."""
    buckets = spark.read.parquet(f"{path}/layout").first()[0]
    known = spark.read.schema(COUNTS).parquet(f"{path}/counts").filter(_probe(spark, terms, buckets))
    times = {r["term"]: r["n"] for r in known.collect()}  # a row per term asked for
    return sorted(terms, key=lambda t: (times.get(t, 0), t))[:most]


def _probe(spark: SparkSession, terms: list[str], buckets: int) -> Column:
    numbers = spark.createDataFrame([(t,) for t in terms], "term string").select(bucket_of(F.col("term"), buckets).alias("b")).collect()
    return F.col("bucket").isin(sorted({r["b"] for r in numbers})) & F.col("term").isin(sorted(terms))


def postings_of(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """(term, id) of some terms; only their buckets are read."""
    buckets = spark.read.parquet(f"{path}/layout").first()[0]
    return spark.read.schema(POSTINGS).parquet(f"{path}/postings").filter(_probe(spark, terms, buckets)).select("term", F.explode("ids").alias("id")).distinct()


def ids_with_all(spark: SparkSession, path: str, terms: list[str], most: int | None = RAREST) -> DataFrame:
    """Ids that have all of the terms (of the ``most`` rarest ones)."""
    wanted = _rarest(spark, path, sorted(set(terms)), most or len(terms))
    return postings_of(spark, path, wanted).groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") == len(wanted)).select("id")


def _only(df: DataFrame, id_col: str, ids: list[DataFrame]) -> DataFrame:
    """Rows whose id is in every one of the lists."""
    both = reduce(lambda a, b: a.join(b, "id", "left_semi"), ids)
    return df.join(both.select(F.col("id").alias(id_col)), id_col, "left_semi")


def _grams_of(word: str) -> list[str]:
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def search_indexed(df: DataFrame, id_col: str, text_index: str, keywords: str = "", location: str = "", max_jobs: int | None = 25, place_index: str | None = None, order: str = "seq") -> DataFrame:
    """Keyword and location search through trigram indexes; the rows of ``filters.search``.

    Words of fewer than three letters have no trigram and are only checked; where a search has no
    longer word, it is the scan.
    """
    spark = df.sparkSession
    ids = [ids_with_all(spark, text_index, _grams_of(w)) for w in sorted(set(keywords.lower().split())) if len(w) >= GRAM]
    if place_index and len(location) >= GRAM:
        ids.append(ids_with_all(spark, place_index, _grams_of(location.lower())))
    rows = _only(df, id_col, ids) if ids else df
    hits = rows.filter(keyword_match(keywords, location))
    return hits if max_jobs is None else hits.orderBy(order).limit(max_jobs)


def rows_with_all(df: DataFrame, id_col: str, array: str, index: str, wanted: list[str]) -> DataFrame:
    """Rows whose array has all of the elements: the rarest element's rows first, then the others' among them."""
    rows = _only(df, id_col, [ids_with_all(df.sparkSession, index, wanted)]) if wanted else df
    return rows.filter(contains_all(array, wanted))


def rows_with_any(df: DataFrame, id_col: str, array: str, index: str, wanted: list[str]) -> DataFrame:
    """Rows whose array has one of the elements."""
    if not wanted:
        return df.limit(0)
    ids = postings_of(df.sparkSession, index, sorted(set(wanted))).select("id").distinct()
    return _only(df, id_col, [ids]).filter(contains_any(array, wanted))


def rows_with(df: DataFrame, id_col: str, array: str, index: str, element: str) -> DataFrame:
    """Rows whose array has the element."""
    return rows_with_all(df, id_col, array, index, [element])


def elements(array: Column | str) -> Column:
    """The terms of an array column's index."""
    return F.coalesce(col(array), F.array().cast("array<string>"))

