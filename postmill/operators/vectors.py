"""Cosine top-k over embedding columns, exact and with inverted lists.

Queries are taken in blocks of a fixed size, one pass over the vectors each; the matrix of a
block travels to the tasks. Each task scores its rows batch by batch and keeps its own top-k
per query, so memory is bounded and the shuffle carries tasks x queries x k rows, whatever
the table's size. A query meets the vectors of its own length only; all forms agree on that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from postmill.session import run_on_workers, stage

run_on_workers(__name__)


QUERY_BLOCK = 2_048  # queries of one pass
# ---- fixed value ----
DEFAULT_LISTS = 100


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties by id; every tie at the edge is considered."""
    if len(scores) > k:
        edge = np.partition(scores, -k)[-k]
        keep = np.flatnonzero(scores >= edge)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def _clean(df: DataFrame, id_col: str, vec_col: str, *more: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"), *more)
    return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull())


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


Block = list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]


def _partial_top(block: Block, k: int):
    """mapInArrow body: one running top-k per query and task.

    ``block`` has, for each vector length, query ids, their unit matrix and, for inverted
    lists, which lists each query may see.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[(np.empty(0), np.empty(0, np.int64)) for _ in qids] for qids, _, _ in block]
        floors = [np.full(len(qids), -np.inf) for qids, _, _ in block]  # what a row must reach to matter
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vec")).to_numpy()
            for own, floor, (_, qmat, allowed) in zip(best, floors, block, strict=True):
                fit = batch.filter(pa.array(sizes == qmat.shape[1]))
                if not fit.num_rows:
                    continue
                ids = fit.column("id").to_numpy()
                scores = _unit(_matrix(fit.column("vec"))) @ qmat.T
                hits = scores >= floor
                if allowed is not None:
                    hits &= allowed[:, fit.column("list_id").to_numpy()].T
                for q in np.flatnonzero(hits.any(axis=0)):
                    rows = np.flatnonzero(hits[:, q])
                    s = np.concatenate([own[q][0], scores[rows, q]])
                    i = np.concatenate([own[q][1], ids[rows]])
                    top = _top(s, i, k)
                    own[q] = (s[top], i[top])
                    if len(top) == k:
                        floor[q] = own[q][0][-1]
        for own, (qids, _, _) in zip(best, block, strict=True):
            counts = [len(b[0]) for b in own]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(qids, counts), pa.int64()),
                        pa.array(np.concatenate([b[1] for b in own]), pa.int64()),
                        pa.array(np.concatenate([b[0] for b in own]), pa.float64()),
                    ],
                    names=["query_id", "id", "similarity"],
                )

    return run


def _rank(partial: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


SCHEMA = "query_id bigint, id bigint, similarity double"


def _blocks(queries: DataFrame, query_block: int) -> Iterator[Block]:
    """Query ids and unit matrices, about ``query_block`` queries at a time."""
    queries = stage(queries, "queries")
    n = math.ceil(queries.count() / query_block)
    for number in range(n):
        rows = queries.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == number).orderBy("id").collect()
        by_size: dict[int, list] = {}
        for r in rows:
            by_size.setdefault(len(r["vec"]), []).append(r)
        yield [
            (np.array([r["id"] for r in same], np.int64), _unit(np.array([r["vec"] for r in same], np.float64)), None)
            for size, same in sorted(by_size.items())
            if size
        ]


def knn(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    queries: DataFrame,
    query_id: str,
    query_vec: str,
    k: int,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Exact cosine top-k: (query_id, id, similarity, rank), ties by id, for any number of queries."""
    rows = _clean(df, id_col, vec_col)
    parts = [rows.mapInArrow(_partial_top(block, k), SCHEMA) for block in _blocks(_clean(queries, query_id, query_vec), query_block)]
    return _rank(reduce(DataFrame.unionByName, parts, df.sparkSession.createDataFrame([], SCHEMA)), k)


# ---- inverted lists ----


def train_lists(df: DataFrame, vec_col: str, lists: int = DEFAULT_LISTS, fraction: float = 1.0, seed: int = 1) -> DataFrame:
    """Centres (list_id, centre) for the inverted lists, fitted on all rows unless the caller
    asks for a fraction."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vecs = df.filter(F.col(vec_col).isNotNull()).select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    if fraction < 1:
        vecs = vecs.sample(fraction=fraction, seed=seed)
    vecs = vecs.persist()
    try:
        n = vecs.count()
        model = KMeans(k=min(lists, max(2, n)), seed=seed, maxIter=10, distanceMeasure="cosine").fit(vecs)
    finally:
        vecs.unpersist()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(centres, CENTRES)


CENTRES = "list_id int, centre array<double>"


def _centre_matrix(centres: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = centres.orderBy("list_id").collect()  # as many as there are lists
    return np.array([r["list_id"] for r in rows], np.int32), _unit(np.array([r["centre"] for r in rows], np.float64))


def assign_lists(df: DataFrame, vec_col: str, centres: DataFrame) -> DataFrame:
    """Add ``list_id``, the nearest centre (ties to the lower id); vectors of another length are
    left out, as no query of the lists' length can meet them."""
    names, matrix = _centre_matrix(centres)
    schema = StructType([*df.schema.fields, StructField("list_id", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(vec_col)), -1).to_numpy()
            fit = batch.filter(pa.array(sizes == matrix.shape[1]))
            if fit.num_rows:
                nearest = np.argmax(np.round(_unit(_matrix(fit.column(vec_col))) @ matrix.T, 12), axis=1)
                yield pa.RecordBatch.from_arrays([*fit.columns, pa.array(names[nearest])], names=[*fit.schema.names, "list_id"])

    return df.mapInArrow(run, schema)


def write_lists(df: DataFrame, vec_col: str, centres: DataFrame, path: str) -> None:
    """The table partitioned by list, so that a search reads the lists it probes and no other."""
    assign_lists(df, vec_col, centres).hint("rebalance", "list_id").write.partitionBy("list_id").parquet(path)


def knn_ivf(
    path: str,
    centres: DataFrame,
    id_col: str,
    vec_col: str,
    queries: DataFrame,
    query_id: str,
    query_vec: str,
    k: int,
    probes: int = 10,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Approximate top-k over written lists: each query sees its ``probes`` nearest lists."""
    spark = queries.sparkSession
    names, matrix = _centre_matrix(centres)
    table = spark.read.parquet(path)
    parts = []
    for block in _blocks(_clean(queries, query_id, query_vec), query_block):
        asked: Block = []
        wanted: set[int] = set()
        for qids, qmat, _ in block:
            if qmat.shape[1] == matrix.shape[1]:
                near = np.argsort(-np.round(qmat @ matrix.T, 12), axis=1, kind="stable")[:, :probes]
                allowed = np.zeros((len(qids), int(names.max()) + 1), bool)
                np.put_along_axis(allowed, names[near], True, axis=1)
                wanted |= {int(x) for x in names[np.unique(near)]}
                asked.append((qids, qmat, allowed))
        rows = _clean(table.filter(F.col("list_id").isin(sorted(wanted))), id_col, vec_col, "list_id")
        parts.append(rows.mapInArrow(_partial_top(asked, k), SCHEMA))
    return _rank(reduce(DataFrame.unionByName, parts, spark.createDataFrame([], SCHEMA)), k)


def recall(exact: DataFrame, approx: DataFrame) -> DataFrame:
    """Share of the exact neighbours the approximate search found, per query."""
    hit = approx.select("query_id", "id", F.lit(1).alias("hit"))
    both = exact.select("query_id", "id").join(hit, ["query_id", "id"], "left")
    return both.groupBy("query_id").agg(
        F.count("*").alias("n_exact"),
        F.count("hit").alias("n_found"),
        (F.count("hit") / F.count("*")).alias("recall"),
    )


def label_centres(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Mean vector per label, as query vectors (labels are a small fixed set)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vec = array_to_vector(F.col(vec_col).cast("array<double>"))
    means = df.filter(F.col(vec_col).isNotNull()).groupBy(F.col(label_col).alias("label")).agg(Summarizer.mean(vec).alias("m"))
    return means.select("label", vector_to_array("m").alias("centre"))
