"""Cosine top-k for any number of queries, as a join: inverted lists, product-quantised codes, exact re-ranking.

Rows and queries meet by list: a query goes to the lists it probes, a row lies in one list. Both sides travel
in packets, up to PACKET codes of one list and up to QUERIES queries, and each pair of packets is one matrix
product. No query vector is on the driver, the table is read once however many queries there are, and a large
list is dealt over several keys. A packet keeps its best ``candidates`` per query; the best of all
packets are compared again with the vectors themselves.

A code has a byte for each of PARTS stretches of the unit vector, the number of the nearest centre there. The
codebooks are fitted on TRAINED rows at most, the first by a hash of their ids; every row is coded.
``search_exact`` is the same join on the vectors themselves with a single list.

Vectors of another length than the codebooks' are left out, as are null ids and vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.vectors import _centre_matrix, _clean, _matrix, _rank, _unit, assign_lists
from postmill.session import run_on_workers, stage

run_on_workers(__name__)

PARTS = 16
CODES = 256
TRAINED = 20_000
ROUNDS = 8
PACKET = 1 << 15  # codes; of whole vectors an eighth
QUERIES = 256


@dataclass
class Codebooks:
    """parts x codes x length of a stretch."""

    centres: np.ndarray

    @property
    def length(self) -> int:
        return self.centres.shape[0] * self.centres.shape[2]

    def code(self, unit: np.ndarray) -> np.ndarray:
        out = np.empty((len(unit), len(self.centres)), np.uint8)
        for part, (centres, own) in enumerate(zip(self.centres, self._split(unit), strict=True)):
            out[:, part] = np.argmin((centres**2).sum(axis=1) - 2 * own @ centres.T, axis=1)
        return out

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([centres[codes[:, part]] for part, centres in enumerate(self.centres)], axis=1)

    def _split(self, unit: np.ndarray) -> list[np.ndarray]:
        return np.split(unit.astype(np.float32), len(self.centres), axis=1)


def train_codebooks(df: DataFrame, id_col: str, vec_col: str, parts: int = PARTS, codes: int = CODES) -> Codebooks:
    """Codebooks of the most usual vector length, which ``parts`` must divide. At most TRAINED vectors are collected."""
    rows = _clean(df, id_col, vec_col)
    length = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()["n"]
    some = rows.filter(F.size("vec") == length).orderBy(F.xxhash64("id"), "id").limit(TRAINED).toArrow()
    unit = _unit(_matrix(some.column("vec").combine_chunks())).astype(np.float32)
    rng = np.random.default_rng(1)
    books = []
    for own in np.split(unit, parts, axis=1):
        centres = own[rng.choice(len(own), codes, replace=len(own) < codes)]
        for _ in range(ROUNDS):
            near = np.argmin((centres**2).sum(axis=1) - 2 * own @ centres.T, axis=1)
            sums = np.zeros((codes, own.shape[1]))
            np.add.at(sums, near, own)
            times = np.bincount(near, minlength=codes)[:, None]
            centres = np.where(times > 0, sums / np.maximum(times, 1), centres).astype(np.float32)
        books.append(centres)
    return Codebooks(np.stack(books))


def write_codes(df: DataFrame, id_col: str, vec_col: str, centres: DataFrame, books: Codebooks, path: str) -> None:
    """(id, code, list_id) of every row, partitioned by list."""
    rows = assign_lists(_clean(df, id_col, vec_col), "vec", centres)
    sent = df.sparkSession.sparkContext.broadcast(books)  # parts x codes x stretch floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = sent.value.code(_unit(_matrix(batch.column("vec"))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column("list_id")], names=["id", "code", "list_id"])

    coded = rows.mapInArrow(run, "id bigint, code binary, list_id int")
    coded.hint("rebalance", "list_id").write.partitionBy("list_id").parquet(path)


PACKETS = "list_id int, ids binary, rows binary"


def _packed(rows: DataFrame, size: int, body) -> DataFrame:
    """Rows (list_id, id, ...) of each list in packets of up to ``size``; ``body`` makes bytes of a batch's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, bytes]]] = {}

        def packet(list_id: int) -> pa.RecordBatch:
            parts = held.pop(list_id)
            ids = np.concatenate([p[0] for p in parts]).astype("<i8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([list_id], pa.int32()), pa.array([ids], pa.binary()), pa.array([b"".join(p[1] for p in parts)], pa.binary())], names=["list_id", "ids", "rows"])

        for batch in batches:
            lists, ids = batch.column("list_id").to_numpy(), batch.column("id").to_numpy()
            for list_id in np.unique(lists).tolist():
                own = np.flatnonzero(lists == list_id)
                for start in range(0, len(own), size):
                    some = own[start : start + size]
                    if sum(len(p[0]) for p in held.get(list_id, [])) + len(some) > size:
                        yield packet(list_id)
                    held.setdefault(list_id, []).append((ids[some], body(batch.take(pa.array(some)))))
        for list_id in list(held):
            yield packet(list_id)

    return rows.mapInArrow(run, PACKETS)


def _floats(batch: pa.RecordBatch) -> bytes:
    return _unit(_matrix(batch.column("vec"))).astype("<f8").tobytes()


def _codes(batch: pa.RecordBatch) -> bytes:
    return b"".join(batch.column("code").to_pylist())


FOUND = "query_id bigint, id bigint, similarity double"


def _compared(rows: DataFrame, queries: DataFrame, length: int, books: Codebooks | None, keep: int, deal: int) -> DataFrame:
    """The best ``keep`` of every packet of rows for each query of a packet of the same list."""
    sent = rows.sparkSession.sparkContext.broadcast(books)
    width = len(books.centres) if books else 8 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, body, q_ids, q_body in zip(*[batch.column(c) for c in ("ids", "rows", "q_ids", "q_rows")], strict=True):
                ids, q_ids = (np.frombuffer(x.as_buffer(), "<i8") for x in (ids, q_ids))
                raw = np.frombuffer(body.as_buffer(), np.uint8).reshape(len(ids), width)
                vectors = sent.value.vectors(raw) if books else raw.view("<f8")
                scores = np.round(np.frombuffer(q_body.as_buffer(), "<f8").reshape(len(q_ids), length) @ vectors.T, 12)
                edge = np.partition(scores, -keep, axis=1)[:, -keep] if len(ids) > keep else np.full(len(q_ids), -np.inf)
                best = [own[np.lexsort((ids[own], -row[own]))[:keep]] for row, own in ((r, np.flatnonzero(r >= e)) for r, e in zip(scores, edge, strict=True))]
                times = [len(b) for b in best]
                arrays = [np.repeat(q_ids, times), ids[np.concatenate(best)], np.concatenate([r[b] for r, b in zip(scores, best, strict=True)])]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["query_id", "id", "similarity"])

    # a list's packets are dealt over ``deal`` keys, so that no list is one task
    dealt = rows.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(deal)))
    asked = queries.select("list_id", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(deal - 1).cast("bigint"))).alias("slot"))
    return dealt.join(asked, ["list_id", "slot"]).select("ids", "rows", "q_ids", "q_rows").mapInArrow(run, FOUND)


def _probed(queries: DataFrame, centres: DataFrame, probes: int) -> DataFrame:
    """A row per query and list that it probes."""
    names, matrix = _centre_matrix(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = batch.filter(pa.array(pc.list_value_length(batch.column("vec")).to_numpy() == matrix.shape[1]))
            if fit.num_rows:
                near = np.argsort(-np.round(_unit(_matrix(fit.column("vec"))) @ matrix.T, 12), axis=1, kind="stable")[:, :probes]
                again = pa.array(np.repeat(np.arange(fit.num_rows), near.shape[1]))
                yield pa.RecordBatch.from_arrays([fit.column("id").take(again), fit.column("vec").take(again), pa.array(names[near].ravel())], names=["id", "vec", "list_id"])

    return queries.mapInArrow(run, "id bigint, vec array<double>, list_id int")


def _doubles(rows: DataFrame) -> DataFrame:
    return rows.withColumn("vec", F.col("vec").cast("array<double>"))


def _reranked(found: DataFrame, rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Candidates (query_id, id) with the similarity of the vectors themselves."""
    both = found.select("query_id", "id").distinct().join(rows, "id").join(queries.select(F.col("id").alias("query_id"), F.col("vec").alias("query")), "query_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = (_unit(_matrix(batch.column("vec"))) * _unit(_matrix(batch.column("query")))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(scores)], names=["query_id", "id", "similarity"])

    return both.select("query_id", "id", "vec", "query").mapInArrow(run, FOUND)


def search_lists(
    path: str, centres: DataFrame, books: Codebooks, df: DataFrame, id_col: str, vec_col: str, queries: DataFrame, query_id: str, query_vec: str,
    k: int, probes: int, candidates: int | None = None, deal: int = 4,
) -> DataFrame:
    """(query_id, id, similarity, rank): approximate top-k over written codes, similarities exact, ties by id.

    ``df`` holds the vectors. Of the lists of a query's ``probes`` nearest centres the best ``candidates``
    (20 times k) by their codes are compared exactly.
    """
    keep = candidates or 20 * k
    asked = stage(_doubles(_clean(queries, query_id, query_vec)).filter(F.size("vec") == books.length), "queries")
    table = df.sparkSession.read.schema("id bigint, code binary, list_id int").parquet(path)
    probed = _probed(asked, centres, probes).repartition("list_id", F.pmod(F.xxhash64("id"), F.lit(deal)))
    found = _compared(_packed(table, PACKET, _codes), _packed(probed, QUERIES, _floats), books.length, books, keep, deal)
    best = stage(_rank(found, keep), "candidates")
    return _rank(_reranked(best, _doubles(_clean(df, id_col, vec_col)), asked), k)


def search_exact(df: DataFrame, id_col: str, vec_col: str, queries: DataFrame, query_id: str, query_vec: str, k: int, length: int, deal: int = 16) -> DataFrame:
    """The same for all rows of vectors of one length, exact: (query_id, id, similarity, rank)."""
    one = F.lit(0).alias("list_id")
    rows, asked = (_doubles(_clean(d, i, v)).filter(F.size("vec") == length) for d, i, v in ((df, id_col, vec_col), (queries, query_id, query_vec)))
    asked = stage(asked, "queries")
    found = _compared(_packed(rows.select("*", one), PACKET // 8, _floats), _packed(asked.select("*", one), QUERIES, _floats), length, None, k, deal)
    return _rank(found, k)
