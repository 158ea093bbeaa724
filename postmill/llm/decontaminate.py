"""Benchmark items inside documents, found by spaced seeds.

A seed is a fixed mask over word positions: the words at its positions are hashed together, the
others are ignored. The four masks below hit every run of thirteen aligned words of which at most
three were replaced (all cases were tried). Hashes of documents are joined with those of the
benchmark, and around every hit the two texts are compared word by word on the hit's diagonal: a
leak is a window of WINDOW words of which SAME agree, or, for an item of SHORTEST to WINDOW - 1
words, the whole item, where from FORGIVING words on one may be replaced (the masks hit these too).
Items of fewer words are too short to prove anything and never leak.

Where a text and an item repeat a seed so often that its hits outnumber their diagonals, all their
diagonals are compared instead, so repeated words cost words times words at most.

The benchmark is taken in blocks of some BLOCK_WORDS words, each sent to all tasks in a pass over
the documents; a block has a fixed size, the number of blocks grows with the benchmark. Documents
are not shuffled, and a hot source or a common phrase concerns single tasks only.

Words are lower-cased (ASCII) runs without ASCII space. Null texts and texts without words neither
leak nor are leaked into; null item ids and document ids are kept. Repeated rows are judged one by one
(``leaks`` names a document id once per item). Other columns are ignored or, by
``without_leaks``, handed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import pa_schema, slices, texts_of
from postmill.session import ship_package

MASKS = [(0, 1, 3, 6, 7), (0, 1, 3, 4, 5), (0, 1, 2, 8, 9), (0, 1, 2, 3, 4)]
WINDOW = 13
SAME = 10
SHORTEST = 5
FORGIVING = 8
BLOCK_WORDS = 1 << 18
LEAKS = "doc_id long, item_id long, doc_word long, item_word long, n_words long, n_same long"

_odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_filter_bits = np.uint64(64 - 20)


def words_of(text: str) -> np.ndarray:
    """Hashes of the words of a text."""
    words = text.encode().lower().split()
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the mask's words at every place where it fits."""
    n = max(0, len(words) - mask[-1])
    total = np.full(n, mask[-1] * 31 + mask[2], np.uint64)
    for place, factor in zip(mask, _odd, strict=True):
        total += words[place : place + n] * factor
    return (total ^ (total >> np.uint64(29))) * _odd[4]


@dataclass
class Block:
    """Items of the benchmark, their words one after the other, and their sorted seeds."""

    item_ids: list
    words: np.ndarray
    starts: np.ndarray  # of each item in ``words``, and the end
    seeds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # by mask: filter, hashes, places

    @staticmethod
    def of(item_ids: list, texts: list[str]) -> Block:
        words = [words_of(t) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        found = []
        for mask in MASKS:
            hashes = [seeds(w, mask) for w in words]
            places = [s + np.arange(len(h)) for s, h in zip(starts, hashes, strict=False)]
            joined, at = np.concatenate([*hashes, np.empty(0, np.uint64)]), np.concatenate([*places, np.empty(0, np.int64)])
            order = np.argsort(joined, kind="stable")
            joined = joined[order]
            known = np.zeros(1 << 20, bool)
            known[(joined >> _filter_bits).astype(np.intp)] = True
            found.append((known, joined, at[order].astype(np.int64)))
        return Block(item_ids, np.concatenate([*words, np.empty(0, np.uint64)]), starts, found)

    def search(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """The best leak of each item: item number, word of the text, of the item, words, same words."""
        words = words_of(text)
        hits = [np.empty((0, 2), np.int64)]
        everywhere: set[int] = set()  # items that are compared at every shift
        for mask, (known, hashes, places) in zip(MASKS, self.seeds, strict=True):
            own = seeds(words, mask)
            at = np.flatnonzero(known[(own >> _filter_bits).astype(np.intp)])
            if len(at):
                low, high = np.searchsorted(hashes, own[at]), np.searchsorted(hashes, own[at], "right")
                hot, again = self.repeated(len(words), own[at], places, low, high)
                everywhere |= hot
                times = np.where(again, 0, high - low)
                if times.any():
                    source = np.repeat(at, times)
                    nth = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
                    target = places[np.repeat(low, times) + nth]
                    item = np.searchsorted(self.starts, target, "right") - 1
                    hits.append(np.unique(np.stack([item, source - (target - self.starts[item])], axis=1), axis=0))
                for seed in np.unique(own[at][again]):  # what a repeated seed has in other items
                    source = at[own[at] == seed]
                    target = places[np.searchsorted(hashes, seed) : np.searchsorted(hashes, seed, "right")]
                    item = np.searchsorted(self.starts, target, "right") - 1
                    cool = ~np.isin(item, list(everywhere))
                    item, inside = item[cool], target[cool] - self.starts[item[cool]]
                    shifts = (source[:, None] - inside[None, :]).ravel()
                    hits.append(np.unique(np.stack([np.tile(item, len(source)), shifts], axis=1), axis=0))
        for item in everywhere:
            shifts = np.arange(1 - (self.starts[item + 1] - self.starts[item]), len(words))
            hits.append(np.stack([np.full(len(shifts), item), shifts], axis=1))
        best: dict[int, tuple] = {}
        for item, shift in np.unique(np.concatenate(hits), axis=0).tolist():
            own = self.words[self.starts[item] : self.starts[item + 1]]
            if item in best and best[item][0] == len(own):  # no later shift can be better
                continue
            first, last = max(0, -shift), min(len(own), len(words) - shift)
            same = own[first:last] == words[first + shift : last + shift]
            leak = overlap(same, len(own))
            if leak:
                start, size, equal = leak
                found = (equal, size, -(first + shift + start), -(first + start))
                if item not in best or found > best[item]:
                    best[item] = found
        return [(item, -doc, -own, size, equal) for item, (equal, size, doc, own) in sorted(best.items())]


    def repeated(self, n_words: int, own: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[set[int], np.ndarray]:
        """Items that have more hits of one seed than diagonals with the text, and which of the
        text's seeds these are."""
        hot: set[int] = set()
        again = np.zeros(len(own), bool)
        _, first, which, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
        for k in np.flatnonzero(times * (high - low)[first] > n_words):
            item = np.searchsorted(self.starts, places[low[first[k]] : high[first[k]]], "right") - 1
            items, counts = np.unique(item, return_counts=True)
            found = items[counts * times[k] > n_words + self.starts[items + 1] - self.starts[items]]
            if len(found):
                hot.update(found.tolist())
                again |= which == k
        return hot, again


def overlap(same: np.ndarray, item_words: int) -> tuple[int, int, int] | None:
    """Start, length and equal words of what leaks on a diagonal, from the first to the last window."""
    if item_words < WINDOW:
        if item_words < SHORTEST or len(same) < item_words:
            return None
        equal = int(same.sum())
        return (0, item_words, equal) if equal >= item_words - (item_words >= FORGIVING) else None
    if len(same) < WINDOW:
        return None
    sums = np.concatenate([[0], np.cumsum(same)])
    windows = np.flatnonzero(sums[WINDOW:] - sums[:-WINDOW] >= SAME)
    if not len(windows):
        return None
    start, end = int(windows[0]), int(windows[-1]) + WINDOW
    return start, end - start, int(sums[end] - sums[start])


def blocks_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items, dealt by a hash into blocks of about so many words, one block at a time."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).distinct()
    n_words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    n_blocks = -(-n_words // block_words)
    for number in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == number).toArrow()
        rows = rows.sort_by("item_id")
        yield Block.of(rows.column("item_id").to_pylist(), rows.column("text").to_pylist())


def leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id and the overlap (word numbers, length, equal words), best one per pair."""
    spark = docs.sparkSession
    types = pa_schema(spark, LEAKS)
    found = spark.createDataFrame([], LEAKS)

    def search(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for part, texts in slices(batch):
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                        rows += [(doc_id, block.value.item_ids[i], *rest) for i, *rest in block.value.search(text)]
                columns = list(zip(*rows, strict=True)) or [[] for _ in types]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

        return run

    for block in blocks_of(benchmark, block_words):
        found = found.unionByName(texts_of(docs).mapInArrow(search(spark.sparkContext.broadcast(block)), LEAKS))
    best = F.max_by(F.struct("doc_word", "item_word", "n_words", "n_same"), F.struct("n_same", "n_words", -F.col("doc_word"), -F.col("item_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents in which no item leaks, all their columns as they are."""
    ship_package(docs.sparkSession)

    def drop(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, texts in slices(batch):
                    yield part.filter(pa.array([not block.value.search(t) for t in texts], pa.bool_()))

        return run

    for block in blocks_of(benchmark, block_words):
        docs = docs.mapInArrow(drop(docs.sparkSession.sparkContext.broadcast(block)), docs.schema)
    return docs
