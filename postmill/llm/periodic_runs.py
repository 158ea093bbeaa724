"""Periodic runs of words: stretches that repeat their first q words at least four times.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
at least ``max(LEAST_WORDS, LEAST_TIMES * q)`` words that neither neighbouring word extends.

Enhanced suffix array. The texts of a slice are one array of word numbers, numbers of their own for
each text and one more at its end, so no match leaves a text. Prefix doubling sorts the suffixes and
keeps the ranks of every doubling; the longest common prefixes of neighbours come from those ranks.

Branching tandem test. Two suffixes q apart whose common prefix has exactly q words are the last
square of a run. They lie in different children of the LCP interval of depth q, so each interval's
smaller children look up where the suffixes q before and q after theirs stand (n log n look-ups).
Intervals are split at each of their minima in turn, which takes every child but the largest once
and needs no tree; an interval with fewer suffixes than a run has periods is passed over.

Runs. A square is rotated to the left as far as the words agree, in steps of the doublings. What
ends at the same places is one run; its smallest period counts.

A text is one row and is handled in one piece; memory is about 200 bytes for each word of the
longest. Null and empty texts have no words and no runs. Null ids are kept, and repeated rows come
back as often. Columns other than doc_id and text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import pa_schema, slices, texts_of

LEAST_WORDS = 6
LEAST_TIMES = 4
LOOK_UPS = 1 << 20  # that one step handles together
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, a new number after each text, and where each text begins."""
    numbers: list[int] = []
    starts, base = [], 0
    for words in texts:
        own: dict[bytes, int] = {}
        starts.append(len(numbers))
        numbers += [own.setdefault(w, base + len(own)) for w in words]
        base += len(own)
        numbers.append(base)
        base += 1
    return np.array(numbers, np.int64), np.array(starts, np.int64)


def suffix_array(numbers: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted suffixes, and for each k the rank of every suffix by its first 2^k words.

    Equal ranks mean equal words; a rank is the place of the first suffix that has it. Only
    suffixes that are still equal to another are sorted again.
    """
    n = len(numbers)
    times = np.bincount(numbers)
    rank = (np.cumsum(times) - times)[numbers]
    order = np.argsort(rank, kind="stable")
    ranks, width = [rank.astype(np.int32)], 1
    active = order[times[numbers[order]] > 1]
    while len(active):
        key = rank[active] * n + rank[active + width]
        place = np.argsort(key, kind="stable")
        active, key = active[place], key[place]
        at, old = np.arange(len(active)), rank[active]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        slot = old + at - np.maximum.accumulate(np.where(group, at, 0))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        order[slot] = active
        rank[active] = slot[np.maximum.accumulate(np.where(new, at, 0))]
        ranks.append(rank.astype(np.int32))
        active = active[~(new & np.append(new[1:], True))]
        width *= 2
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each sorted suffix has in common with the one before it (0 for the first)."""
    a, b = order[:-1].copy(), order[1:].copy()
    found = np.zeros(len(order), np.int64)
    for k in reversed(range(len(ranks) - 1)):
        same = (ranks[k][a] == ranks[k][b]).astype(np.int64) << k
        found[1:] += same
        a += same
        b += same
    return found


def splits(lcp: np.ndarray) -> np.ndarray:
    """Rows (left, middle, right, depth): the child [left, middle) of an LCP interval and the
    children [middle, right) after it. Too small ones are left out."""
    found, stack = [], [(0, 0, 0)]  # place, its value, where its left part begins
    values = lcp.tolist()
    values.append(0)
    for m, v in enumerate(values):
        while stack[-1][1] > v:
            place, depth, left = stack.pop()
            if m - left >= (LEAST_TIMES if depth > 1 else LEAST_WORDS):
                found.append((left, place, m, depth))
        if v:
            stack.append((m, v, stack[-1][0]))
        else:
            stack = [(m, 0, 0)]
    return np.array(found, np.int64).reshape(-1, 4)


def last_squares(order: np.ndarray, place: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and root length of the squares whose two halves are followed by different words."""
    left, middle, right, depth = parts.T
    small = middle - left <= right - middle
    first, size = np.where(small, left, middle), np.where(small, middle - left, right - middle)
    other, other_end = np.where(small, middle, left), np.where(small, right, middle)
    ends = np.cumsum(size)
    starts, roots = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin in range(0, int(ends[-1]) if len(ends) else 0, LOOK_UPS):
        flat = np.arange(begin, min(begin + LOOK_UPS, int(ends[-1])))
        part = np.searchsorted(ends, flat, side="right")
        i, q = order[first[part] + flat - (ends[part] - size[part])], depth[part]
        for j in (i + q, i - q):
            there = place[np.clip(j, 0, len(place) - 1)]
            hit = (j >= 0) & (j < len(place)) & (there >= other[part]) & (there < other_end[part])
            starts.append(np.minimum(i, j)[hit])
            roots.append(q[hit])
    return np.concatenate(starts), np.concatenate(roots)


def rotated(start: np.ndarray, root: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """How many words each square can be moved to the left."""
    at = start.copy()
    for k in reversed(range(len(ranks) - 1)):
        back = at - (1 << k)
        inside = back >= 0
        back = np.maximum(back, 0)
        same = inside & (ranks[k][back] == ranks[k][back + root])
        at = np.where(same, back, at)
    return start - at


def find_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of every text, by start, then period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    numbers, starts = word_numbers(texts)
    order, ranks = suffix_array(numbers)
    square, root = last_squares(order, ranks[-1], splits(common_prefixes(order, ranks)))
    begin = square - rotated(square, root, ranks)
    length = square + 2 * root - begin
    kept = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * root)
    rows = sorted(zip(begin[kept].tolist(), length[kept].tolist(), root[kept].tolist(), strict=True))
    smallest: dict[tuple[int, int], int] = {}
    for a, n, q in rows:
        smallest.setdefault((a, n), q)
    for (a, n), q in sorted(smallest.items(), key=lambda x: (x[0][0], x[1])):
        text = int(np.searchsorted(starts, a, side="right")) - 1
        found[text].append((a - int(starts[text]), n, q))
    return found


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(gone).tolist(), strict=False) if not n]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (by start, then period), collapsed (the words without repeats, one space apart)."""
    types = pa_schema(docs.sparkSession, RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                words = [t.encode().split() for t in texts]  # of bytes: at ASCII spaces only
                runs = find_runs(words)
                collapsed = [b" ".join(without_repeats(w, r)).decode() for w, r in zip(words, runs, strict=True)]
                listed = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
                arrays = [part.column("doc_id"), pa.array(listed, types.field("runs").type), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, schema=types)

    return texts_of(docs).mapInArrow(run, RUNS)


def planted(text: Column, doc_id: Column) -> Column:
    """The words of a tenth of the texts from some word on replaced by repeats of a few of them.

    h = crc32 of the decimal id, g = h div 10. Where h mod 10 is 0, every word i >= a becomes word
    a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Other texts, and those
    with a null id or without words, stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    parts = F.struct(words.alias("w"), g.alias("g"), (g % F.greatest(F.size(words), F.lit(1))).cast("int").alias("a"))

    def repeats(x: Column) -> Column:
        w, a = x["w"], x["a"]
        p = F.lit(1) + F.floor((F.size(w) - a) / (F.lit(3) + x["g"] % 8)).cast("int")
        y = F.struct(w.alias("w"), a.alias("a"), p.alias("p"))
        of = lambda y: F.transform(
            y["w"], lambda word, i: F.when(i < y["a"], word).otherwise(F.get(y["w"], y["a"] + (i - y["a"]) % y["p"]))
        )
        return F.array_join(F.element_at(F.transform(F.array(y), of), 1), " ")

    # the struct goes through an array of one, so that the words are found once
    changed = F.element_at(F.transform(F.array(parts), repeats), 1)
    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), changed).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one (ties: smallest start, then period) and digests."""
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", F.array_min(order))
    length = -F.col("best.n")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
