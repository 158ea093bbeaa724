"""Quality rules: log-likelihood ratio of hashed n-grams, target against corpus.

Words and pairs of words are hashed into ``BUCKETS`` buckets. One multinomial is counted over all
documents, one over trusted ones (labelled of good quality and not toxic). A document's score is
the mean, over its n-grams, of the log of the ratio of the two smoothed probabilities; it is kept
when that reaches a fixed threshold. Plain counts (repeated words, lines, symbols) stand beside.

Both multinomials and the scores cover every document, the trusted one every label. No list of
labelled ids is on the driver or in a task: labels meet the documents by a join.

That score counts every n-gram which trusted texts lack against a document, also where labels say
nothing of it (a small table, a language without labels). With ``evidence``, the default, the score is another:
per n-gram the log of the trusted share of the labelled texts that have it, times the share of the
expected labelled texts that there are, one at most; a document's own counts are left out. An n-gram
that only unlabelled texts have weighs nothing. It is fitted on all labelled documents, good and bad.

Null text counts as empty: no words, score 0, ``base_failed``. Null ``doc_id`` is kept and is
never trusted; so is a document with contradicting labels. Repeated rows are counted and judged
one by one. Without any trusted document no n-gram speaks against a text: all scores are 0.
Other columns are ignored by ``judge`` and handed through by ``keep_good``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.bpe import Cache
from postmill.llm.common import map_texts, pa_schema, slices, texts_of
from postmill.operators.joins import free_name, lookup

BUCKETS = 1 << 16
CACHED_WORDS = 200_000  # words whose hashes a worker remembers
SMOOTHING = 1.0
THRESHOLD = -0.35  # held out: good texts lie above -0.25, marked-up and shouted ones below -0.5
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
VERDICTS = (None, False, True)  # of labels: none, bad, good

_odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_top = np.uint64(64 - (BUCKETS.bit_length() - 1))


def _hashes(word: bytes) -> bytes:
    """Hashes of a word's letter runs, numbers and marks."""
    return np.array([zlib.crc32(t.encode()) for t in TOKEN.findall(word.decode().lower())], "<u4").tobytes()


_tokens = Cache(_hashes, "quality")


def buckets(words: list[bytes]) -> np.ndarray:
    """Buckets of all words and pairs of neighbours of a text."""
    h = np.frombuffer(b"".join(map(_tokens.__getitem__, words)), "<u4").astype(np.uint64)
    one = (h + np.uint64(1)) * _odd[0] >> _top
    two = (h[:-1] * _odd[1] + h[1:] * _odd[2]) * _odd[0] >> _top
    return np.concatenate([one, two]).astype(np.intp)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five which the text has more than once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    windows = sum(h[i : i + n] * _odd[i] for i in range(WINDOW))
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(windows, twice)
    covered = np.zeros(len(words), bool)
    for i in range(WINDOW):
        covered[i : i + n] |= starts
    return int(covered.sum())


def _split(text: str) -> list[bytes]:
    return text.encode().split()  # bytes split at the six ASCII spaces and nothing else


def verdicts(labels: DataFrame) -> DataFrame:
    """doc_id of labelled documents and whether all their labels call them good and not toxic."""
    found = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("worst"), F.max("toxic").alias("toxic")
    )
    good = (F.col("worst") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return found.filter("doc_id is not null").select("doc_id", F.coalesce(good, F.lit(False)).alias("good"))


def trusted(labels: DataFrame) -> DataFrame:
    """Ids of documents that all their labels call good and not toxic."""
    return verdicts(labels).filter("good").select("doc_id")


def ngram_counts(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Counts of every bucket in all texts, in those of ``ids`` (doc_id, good) that are good, and in all of ``ids``.

    The driver gets BUCKETS rows, however large the corpus.
    """
    schema = "bucket int, corpus long, target long, labelled long"
    types = pa_schema(docs.sparkSession, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((3, BUCKETS), np.int64)
        for batch in batches:
            for part, texts in slices(batch):
                _tokens.room(CACHED_WORDS)
                for text, good in zip(texts, part.column("good").to_pylist(), strict=True):
                    found = np.bincount(buckets(_split(text)), minlength=BUCKETS)
                    totals[0] += found
                    if good:
                        totals[1] += found
                    if good is not None:
                        totals[2] += found
        some = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *map(pa.array, totals[:, some])], schema=types)

    # dealt by key at every size: what is shuffled follows the texts
    marked = lookup(texts_of(docs), ids.hint("merge"), ["doc_id"]).select("text", "good")
    sums = [F.sum(c) for c in ("corpus", "target", "labelled")]
    rows = marked.mapInArrow(count, schema).groupBy("bucket").agg(*sums).toArrow()
    totals = np.zeros((3, BUCKETS))
    for i in range(3):
        totals[i, rows.column(0).to_numpy()] = rows.column(i + 1).to_numpy()
    return totals


class Ratios:
    """Mean log ratio of target to corpus."""

    def __init__(self, totals: np.ndarray):
        self.weights = np.zeros(BUCKETS)
        if totals[1].any():
            shares = (totals[:2] + SMOOTHING) / (totals[:2].sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
            self.weights = np.log(shares[1]) - np.log(shares[0])

    def __call__(self, found: np.ndarray, labelled: tuple = VERDICTS) -> list[float]:
        return [float(self.weights[found].mean()) if len(found) else 0.0] * len(labelled)


class Evidence:
    """Mean log share of trusted texts among labelled ones, as far as labels cover an n-gram."""

    def __init__(self, totals: np.ndarray):
        self.totals = totals
        self.rate = totals[2].sum() / max(1.0, totals[0].sum())

    def __call__(self, found: np.ndarray, labelled: tuple = VERDICTS) -> list[float]:
        """The score of a document under each of these verdicts on itself."""
        if not len(found) or not self.totals[1].any():
            return [0.0] * len(labelled)
        some, times = np.unique(found, return_counts=True)
        there = self.totals[:, some]
        with np.errstate(divide="ignore", invalid="ignore"):  # under a verdict that is not the document's
            return [self._score(there, times, good) for good in labelled]

    def _score(self, there: np.ndarray, times: np.ndarray, good: bool | None) -> float:
        corpus, target, labelled = there - times * np.array([[True], [bool(good)], [good is not None]])
        cover = np.minimum(1, labelled / np.maximum(1, corpus * self.rate))
        weights = cover * np.log((target + SMOOTHING) / (labelled + SMOOTHING))
        return float((weights * times).sum() / times.sum())


def scorer(docs: DataFrame, labels: DataFrame, evidence: bool) -> Ratios | Evidence:
    totals = ngram_counts(docs, verdicts(labels) if evidence else trusted(labels).withColumn("good", F.lit(True)))
    return Evidence(totals) if evidence else Ratios(totals)


def _rules(text: str, scores: Ratios | Evidence, labelled: tuple = VERDICTS) -> tuple:
    words = _split(text)
    n_words = len(words)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    n_repeat = repeated_words(words)
    return (
        n_words,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        n_repeat,
        n_words < 10 or 100 * n_repeat > 20 * n_words,
        scores(buckets(words), labelled),
    )


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, evidence: bool = True) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept."""
    scores = docs.sparkSession.sparkContext.broadcast(scorer(docs, labels, evidence))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    under = ["unlabelled", "bad", "fine"]

    def work(batch, texts):
        _tokens.room(CACHED_WORDS)
        rows = [_rules(t, scores.value) for t in texts]
        found = {n: [r[i] for r in rows] for i, n in enumerate(names)}
        return {"doc_id": batch.column("doc_id").to_pylist()} | found | {n: [r[-1][i] for r in rows] for i, n in enumerate(under)}

    schema = "doc_id long, " + ", ".join(f"{n} {'boolean' if n == 'base_failed' else 'long'}" for n in names)
    judged = map_texts(texts_of(docs), work, schema + "".join(f", {n} double" for n in under))
    # each document is scored for any label, so that its label meets these few columns and not the text
    score = F.when(F.col("good"), F.col("fine")).when(~F.col("good"), F.col("bad")).otherwise(F.col("unlabelled"))
    judged = lookup(judged, verdicts(labels), ["doc_id"]).withColumn("score", score)
    return judged.select("doc_id", *names[:-1], "score", "base_failed", (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, evidence: bool = True) -> DataFrame:
    """The documents that ``judge`` keeps, all their columns as they are."""
    scores = docs.sparkSession.sparkContext.broadcast(scorer(docs, labels, evidence))
    key, good = free_name("id", docs), free_name("good", docs)
    found = verdicts(labels).select(F.col("doc_id").alias(key), F.col("good").alias(good))
    marked = lookup(docs.withColumn(key, F.col("doc_id").cast("long")), found.hint("merge"), [key])
    marked = marked.select(*[f"`{c}`" for c in docs.columns], good)

    def kept(text: str, label: bool | None) -> bool:
        *_, failed, (score,) = _rules(text, scores.value, (label,))
        return not failed and score >= threshold

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                _tokens.room(CACHED_WORDS)
                labelled = part.column(part.num_columns - 1).to_pylist()
                rows = part.select(list(range(part.num_columns - 1)))
                yield rows.filter(pa.array(map(kept, texts, labelled), pa.bool_()))

    return marked.mapInArrow(keep, docs.schema)
