"""Toxicity of texts: boosted trees over dense features, with isotonic calibration.

Lexicon. Words and beginnings of words (``PREFIXES`` characters) that are far more frequent in toxic
training texts than in others, with the log of that ratio as their weight. Counts come from Spark;
LEXICON entries at most are kept, the clearest first.

Features of a text, none depending on its length but the number of words: how many words the lexicon
knows, their share, weight and closest cluster; second-person words and how many hits have one
nearby; capitals; punctuation and symbols; stretched letters, words broken by digits or symbols and
spelled-out words, also read with the usual letters in their place and looked up again.

Training. At most SAMPLE labelled ids, the first by a hash, of those that are not held out; of several labels of one id the highest counts. They lie in FOLDS folds: the
lexicon by which a training text is described comes from the other folds, and the
calibration is fitted to margins of trees that have not seen the text. Everything else covers
all rows: each text is scored by itself, whole.

Null and empty texts are scored like any other (no words). Null ids are scored and are not held out.
Repeated rows come back as often. With no labels of either kind to learn from, all scores are 0.5. An
empty table gives no rows. Only doc_id and text of the documents and doc_id and toxic of the labels
are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.boosted_trees import Calibration, Trees, fit_isotonic, fit_trees
from postmill.llm.common import map_texts, pa_schema, slices, texts_of
from postmill.session import stage

SAMPLE = 12_000  # labelled documents to learn from, at most
LEXICON = 4096  # entries, at most
FOLDS = 4
PREFIXES = range(3, 9)
LEAST_TEXTS = 3  # toxic texts that have an entry
LEAST_WEIGHT = 2.0
THRESHOLD = 0.7
KNOWN_WORDS = 1 << 19  # words that a worker remembers
WINDOW = 40  # words of a cluster of hits
NEARBY = 5  # words between a hit and a second person

# Second-person words of the corpus' languages.
SECOND_PERSON = frozenset(
    "you your yours yourself du dein deine deinen dich dir ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vuestro".split()
)
# Digits and symbols that stand for letters.
LETTERS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

WORD = re.compile(r"[^\W\d_]+")
# possessive, and only from the beginning of a stretch, so that no text takes more than one pass
BROKEN = re.compile(r"(?<![^\W_])(?<![@$!|])[0-9@$!|]*+[^\W\d_]++(?:[0-9@$!|*+_.-]++[^\W\d_]++)++")
SPELLED = re.compile(r"(?<!\w)\w(?:[ .*_-]\w(?!\w)){3,}")
STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
NO_LETTERS = re.compile(r"[\W\d_]+")

UPPER, LOWER, MARK, SYMBOL, OTHER_PUNCTUATION, REST = range(6)
_CLASS = np.full(256, REST, np.uint8)
for _code in range(256):
    _char = chr(_code)
    if _char.isupper():
        _CLASS[_code] = UPPER
    elif _char.islower():
        _CLASS[_code] = LOWER
    elif _char in "!?":
        _CLASS[_code] = MARK
    elif _char in "#*$%&|<>@^~":
        _CLASS[_code] = SYMBOL
    elif _char.isprintable() and not _char.isalnum() and not _char.isspace():
        _CLASS[_code] = OTHER_PUNCTUATION

FEATURES = (
    "words hits hit_share weight_share top_weight mean_weight different cluster broken_hits broken_share spelled_hits "
    "stretched_share you_share hits_near_you capitals capital_words marks symbols punctuation"
).split()


def terms(word: str) -> list[str]:
    """A word as a lexicon entry, and its beginnings (marked by a star)."""
    return [word, *[f"{word[:k]}*" for k in PREFIXES if k <= len(word)]]


@dataclass
class Lexicon:
    """Weights of words and beginnings; a word has the highest of its entries."""

    weights: dict[str, float]
    known: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            found = self.known[word] = max(self.weights.get(t, 0.0) for t in terms(word))
        return found

    def inside(self, letters: str) -> bool:
        """Whether an entry of 4 to 12 letters is somewhere in spelled-out letters, whose first and last may belong to other words."""
        return any(letters[i : i + k] in self.weights for i in range(len(letters) - 3) for k in range(4, 13))

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "known": {}}


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The values of FEATURES."""
    lower = text.lower()
    words = WORD.findall(lower)
    n = max(1, len(words))
    weights = [lexicon.weight(w) for w in words]
    hits = [i for i, w in enumerate(weights) if w]
    cluster, first = 0, 0
    for last, i in enumerate(hits):
        while i - hits[first] >= WINDOW:
            first += 1
        cluster = max(cluster, last - first + 1)
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if you and hits:
        at, places = np.searchsorted(you, hits), np.array([-(1 << 40), *you, 1 << 40])
        near = int((np.minimum(np.array(hits) - places[at], places[at + 1] - np.array(hits)) <= NEARBY).sum())
    broken = BROKEN.findall(lower)
    broken_hits = sum(lexicon.weight(NO_LETTERS.sub("", b.translate(LETTERS))) > 0 for b in broken)
    spelled_hits = sum(lexicon.inside(NO_LETTERS.sub("", s.translate(LETTERS))) for s in SPELLED.findall(lower))
    stretched = [w for w in words if STRETCHED.search(w)] if STRETCHED.search(lower) else []
    stretched_hits = sum(not lexicon.weight(w) and lexicon.weight(STRETCHED.sub(r"\1", w)) > 0 for w in stretched)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 255)
    upper, small, marks, symbols, others, _ = np.bincount(_CLASS[codes], minlength=REST + 1).tolist()
    chars = max(1, len(text))
    total = sum(weights)
    return [
        np.log1p(len(words)),
        np.log1p(len(hits)),
        len(hits) / n,
        total / n,
        max(weights, default=0.0),
        total / max(1, len(hits)),
        np.log1p(len({words[i] for i in hits})),
        cluster,
        np.log1p(broken_hits + stretched_hits),
        len(broken) / n,
        np.log1p(spelled_hits),
        len(stretched) / n,
        len(you) / n,
        near / n,
        upper / max(1, upper + small),
        sum(len(t) > 1 and t.isupper() for t in text.split()) / n if upper else 0.0,
        marks / chars,
        symbols / chars,
        others / chars,
    ]


@dataclass
class Model:
    """What scores a text; ``trees`` is None where there was nothing to learn from."""

    lexicon: Lexicon
    trees: Trees | None
    calibration: Calibration | None

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), 0.5)
        return self.calibration.score(self.trees.margin(np.array([features(t, self.lexicon) for t in texts]).reshape(-1, len(FEATURES))))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the decimal id mod 3 is 1: such rows' labels are not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic (0 or 1) and fold of the documents to learn from."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    known = labels.select(doc_id, F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic")).alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # SAMPLE rows of 16 bytes: a proven bound
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    return texts_of(docs).join(F.broadcast(picked), "doc_id").select("text", F.col("toxic"), fold.alias("fold"))


TERM_COUNTS = "term string, " + ", ".join(f"{kind}{k} long" for kind in ("clean", "toxic") for k in range(FOLDS))


def term_counts(texts: DataFrame) -> DataFrame:
    """How many toxic and other texts of each fold have a lexicon term."""
    types = pa_schema(texts.sparkSession, TERM_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in slices(batch):
                counts: dict[str, list[int]] = {}
                for text, toxic, fold in zip(found, part.column("toxic").to_pylist(), part.column("fold").to_pylist(), strict=True):
                    own = {t for w in set(WORD.findall(text.lower())) for t in terms(w)}
                    for term in own:
                        counts.setdefault(term, [0] * (2 * FOLDS))[FOLDS * (toxic > 0) + fold] += 1
                columns = list(zip(*counts.values(), strict=True)) or [()] * (2 * FOLDS)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip([list(counts), *columns], types, strict=True)], schema=types)

    names = TERM_COUNTS.replace(" string", "").replace(" long", "").split(", ")[1:]
    return texts.mapInArrow(run, TERM_COUNTS).groupBy("term").agg(*[F.sum(c).alias(c) for c in names])


def lexicons(texts: DataFrame) -> list[Lexicon]:
    """The lexicon without each fold, then that of all folds. The candidates are cut to a few times LEXICON."""
    sizes = Counter({(r["toxic"], r["fold"]): r["n"] for r in texts.groupBy(F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"), "fold").agg(F.count("*").alias("n")).collect()})
    many = [np.array([sizes[kind, k] for k in range(FOLDS)], float) for kind in (0, 1)]
    toxic, clean = (sum(F.col(f"{kind}{k}") for k in range(FOLDS)) for kind in ("toxic", "clean"))
    odds = F.log((toxic + 0.5) / float(many[1].sum() + 1)) - F.log((clean + 0.5) / float(many[0].sum() + 1))
    found = term_counts(texts).filter(toxic >= LEAST_TEXTS).withColumn("clear", odds * F.sqrt(toxic)).filter(odds >= LEAST_WEIGHT)
    rows = found.orderBy(F.desc("clear"), "term").limit(2 * LEXICON).toArrow()
    names, counts = rows.column("term").to_pylist(), [np.stack([rows.column(f"{kind}{k}").to_numpy() for k in range(FOLDS)], axis=1).astype(float) for kind in ("clean", "toxic")]
    out = []
    for left_out in [*range(FOLDS), None]:
        kept = np.array([k != left_out for k in range(FOLDS)])
        clean_n, toxic_n = (c[:, kept].sum(axis=1) for c in counts)
        weight = np.log((toxic_n + 0.5) / (many[1][kept].sum() + 1)) - np.log((clean_n + 0.5) / (many[0][kept].sum() + 1))
        clear = np.where((toxic_n >= LEAST_TEXTS) & (weight >= LEAST_WEIGHT), weight * np.sqrt(toxic_n), 0)
        best = [i for i in np.argsort(-clear, kind="stable")[:LEXICON] if clear[i] > 0]
        out.append(Lexicon({names[i]: float(weight[i]) for i in best}))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    texts = stage(sample(docs, labels), "toxicity-sample")
    found = lexicons(texts)
    schema = "toxic int, fold int, " + ", ".join(f"{f} double" for f in FEATURES)

    def work(part: pa.RecordBatch, rows: list[str]) -> dict[str, list]:
        toxic, fold = part.column("toxic").to_pylist(), part.column("fold").to_pylist()
        values = zip(*[features(t, found[k]) for t, k in zip(rows, fold, strict=True)], strict=True)
        return {"toxic": toxic, "fold": fold} | dict(zip(FEATURES, map(list, values), strict=True))

    # a row per sampled text: SAMPLE rows of 21 numbers, in an order of their own
    table = map_texts(texts, work, schema).toArrow()
    rows = np.stack([table.column(c).to_numpy().astype(float) for c in ("toxic", "fold", *FEATURES)], axis=1)
    rows = rows[np.lexsort(rows.T[::-1])]
    y, fold, x = (rows[:, 0] > 0).astype(float), rows[:, 1], rows[:, 2:]
    if not len(y) or y.min() == y.max():
        return Model(found[-1], None, None)
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        if (fold == k).any():
            margin[fold == k] = fit_trees(x[fold != k], y[fold != k]).margin(x[fold == k])
    return Model(found[-1], fit_trees(x, y), fit_isotonic(margin, y))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from THRESHOLD on) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def work(part: pa.RecordBatch, rows: list[str]) -> dict[str, list]:
        return {"doc_id": part.column("doc_id"), "score": model.value.scores(rows)}

    scored = map_texts(texts_of(docs), work, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
