"""Quality rules against plain counting, and the verdicts on held-out labels."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import quality_rules as rules
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def judged(df):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return [tuple(r[n] for n in names) for r in df.orderBy("doc_id").collect()]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality long, toxic long").withColumn("text", F.lit("clash"))


def test_counts_are_those_of_plain_rules(spark, docs_of):
    r = random.Random(5)
    parts = ["a", "b", "the", "é", "#", "*x", " ", "  ", "\n", "\n\n", "\t", "\xa0", "\x85", "a b c d e f ", "日本 "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(400)]
    got = judged(rules.judge(docs_of(list(enumerate(texts))), labels_of(spark, [])))
    assert got == [plain(t) for t in texts]


def test_odd_rows(spark, docs_of):
    good = "some plain words of a text that go on and on for a while without end"
    rows = [(1, None), (2, ""), (None, good), (3, good), (3, good), (4, "word " * 50_000), (5, good.replace(" ", " ### "))]
    docs, labels = docs_of(rows), labels_of(spark, [(3, 1, 0), (3, 1, None), (1, 1, 0), (4, 0, 0), (None, 1, 0), (77, 1, 0)])
    got = {(r.doc_id, r.n_words): r for r in rules.judge(docs, labels).collect()}
    assert got[1, 0].base_failed and got[1, 0].score == 0 and not got[2, 0].kept
    n = len(good.split())
    assert got[3, n].kept and got[None, n].kept and not got[4, 50_000].kept
    kept = rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r.text for r in kept.filter("doc_id = 3").collect()) == [good, good]
    assert rules.judge(docs_of([]), labels).count() == 0
    assert {r.score for r in rules.judge(docs, labels_of(spark, [])).collect()} == {0.0}


def test_scores_are_log_likelihood_ratios(spark):
    """The same scores counted with dictionaries."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    good = set(labels[(labels.quality == 1) & (labels.toxic == 0)].doc_id)
    mask, odd = (1 << 64) - 1, [int(x) for x in rules._odd]

    def grams(text):
        h = [zlib.crc32(t.encode()) for t in rules.TOKEN.findall(text.lower())]
        one = [((x + 1) * odd[0] & mask) >> 48 for x in h]
        return one + [(((a * odd[1] + b * odd[2]) & mask) * odd[0] & mask) >> 48 for a, b in zip(h, h[1:])]  # noqa: B905

    corpus, target, own = Counter(), Counter(), {}
    for doc_id, text in docs:
        own[doc_id] = grams(text)
        corpus.update(own[doc_id])
        if doc_id in good:
            target.update(own[doc_id])
    n, m = (sum(c.values()) + rules.BUCKETS for c in (corpus, target))
    for r in rules.judge(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")), evidence=False).collect():
        ratios = [np.log((target[g] + 1) / m) - np.log((corpus[g] + 1) / n) for g in own[r.doc_id]]
        assert r.score == pytest.approx(np.mean(ratios) if ratios else 0, abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= rules.THRESHOLD)


def test_verdicts_on_held_out_labels(spark):
    """Fitted on labels of even ids, judged on odd ones."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = rules.judge(docs, labels.filter("doc_id % 2 = 0")).toPandas().set_index("doc_id")
    held = labels.filter("doc_id % 2 = 1").toPandas().set_index("doc_id").join(kept, how="inner")
    long = held[held.n_words >= 10]
    assert long[long.quality == 1].kept.mean() > 0.99
    assert long[long.quality == 0].kept.mean() < 0.1


def clean_and_rejected(spark, sf, keep_label, evidence=True):
    """Verdicts on unlabelled texts without symbols, and the number of those with many that are kept."""
    path = f"/root/testdata/{sf}"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    labels = labels.join(docs.select("doc_id", "lang"), "doc_id").filter(keep_label)
    rows = rules.judge(docs, labels, evidence=evidence).join(docs.select("doc_id", "lang"), "doc_id")
    rows = rows.join(labels.select("doc_id"), "doc_id", "left_anti").filter("not base_failed").toPandas()
    marked = rows.n_symbols > 0.2 * rows.n_words
    return rows[~marked], rows[marked]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_evidence_keeps_clean_texts_at_every_size(spark, sf):
    clean, marked = clean_and_rejected(spark, sf, "true")
    assert clean.kept.mean() > 0.98 and marked.kept.mean() < 0.2


def test_evidence_keeps_a_language_without_trusted_texts(spark):
    skewed = "lang <> 'es' or quality = 0 or toxic = 1"
    clean, marked = clean_and_rejected(spark, "sf0.1", skewed)
    assert clean[clean.lang == "es"].kept.mean() > 0.98 and marked.kept.mean() < 0.02


def test_evidence_of_odd_rows(spark, docs_of):
    good = "some plain words of a text that go on and on for a while without end"
    docs = docs_of([(1, None), (None, good), (3, good), (3, good), (4, good.replace(" ", " ### "))])
    labels = labels_of(spark, [(3, 1, 0), (None, 0, 0), (5, 0, 0), (6, None, None)])
    got = rules.judge(docs, labels, evidence=True).collect()
    assert sorted(r.text for r in rules.keep_good(docs, labels, evidence=True).collect()) == sorted([good] * 3 + [good.replace(" ", " ### ")])
    assert len(got) == 5 and {r.score for r in rules.judge(docs, labels_of(spark, []), evidence=True).collect()} == {0.0}


@pytest.mark.parametrize("evidence", [True, False])
def test_every_label_counts(spark, docs_of, evidence):
    """Labels of ids that no document has change nothing, however many there are."""
    r = random.Random(9)
    texts = [" ".join(r.choice(["ab", "cd", "ef", "gh", "#", "*"]) for _ in range(30)) for _ in range(60)]
    docs = docs_of(list(enumerate(texts)))
    labels = spark.range(60_000).selectExpr("id as doc_id", "cast(id % 4 > 0 as long) as quality", "0L as toxic").filter("doc_id not between 50 and 59")
    few, all_ = (rules.judge(docs, x, evidence=evidence).orderBy("doc_id").collect() for x in (labels.filter("doc_id < 50"), labels))
    assert few == all_ and len({x.score for x in all_}) > 50
    kept = rules.keep_good(docs, labels, evidence=evidence)
    assert sorted(x.doc_id for x in kept.collect()) == [x.doc_id for x in all_ if x.kept]


def test_labels_meet_texts_by_a_join_that_can_be_split(spark, docs_of):
    """Both ways to the verdicts agree, with ids that repeat and are null and columns that clash."""
    docs = docs_of([(i % 7 or None, "some plain words of a text that go on" + i % 2 * " ### and so on") for i in range(56)])
    docs = docs.withColumns({n: F.lit("clash") for n in ("id", "good", "_slot")})
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(1, 5)] + [(None, 0, 0)])
    rows = rules.judge(docs, labels), rules.keep_good(docs, labels)
    plan = rows[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and rows[1].schema == docs.schema
    kept = Counter((r.doc_id, r.text) for r in rows[1].collect())
    judged = {(r.doc_id, r.n_words): r.kept for r in rows[0].collect()}
    wanted = Counter((r.doc_id, r.text) for r in docs.collect() if judged[r.doc_id, len(r.text.split())])
    assert len(judged) == 14 and kept == wanted and not all(judged.values())
