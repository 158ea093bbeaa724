"""Toxicity: held-out accuracy, features, trees and calibration."""

import zlib

import numpy as np
import pytest

from postmill.llm.boosted_trees import fit_isotonic, fit_trees
from postmill.llm.common import table
from postmill.llm.queries import QUERIES
from postmill.llm.toxicity import FEATURES, THRESHOLD, Lexicon, features, sample, toxicity


def area(pos, neg):
    return (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2


@pytest.mark.parametrize("sf, least, recall", [("sf0.01", 0.9, 0.8), ("sf0.1", 0.97, 0.9)])
def test_held_out_accuracy(spark, sf, least, recall):
    folder = f"/root/testdata/{sf}"
    got = QUERIES["op13_toxicity"](spark, folder).toPandas()
    assert len(got) == table(spark, folder, "documents").count() and list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert got.score.between(0, 1).all() and ((got.score >= THRESHOLD) == (got.predicted == 1)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(got.doc_id, got.held_out, strict=True))
    known = got.merge(table(spark, folder, "labels").toPandas(), on="doc_id")
    known = known[known.held_out]
    pos, neg = (known.score[known.toxic == t].to_numpy() for t in (1, 0))
    assert area(pos, neg) >= least
    assert (pos >= THRESHOLD).mean() >= recall and (neg >= THRESHOLD).mean() <= 0.04


def test_held_out_labels_are_not_learned_from(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels").toPandas()
    held = labels.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)
    turned = labels.assign(toxic=labels.toxic.where(~held, 1 - labels.toxic))
    scores = [toxicity(docs, spark.createDataFrame(x)).toPandas().sort_values(["doc_id", "score"]).score.to_numpy() for x in (labels, turned)]
    assert np.array_equal(*scores)


def named(text, lexicon):
    return dict(zip(FEATURES, features(text, lexicon), strict=True))


def test_features():
    lexicon = Lexicon({"moron": 5.0, "achl*": 3.0})
    x = named("You MORON, you achlich thing!!", lexicon)
    assert x["hit_share"] == pytest.approx(2 / 5) and x["top_weight"] == 5.0 and x["hits_near_you"] == pytest.approx(2 / 5)
    assert x["capital_words"] == pytest.approx(1 / 5) and x["cluster"] == 2 and x["marks"] == pytest.approx(2 / 30)
    for text in ("a m0r0n here", "a m*o*r*o*n here", "a m-o-r-o-n here", "a mooooron here"):
        assert named(text, lexicon)["broken_hits"] > 0, text
    assert named("a m o r o n here", lexicon)["spelled_hits"] > 0
    assert all(v == 0 for v in features("", lexicon))
    assert named("plain prose without any of it", lexicon)["hits"] == 0


def test_long_words_and_texts_stay_linear():
    lexicon = Lexicon({"moron": 5.0})
    for text in ("a" * 300_000, "a-" * 150_000, "a " * 150_000, "!" * 300_000, "a1" * 150_000 + "_"):
        assert len(features(text, lexicon)) == len(FEATURES)


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = fit_trees(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    flat = fit_trees(np.zeros((50, 2)), np.r_[np.ones(10), np.zeros(40)])
    assert np.ptp(flat.margin(np.zeros((3, 2)))) == 0


def test_calibration_does_not_fall_and_keeps_order():
    rng = np.random.default_rng(4)
    margin = rng.normal(size=2000)
    y = (rng.uniform(size=2000) < 1 / (1 + np.exp(-2 * margin))).astype(float)
    calibration = fit_isotonic(margin, y)
    points = np.linspace(-5, 5, 400)
    scores = calibration.score(points)
    assert (np.diff(scores) > 0).all() and scores.min() >= 0 and scores.max() <= 1
    assert np.abs(scores - 1 / (1 + np.exp(-2 * points)))[(points > -2) & (points < 2)].max() < 0.15


def test_odd_rows(spark, docs_of):
    texts = [(None, "you moron"), (1, None), (2, ""), (3, "w " * 60_000), (3, "w " * 60_000), (4, "fine words")]
    docs = docs_of(texts).withColumnsRenamed({"gone": "toxic", "cut": "fold", "size": "score"})
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in toxicity(docs, none).collect()} == {(0.5, 0)}
    rows = [(i, None, int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1), (7, 1, None), (8, 0, 1), (8, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    more = docs_of(texts + [(i, ("you moron " if i % 4 == 0 else "you people ") + f"word{i} said so") for i in range(10, 200)])
    got = toxicity(more, labels)
    assert got.count() == len(texts) + 190 and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert not got.filter("doc_id is null").first().held_out
    picked = {r.doc_id: r.predicted for r in got.filter("held_out and doc_id >= 10").collect()}
    assert all(predicted == (doc_id % 4 == 0) for doc_id, predicted in picked.items())
    assert toxicity(more.limit(0), labels).collect() == []
    assert sample(more, labels).count() > 100
