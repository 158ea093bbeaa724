"""The pipeline stage by stage against plain versions."""

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import leaked
from tests.llm.test_shingle_join import plain


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = docs.toPandas()
        docs = step(spark, docs, SF)
        assert docs.schema == spark.read.parquet(f"{SF}/documents.parquet").schema
        after = docs.toPandas()
        kept[name] = (before, after)
        docs = spark.createDataFrame(after, docs.schema)
    before, after = kept["quality"]
    judged = {r.doc_id: r.kept for r in __spark_entry__.queries()["op6_quality_rules"](spark, SF).collect()}
    assert set(after.doc_id) == {d for d in before.doc_id if judged[d]}
    before, after = kept["near_duplicates"]
    groups = plain(list(zip(before.doc_id.tolist(), before.text, strict=True)))
    assert sorted(after.doc_id) == sorted(d for d, n, low in groups if d == low)
    before, after = kept["decontamination"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas().text
    grams = [{tuple(w[k : k + 2]) for w in [i.lower().split()] for k in range(len(w))} for i in items]
    for doc_id, text in zip(before.doc_id, before.text, strict=True):
        words = text.lower().split()
        own = {tuple(words[k : k + 2]) for k in range(len(words))}
        leak = any(g & own and leaked(text, i) for g, i in zip(grams, items, strict=True))
        assert (doc_id in set(after.doc_id)) == (not leak)
    before, after = kept["mixing"]
    size = lambda df: sum(len(t.split()) for t in df.text)
    assert abs(size(after) - 1.5 * size(before)) < 0.1 * size(before)
    assert after.doc_id.value_counts().max() <= 2
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas().sort_values("start")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = after.sort_values("doc_id")
    assert got.doc_id.tolist() == want.doc_id.tolist()
    assert got.n_tokens.tolist() == [len(library.encode(t, add_special_tokens=False).ids) + 1 for t in want.text]


def test_run_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"](spark, SF).count() > 50
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()
