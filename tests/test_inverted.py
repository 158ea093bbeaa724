"""Indexed search against the scan, and what it reads."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postmill.operators import filters as FL
from postmill.operators import inverted as IX
from postmill.session import work_dir
from tests.oracle import scan_metrics

WORDS = ["engineer", "years", "ünï", "data", "zz", "a.b", "x%y", "İstanbul", "ß", "manager"]


@pytest.fixture(scope="module")
def postings(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        words = [rng.choice(WORDS) + rng.choice(["", "s", "-x"]) for _ in range(rng.randint(0, 5))]
        rows.append((i, None if i % 11 == 0 else " ".join(words), None if i % 13 == 0 else "x" * rng.randint(0, 3) + rng.choice(WORDS), rng.choice(["Berlin", "London", "", None]), "clash"))
    return spark.createDataFrame(rows, "seq bigint, title string, description string, location string, term string")


def test_search_is_the_scan(spark, postings):
    path, places = work_dir(spark, "index"), work_dir(spark, "places")
    IX.write_index(postings.filter("seq < 300"), "seq", IX.trigrams(IX.search_text()), path, 8)
    IX.write_index(postings, "seq", IX.trigrams(F.lower("location")), places, 8)
    IX.extend_index(postings.filter("seq >= 250"), "seq", IX.trigrams(IX.search_text()), path)
    for keywords, place in [("Engineer", ""), ("engineer years", "berlin"), ("zz", ""), ("zz data", "on"), ("ünï", ""), ("x%y", ""), ("xengi", "lond"), ("missing", ""), ("", ""), ("s-x", ""), ("a.b x%y", ""), ("İstanbul", "")]:
        want = [r.seq for r in FL.search(postings, keywords, place, None).orderBy("seq").collect()]
        got = [r.seq for r in IX.search_indexed(postings, "seq", path, keywords, place, None, places).orderBy("seq").collect()]
        assert got == want, (keywords, place)
    assert [r.seq for r in IX.search_indexed(postings, "seq", path, "engineer", "", 5, places).collect()] == [r.seq for r in FL.search(postings, "engineer", "", 5).collect()]


def test_only_probed_partitions_are_read(spark, postings):
    path = work_dir(spark, "index")
    IX.write_index(postings, "seq", IX.trigrams(IX.search_text()), path, 64)
    found = IX.postings_of(spark, path, ["eng", "zz "])
    scan = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line][0]
    probed = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
    assert len(re.findall(r"\d+", re.sub(r"#\d+", "", probed))) <= 2 and "bucket" in probed and "In(term" in scan
    found.collect()
    metrics = scan_metrics(found)
    assert metrics["numPartitions"] <= 2 < spark.read.parquet(f"{path}/postings").select("bucket").distinct().count()
    assert metrics["numOutputRows"] < spark.read.parquet(f"{path}/postings").count() / 10


def test_changed_and_gone_rows_are_checked(spark, postings):
    path = work_dir(spark, "index")
    IX.write_index(postings, "seq", IX.trigrams(IX.search_text()), path, 8)
    changed = postings.filter("seq % 3 > 0").withColumn("title", F.when(F.col("seq") % 3 == 1, F.lit("fresh words")).otherwise(F.col("title")))
    IX.extend_index(changed.filter("seq % 3 = 1"), "seq", IX.trigrams(IX.search_text()), path)
    for keywords in ("engineer", "fresh", "data"):
        assert sorted(r.seq for r in IX.search_indexed(changed, "seq", path, keywords, "", None).collect()) == sorted(r.seq for r in FL.search(changed, keywords, "", None).collect())


def test_arrays(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 9 == 0 else [rng.choice("abcdef") if i % 7 else None for _ in range(rng.randint(0, 4))], "x") for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, skills array<string>, bucket string")
    path = work_dir(spark, "elements")
    IX.write_index(df, "id", IX.elements("skills"), path, 4)
    have = {i: set(s or []) - {None} for i, s, _ in rows}
    for wanted in (["a"], ["a", "b"], ["a", "q"], ["q"], ["f", "e", "d", "c"]):
        assert {r.id for r in IX.rows_with_all(df, "id", "skills", path, wanted).collect()} == {i for i, s in have.items() if set(wanted) <= s}
        assert {r.id for r in IX.rows_with_any(df, "id", "skills", path, wanted).collect()} == {i for i, s in have.items() if set(wanted) & s}
    assert IX.rows_with_any(df, "id", "skills", path, []).count() == 0
    empty = work_dir(spark, "elements")
    IX.write_index(df.limit(0), "id", IX.elements("skills"), empty, 4)
    assert IX.rows_with(df.limit(0), "id", "skills", empty, "a").count() == 0


def test_postings_are_gathered_before_the_shuffle(spark):
    """Texts of the same terms make a row per term and task, not one per text; repeats and nulls count once or not at all."""
    rows = spark.range(0, 4000, 1, 2).select("id", F.lit("some words of a text").alias("text"))
    path = work_dir(spark, "lists")
    IX.write_index(rows, "id", IX.trigrams("text"), path, 4)
    lists = spark.read.schema(IX.POSTINGS).parquet(f"{path}/postings")
    assert lists.count() <= 2 * 18 and lists.agg(F.sum(F.size("ids"))).first()[0] == 18 * 4000
    assert {r.n for r in spark.read.schema(IX.COUNTS).parquet(f"{path}/counts").collect()} == {4000}
    odd = spark.createDataFrame([(9, ["b", "a", "b", None]), (3, ["b"]), (3, ["b"]), (None, ["b"]), (4, None), (5, [])], "id bigint, terms array<string>")
    path = work_dir(spark, "lists")
    IX.write_index(odd, "id", IX.elements("terms"), path, 4)
    assert sorted(map(tuple, IX.postings_of(spark, path, ["a", "b"]).collect())) == [("a", 9), ("b", 3), ("b", 9)]


def test_grams_of_any_text(spark):
    texts = [None, "", "ab", "abc", "aaaa", "ünï𝒳y\n\x00z", "x" * 5, "abcabc"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string")
    got = {r.id: sorted(r.g) for r in rows.select("id", IX.trigrams("text").alias("g")).collect()}
    assert got == {i: sorted({t[k : k + 3] for k in range(len(t) - 2)} if t else []) for i, t in enumerate(texts)}
