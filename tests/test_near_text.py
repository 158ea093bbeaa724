"""MinHash banding against all pairs, and pattern tables against trying every pattern."""

import random
import re

import pytest
from pyspark.sql import functions as F

from postmill.operators import near_text as NT
from postmill.operators import patterns as PT
from postmill.operators.components import connected
from postmill.plans.catalog import QUERIES, Inputs
from postmill.session import stage


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                group[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4 and rows:
            own = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(words)
        else:
            own = [rng.choice(words) for _ in range(rng.choice([0, 3, 8, 20, 45, 120]))]
            own = passage + own if kind > 0.8 else own
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_all_pairs(spark, seed):
    rows = texts(seed, 150)
    got = NT.near_duplicate_texts(spark.createDataFrame([(*r, "x") for r in rows], "id bigint, text string, n string"), "id", "text")
    assert {r.id: (r.n_shingles, r.group_id) for r in got.collect()} == plain_groups(rows)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t "), (4, "one two"), (5, "ONE  two"), (6, "w " * 50_000)]
    got = NT.near_duplicate_texts(spark.createDataFrame(rows, "id bigint, text string"), "id", "text").collect()
    assert {r.id: (r.n_shingles, r.group_id) for r in got} == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6)}
    assert NT.near_duplicate_texts(spark.createDataFrame([], "id bigint, text string"), "id", "text").count() == 0


def test_copies_and_a_hot_group_make_few_pairs(spark):
    """A third of the rows nearly equal, a third equal: candidates stay in proportion to the rows."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(200)]

    def changed(i):
        own = list(base)
        own[rng.randrange(200)] = f"c{i}"
        return " ".join(own)

    rows = [(i, changed(i)) for i in range(300)] + [(i, "same text of six words here") for i in range(300, 600)]
    rows += [(i, " ".join(f"{i}x{j}" for j in range(40))) for i in range(600, 900)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = {r.id: r.group_id for r in NT.near_duplicate_texts(df, "id", "text").collect()}
    assert {found[i] for i in range(300)} == {0} and {found[i] for i in range(300, 600)} == {300}
    assert all(found[i] == i for i in range(600, 900))
    sets = NT.text_sets(df, "id", "text")
    keys = NT.band_keys(sets.filter("id < 300"))
    stars = NT.star_pairs(keys)
    assert stars.count() < 300 * NT.BANDS  # of 44,850 pairs
    groups = connected(NT.linked(stars, sets))
    assert NT.crossing_pairs(keys, groups).count() == 0


def test_keys_are_counted_in_tasks_of_bounded_size(spark, monkeypatch):
    """Keys that are there once are not gathered by the task that reads them; a key in two groups is found."""
    monkeypatch.setattr(NT, "KEYS", 1000)
    keys = spark.range(0, 20_000, 1, 1).select(F.xxhash64(F.floor(F.col("id") / 2)).alias("key"), "id", F.lit(9).alias("n"), F.floor(F.col("id") / 4).alias("group"))
    keys = stage(keys.withColumn("group", F.when(F.col("id") == 7, 0).otherwise(F.col("group"))), "keys")
    found = NT.several_groups(keys)
    assert [(r.low, r.high) for r in found.collect()] == [(0, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.rindex("Exchange") and "REPARTITION_BY_NUM" in plan
    sizes = keys.select("key", "group").repartition(keys.count() // NT.KEYS + 1, "key").groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * NT.KEYS


def test_a_crossing_pair_is_made_once(spark, monkeypatch):
    rng = random.Random(4)
    have = {i: {k for k in range(30) if rng.random() < 0.5} for i in range(40)}
    # ids that come twice, with sets of other sizes
    rows = [(k, i, n, i) for i, ks in have.items() for k in ks for n in (10, *([90] if i % 5 == 0 else []))]
    made = []
    plain = NT.crossing_rows
    monkeypatch.setattr(NT, "crossing_rows", lambda rows: made.append(plain(rows)) or made[0])
    keys = spark.createDataFrame([r[:3] for r in rows], "key bigint, id bigint, n int")
    got = NT.crossing_pairs(keys, spark.createDataFrame([], "node bigint, group bigint"))
    want = {(a, b) for a in have for b in have if a < b and have[a] & have[b]}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    twice = sum(a % 5 == 0 and b % 5 == 0 for a, b in want)
    assert made[0].count() == len(want) + twice


def test_only_sets_of_rows_in_a_pair_are_kept(spark, monkeypatch):
    rows = [(i, " ".join(f"{i}x{j}" for j in range(120))) for i in range(200)]
    rows += [(200 + i, rows[i][1].rsplit(" ", 2)[0]) for i in range(5)] + [(205, rows[9][1]), (205, rows[9][1])]
    kept = []

    def noted(df, purpose):
        out = stage(df, purpose)
        if "hashes" in out.columns:
            kept.append(out.count())
        return out

    monkeypatch.setattr(NT, "stage", noted)
    got = NT.near_duplicate_texts(spark.createDataFrame(rows, "id bigint, text string"), "id", "text").collect()
    assert sum(kept) == 10
    assert sorted((r.id, r.group_id) for r in got) == sorted([(i, i) for i in range(200)] + [(200 + i, i) for i in range(5)] + [(205, 9)] * 2)


def test_pairs_are_compared_in_rounds_of_bounded_size(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(w if rng.random() > 0.02 else f"{i}x{j}" for j, w in enumerate(base))) for i in range(40)]
    pairs = stage(spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 40)], "a bigint, b bigint"), "pairs")
    texts = spark.createDataFrame(rows, "id bigint, text string")
    sizes = []
    plain = NT.linked
    monkeypatch.setattr(NT, "linked", lambda some, sets: sizes.append(some.count()) or plain(some, sets))
    sets = {i: shingles(t) for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert {tuple(r) for r in NT.links_among(pairs, texts).collect()} == want and want
    assert sum(sizes) == 780 and len(sizes) == 5 and max(sizes) < 2 * NT.PER_SET * 40


@pytest.mark.parametrize("own", [20, 40, 70])
def test_a_common_phrase_makes_few_pairs(spark, own):
    phrase = "five or more years of work and a degree of any kind are asked for here "
    rows = [(i, phrase + " ".join(f"{i}x{j}" for j in range(own))) for i in range(300)]
    keys = stage(NT.band_keys(NT.text_sets(spark.createDataFrame(rows, "id bigint, text string"), "id", "text")), "keys")
    assert NT.crossing_pairs(keys, spark.createDataFrame([], "node bigint, group bigint")).count() < 300


def test_a_hot_band_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        keys = spark.range(0, 60_000, 1, 16).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), "id", F.lit(100).alias("n"))
        stars = NT.star_pairs(keys)
        assert stars.count() >= 19_999
        plan = stars._jdf.queryExecution().executedPlan()
        stars.collect()
        assert "skew=true" in plan.toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(
    ("pattern", "literal"),
    [
        (r"challenge\.linkedin\.com", "challenge.linkedin.com"),
        (r"/d/([^/]+)/jobs", "/jobs"),
        (r"colou?r-list", "r-list"),
        (r"abc+def", "abc"),
        (r"[abc]def{2,3}ghij", "ghij"),
        (r"x\d+yz\wlong", "long"),
        (r"a|bcd", None),
        (r"(a|b)cdef", "cdef"),
        (r"(?i)login", None),
        (r"ab", None),
        (r"a\+b\*c\\d", r"a+b*c\d"),
        (r"^https?://x", "http"),
        (r"((a(b)c)d)*tail", "tail"),
    ],
)
def test_literals(spark, pattern, literal):
    got = spark.createDataFrame([(pattern,)], "p string").select(PT.longest_literal(F.col("p"))).first()[0]
    assert got == literal


def test_a_thousand_patterns_find_what_each_alone_finds(spark):
    rng = random.Random(3)
    parts = ["jobs", "view", "login", "api", "offers", "careers", "apply", "x.y", "search", "page"]
    rules = []
    for i in range(1000):
        a, b = rng.sample(parts, 2)
        rules.append((i // 2, f"l{i}", rng.choice([f"{re.escape(a)}/{i % 40}$", f"/{a}/({b}|{i})", f"{a}.*{b}[{i % 10}-9]", f"{a}?{b}", f"^{a}|{b}/{i}$", rf"\d{{3}}/{a}"])))
    urls = ["/".join([rng.choice(parts) for _ in range(rng.randint(1, 4))] + [str(rng.randint(0, 300))]) for _ in range(400)] + [None, "", "ab"]
    rows = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)], "id bigint, url string, gram string")
    table = spark.createDataFrame(rules, "priority bigint, label string, pattern string")
    got = {r.id: (r.priority, r.label) for r in PT.first_labels(rows, "url", table).collect()}
    want = {i: min(((p, label) for p, label, x in rules if u is not None and re.search(x, u)), default=(None, None)) for i, u in enumerate(urls * 2)}
    assert got == want and any(v[0] is not None for v in want.values())


def test_pattern_table_is_no_nested_loop(spark):
    rows = QUERIES["url_labels"].run(Inputs(spark, "/root/testdata/sf0.001"))
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
