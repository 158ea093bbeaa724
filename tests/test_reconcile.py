"""Reconciliation, matching and capture rules on small cases."""

import random

from pyspark.sql import functions as F

from postmill.operators import crawls as CR
from postmill.operators import joins as JN
from postmill.operators import match as MT
from postmill.operators import reconcile as RC
from postmill.operators.upsert import upsert
from postmill.plans.catalog import QUERIES, Inputs

POSTS = "seq long, company_name string, job_id string, title string, apply_url string"
LEVER = "https://jobs.lever.co/x/1"


def test_mixed_companies(spark):
    found = spark.createDataFrame(
        [
            (1, "Harbour Bakery", "1", "a", LEVER),
            (2, "Tin Workshop", "2", "b", None),
            (3, "North Mills", "3", "c", LEVER),
            (4, "Quay Books", "4", "d", "https://www.linkedin.com/jobs/view/4"),
            (5, "HARBOUR BAKERY", "9", "native too", None),
        ],
        POSTS,
    )
    fetched = spark.createDataFrame([(6, "harbour bakery", "f1", "x", LEVER), (7, "harbour bakery", "9", "dup of native", LEVER)], POSTS)
    kept = {r.seq: r.job_origin for r in RC.reconcile(found, fetched).collect()}
    assert kept == {2: "LINKEDIN_NATIVE", 3: "ATS", 4: "LINKEDIN_NATIVE", 5: "LINKEDIN_NATIVE", 6: "ATS"}
    assert RC.reconcile(found, fetched, 1).count() == 5


def test_dedup_first_wins_and_is_idempotent(spark):
    rows = spark.createDataFrame([(2, "Salt Works", "j7", "b", None), (1, "SALT WORKS", "j7", "a", None), (3, "Lime Kiln", "j7", "c", None)], POSTS)
    once = RC.dedup_first_wins(rows, ["seq"])
    assert sorted(r.seq for r in once.collect()) == [1, 3]
    twice = RC.dedup_first_wins(once.drop("company_key"), ["seq"])
    assert RC.same_rows(once, twice.select(*once.columns)).first().equal


def test_reconcile_equals_supersede_then_dedup(spark):
    i = Inputs(spark, "/root/testdata/sf0.001")
    direct = RC.reconcile(i.discovered, i.fetched).select("seq")
    slow = RC.first_by(RC.supersede(i.discovered, i.fetched), ["company_key", "job_id"], ["phase", "seq"]).select("seq")
    assert RC.same_rows(direct, slow).first().equal


def _score(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def test_fuzzy_titles_equal_brute_force(spark):
    rng = random.Random(3)

    def word(n):
        return "".join(rng.choice("abcd ") for _ in range(n)).strip() or "a"

    def noisy(s, n):
        for _ in range(n):
            p = rng.randrange(len(s) + 1)
            kind = rng.randrange(3)
            s = s[:p] + (rng.choice("abcdx") if kind else "") + s[p + (kind != 1) :]
        return s or "a"

    base = [word(rng.choice([3, 7, 8, 13, 20, 27, 40, 61, 84, 99, 100, 101, 117, 118, 130, 160])) for _ in range(120)]
    left = {("c", noisy(s, rng.randrange(0, 2 + len(s) // 6))) for s in base} | {("d", base[0])}
    right = {("c", s) for s in base}
    ids = {pair: f"J{n:04d}" for n, pair in enumerate(sorted(right))}
    got = MT.fuzzy_titles(
        spark.createDataFrame(sorted(left), "company string, title string"),
        spark.createDataFrame([(c, t, ids[c, t]) for c, t in sorted(right)], "company string, title string, career_job_id string"),
    )
    got = {(r.company, r.title): (round(r.score, 9), r.career_job_id) for r in got.collect()}
    want = {}
    for c, t in left:
        scored = [(-_score(t, s), ids[c2, s]) for c2, s in right if c2 == c]
        best = min([x for x in scored if -x[0] >= MT.FUZZY_FLOOR], default=None)
        if best:
            want[c, t] = (round(-best[0], 9), best[1])
    assert got == want and len(want) > 60


def test_match_methods_in_order(spark):
    columns = "seq long, company_name string, job_id string, title string, location string, apply_url string, description_hash string"
    career = spark.createDataFrame(
        [
            (1, "Acme", "c1", "Senior Data Engineer", "Berlin", "https://www.a.com/1/?x=2", "h1"),
            (2, "Acme", "c2", "Cook", "Rome", "https://a.com/2", "h2"),
        ],
        columns,
    )
    found = spark.createDataFrame(
        [
            (1, " ACME ", "c2", "x", None, "http://a.com/1#top", "h2"),
            (2, "acme", "c2", "x", None, None, "h1"),
            (3, "acme", "z", "x", None, None, "h1"),
            (4, "acme", "z", "COOK ", "rome", None, None),
            (5, "acme", "z", "Senior Data Enginer", "Oslo", None, None),
            (6, "acme", "z", "Gardener", None, None, None),
            (7, "other", "c1", "Cook", "Rome", "https://a.com/2", "h2"),
        ],
        columns,
    )
    rows = {r.discovered_seq: (r.match_method, r.career_job_id, round(r.similarity_score, 2)) for r in MT.match_duplicates(found, career).collect()}
    assert rows == {
        1: ("apply_url", "c1", 1.0),
        2: ("job_id", "c2", 1.0),
        3: ("description_hash", "c1", 1.0),
        4: ("title_location", "c2", 0.95),
        5: ("fuzzy_title", "c1", 0.95),
        6: (None, None, 0.0),
        7: (None, None, 0.0),
    }
    pairs = MT.match_pairs(found, career, MT.match_duplicates(found, career))
    assert pairs.filter("discovered_seq = 4").first().career_job.title == "Cook"


def test_block_keeps_partial_rows(spark):
    log = spark.createDataFrame(
        [(1, 1, "https://x/jobs", 200), (1, 2, "https://x/login", 200), (1, 3, "https://x/jobs", 200), (2, 1, "https://x/jobs", 429), (3, 5, "https://x/jobs", 200)],
        "crawl_id long, seq long, url string, status int",
    )
    assert sorted((r.crawl_id, r.seq) for r in CR.before_block(log).collect()) == [(1, 1), (3, 5)]


def test_redirect_chain_limit(spark):
    rows = [(c, "https://s", n, f"https://u{c}/{n % 30}", 200) for n in range(40) for c in (1, 2)]
    log = spark.createDataFrame(rows, "crawl_id long, redirected_from string, seq long, url string, status int")
    chains = {r.crawl_id: r.chain for r in CR.redirect_chains(log).collect()}
    assert chains == {c: ["https://s"] + [f"https://u{c}/{n}" for n in range(10)] for c in (1, 2)}


def test_candidates_per_title_stay_bounded(spark):
    """50,000 titles of one company: probes grow with the length of a title, not with the company."""
    titles = spark.range(50_000).select(F.lit("c").alias("company"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 40).alias("title"), F.col("id").cast("string").alias("career_job_id"))
    near = titles.select("company", F.concat(F.substring("title", 1, 20), F.lit("#"), F.substring("title", 22, 30)).alias("title")).limit(500)
    pairs = MT._candidates(near, titles)
    assert pairs.count() < 3 * 500
    assert MT.fuzzy_titles(near, titles).count() == 500
    long = [("c", "".join(chr(97 + (n * k) % 26) for k in range(120))) for n in range(1, 200)]
    both = spark.createDataFrame(long, "company string, title string").withColumn("career_job_id", F.col("title"))
    assert MT._candidates(both.select("company", "title"), both).count() < len(long) ** 2 / 4


def test_upsert_touches_only_changed_rows(spark):
    current = spark.createDataFrame(
        [(1, "s", "c", "1", "old", "active", "2024-01-01", "2024-01-01"), (2, "s", "c", "2", None, "expired", "2024-01-01", "2024-01-01")],
        "id long, ats_source string, company_slug string, job_id string, job_title string, job_status string, created_at string, updated_at string",
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")})
    batch = spark.createDataFrame(
        [("s", "c", "1", "new"), ("s", "c", "2", None), ("s", "c", "3", "added")], "ats_source string, company_slug string, job_id string, job_title string"
    )
    now = F.lit("2024-05-05").cast("timestamp")
    once = upsert(current, batch, now, ["job_title"])
    rows = {r.job_id: (r.job_title, r.job_status, str(r.created_at)[:10], str(r.updated_at)[:10]) for r in once.collect()}
    assert rows == {
        "1": ("new", "active", "2024-01-01", "2024-05-05"),
        "2": (None, "expired", "2024-01-01", "2024-01-01"),
        "3": ("added", "active", "2024-05-05", "2024-05-05"),
    }
    again = upsert(once, batch, F.lit("2024-06-06").cast("timestamp"), ["job_title"])
    assert RC.same_rows(once, again).first().equal


def test_lookup_equals_plain_join(spark):
    rows = [(n, "hot" if n % 3 else None if n % 2 else f"k{n % 50}") for n in range(3000)]
    left = spark.createDataFrame(rows, "seq long, k string")
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("k40", 3), ("other", 4)], "k string, v int")
    for how in ("left", "inner", "left_anti", "left_semi"):
        plain = left.join(right, ["k"], how)
        large = JN.lookup(left, right, ["k"], how)
        assert large.columns == plain.columns
        assert RC.same_rows(plain, large).first().equal


def test_hot_keys_of_a_lookup_are_split(spark):
    """The reduced side has its own shuffle, so AQE sees and splits the hot partition."""
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
        left = spark.range(0, 60000, 1, 16).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.md5(F.col("id").cast("string")).alias("pad")
        )
        right = left.groupBy("k").agg(F.count("*").alias("n"))
        joined = JN.lookup(left, right, ["k"])
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_company_of_a_registered_query_is_split(spark):
    """Supersede joins a hot company to its feed; the plan that ran shows the split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = QUERIES["supersede"].run(Inputs(spark, "/root/testdata/sf0.01"))
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_keeps_a_column_named_like_its_own(spark):
    left = spark.createDataFrame([(1, 7, 8), (None, 9, 10)], "k int, _slot int, `a.b` int")
    right = spark.createDataFrame([(1, 5)], "k int, v int")
    rows = JN.lookup(left, right, ["k"])
    assert rows.columns == ["k", "_slot", "a.b", "v"]
    assert sorted(map(tuple, rows.collect()), key=repr) == [(1, 7, 8, 5), (None, 9, 10, None)]
