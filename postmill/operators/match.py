"""Duplicate matching between discovered and career-page postings.

Contract: postings of one company (case-insensitive, trimmed) are compared by these
methods, in order; the first method that finds anything decides, then the higher score,
then the lower career job id.

    apply_url 1.0 · job_id 1.0 · description_hash 1.0 · title_location 0.95 ·
    fuzzy_title 1 - levenshtein / longer length, at least 0.85

No method compares all pairs of a company. The exact methods are one equi join against
career keys reduced to one row per key (many-to-one, never a pair explosion). The fuzzy
method compares *distinct titles* and finds candidates by exact segment filtering: if two
strings are within t edits, one of the t+1 segments of the one occurs in the other near
its own place (Li, Deng, Wang, Feng: Pass-Join, VLDB 2012). That filter loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.text import blank_to_null, clean_text, col
from postmill.operators.joins import lookup
from postmill.operators.reconcile import first_by, union_all
from postmill.session import stage

# ---- fixed values ----
SCORES = {"apply_url": 1.0, "job_id": 1.0, "description_hash": 1.0, "title_location": 0.95}
FUZZY_FLOOR = 0.85


def canonical_url(c: Column | str) -> Column:
    """Lowercase, without scheme, ``www.``, query, fragment and trailing slash."""
    bare = F.regexp_replace(F.lower(col(c)), r"^[a-z][a-z0-9+.-]*://(www\.)?", "")
    return blank_to_null(F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), r"/+$", ""))


def match_company(c: Column | str = "company_name") -> Column:
    return F.lower(F.trim(col(c)))


def _title() -> Column:
    return blank_to_null(F.lower(clean_text("title")))


def _keys(df: DataFrame, *keep: str) -> DataFrame:
    """One narrow row per posting and exact method: (company, method, key)."""
    place = F.concat_ws("|", F.lower(clean_text("title")), F.lower(clean_text("location")))
    values = {
        "apply_url": canonical_url("apply_url"),
        "job_id": blank_to_null("job_id"),
        "description_hash": F.col("description_hash"),
        "title_location": F.when(_title().isNotNull(), place),
    }
    entries = F.array(
        *[F.struct(F.lit(i).alias("method"), v.alias("key")) for i, v in enumerate(values.values())]
    )
    rows = df.select(*keep, match_company().alias("company"), F.explode(entries).alias("e"))
    return rows.select(*keep, "company", "e.method", "e.key")


def _exact_matches(discovered: DataFrame, career: DataFrame) -> DataFrame:
    """Every discovered posting with its best exact match, if any:
    (seq, company, title, method, career_job_id).
    """
    index = _keys(career.withColumn("career_job_id", F.col("job_id")), "career_job_id")
    index = index.filter(F.col("key").isNotNull())
    index = index.groupBy("company", "method", "key").agg(F.min("career_job_id").alias("career_job_id"))
    found = _keys(discovered.withColumn("norm_title", _title()), "seq", "norm_title")
    hits = lookup(found, index, ["company", "method", "key"])
    hit = F.when(F.col("career_job_id").isNotNull(), F.struct("method", "career_job_id"))
    best = hits.groupBy("seq").agg(
        F.min("company").alias("company"), F.min("norm_title").alias("title"), F.min(hit).alias("b")
    )
    return best.select("seq", "company", "title", "b.method", "b.career_job_id")


def _max_edits(length: Column) -> Column:
    """Most edits allowed against any partner of a string of this length."""
    longest = F.floor(length / F.lit(FUZZY_FLOOR) + 1e-9)
    return F.floor(longest * (1 - FUZZY_FLOOR) + 1e-9).cast("int")


def _segments(length: Column, edits: Column) -> Column:
    """Even split of a string into edits+1 segments: (no, start, size), 1-based."""
    n = edits + 1
    base = F.floor(length / n).cast("int")
    long_ones = length - base * n  # the last ones are one longer
    short_ones = n - long_ones

    def segment(i: Column) -> Column:
        start = (i - 1) * base + F.greatest(F.lit(0), i - 1 - short_ones) + 1
        size = base + F.when(i > short_ones, 1).otherwise(0)
        return F.struct(i.alias("no"), start.cast("int").alias("start"), size.cast("int").alias("size"))

    return F.transform(F.sequence(F.lit(1), n), segment)


def _candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct title pairs of one company that share a segment near its place.

    A title is probed only with lengths that the company has, whatever its own.
    """
    size = F.char_length("title")
    index = right.select(
        "company",
        F.col("title").alias("career_title"),
        size.alias("length"),
        F.explode(_segments(size, _max_edits(size))).alias("s"),
    )
    index = index.select(
        "company",
        "career_title",
        "length",
        F.col("s.no").alias("no"),
        F.substring("career_title", F.col("s.start"), F.col("s.size")).alias("piece"),
    )
    shortest = F.ceil(size * FUZZY_FLOOR - 1e-9).cast("int")
    longest = F.floor(size / FUZZY_FLOOR + 1e-9).cast("int")
    probes = left.select("company", "title", size.alias("own"), F.explode(F.sequence(shortest, longest)).alias("length"))
    there = right.select("company", size.alias("length")).distinct()
    probes = lookup(probes, there, ["company", "length"], "inner")
    edits = _max_edits(F.col("length"))
    probes = probes.select("*", edits.alias("edits"), F.explode(_segments(F.col("length"), edits)).alias("s"))
    shift = F.col("own") - F.col("length")
    no, start, width = F.col("s.no"), F.col("s.start"), F.col("s.size")
    rest = F.col("edits") + 1 - no
    first = F.greatest(F.lit(1), start - (no - 1), start + shift - rest)
    last = F.least(F.col("own") - width + 1, start + (no - 1), start + shift + rest)
    none = F.array().cast("array<int>")
    places = F.when(first <= last, F.sequence(first, last)).otherwise(none)
    probes = probes.select(
        "company",
        "title",
        "length",
        no.alias("no"),
        F.explode(F.array_distinct(F.transform(places, lambda p: F.substring("title", p, width)))).alias("piece"),
    )
    return probes.join(index, ["company", "length", "no", "piece"]).select("company", "title", "career_title").distinct()


def title_score(a: Column | str, b: Column | str) -> Column:
    longer = F.greatest(F.char_length(col(a)), F.char_length(col(b)))
    return 1 - F.levenshtein(col(a), col(b)) / longer


def fuzzy_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Best career title per (company, title): (company, title, score, career_job_id).

    ``left`` holds distinct (company, title), ``right`` (company, title, career_job_id) with
    one row per title.
    """
    pairs = _candidates(left, right)
    # the distance is worked out only as far as the floor allows
    longer = F.greatest(F.char_length("title"), F.char_length("career_title"))
    pairs = pairs.withColumn("most", F.floor(longer * (1 - FUZZY_FLOOR) + 1e-9).cast("int"))
    pairs = pairs.withColumn("edits", F.expr("levenshtein(title, career_title, most)")).filter("edits >= 0")
    scored = pairs.select("company", "title", "career_title", (1 - F.col("edits") / longer).alias("score"))
    ids = right.withColumnRenamed("title", "career_title")
    scored = lookup(scored.filter(F.col("score") >= FUZZY_FLOOR), ids, ["company", "career_title"], "inner")
    top = scored.groupBy("company", "title").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "career_job_id")).alias("b")
    )
    return top.select(
        "company", "title", (-F.col("b.minus")).alias("score"), F.col("b.career_job_id").alias("career_job_id")
    )


def match_duplicates(discovered: DataFrame, career: DataFrame) -> DataFrame:
    """One row per discovered posting with its best career match, or none.

    Both sides need company_name, job_id, title, location, apply_url, description_hash;
    the discovered side also a unique ``seq``.
    """
    joined = stage(_exact_matches(discovered, career), "exact-matches")  # read twice below
    open_titles = (
        joined.filter(F.col("method").isNull() & F.col("title").isNotNull())
        .select("company", "title")
        .distinct()
    )
    career_titles = (
        career.select(match_company().alias("company"), _title().alias("title"), "job_id")
        .filter(F.col("title").isNotNull())
        .groupBy("company", "title")
        .agg(F.min("job_id").alias("career_job_id"))
    )
    fuzzy = fuzzy_titles(open_titles, career_titles).select(
        "company", "title", "score", F.col("career_job_id").alias("fuzzy_job_id")
    )
    rows = lookup(joined, fuzzy, ["company", "title"])
    by_fuzzy = F.col("method").isNull() & F.col("score").isNotNull()
    method = F
    for i, name in enumerate(SCORES):
        method = method.when(F.col("method") == i, name)
    fixed = F
    for i, value in enumerate(SCORES.values()):
        fixed = fixed.when(F.col("method") == i, value)
    return rows.select(
        F.col("seq").alias("discovered_seq"),
        "company",
        F.coalesce("career_job_id", F.when(by_fuzzy, F.col("fuzzy_job_id"))).alias("career_job_id"),
        (F.col("method").isNotNull() | by_fuzzy).alias("is_duplicate"),
        fixed.when(by_fuzzy, F.col("score")).otherwise(0.0).alias("similarity_score"),
        method.when(by_fuzzy, "fuzzy_title").otherwise(F.lit(None).cast("string")).alias("match_method"),
    )


def company_comparison(discovered: DataFrame, career: DataFrame, matches: DataFrame) -> DataFrame:
    """Per company: jobs on each side and duplicates found, from one aggregation."""
    zero = F.lit(0)
    sides = [
        discovered.select(match_company().alias("company"), F.lit(1).alias("d"), zero.alias("c"), zero.alias("m")),
        career.select(match_company().alias("company"), zero.alias("d"), F.lit(1).alias("c"), zero.alias("m")),
        matches.select(
            "company", zero.alias("d"), zero.alias("c"), F.col("is_duplicate").cast("int").alias("m")
        ),
    ]
    both = sides[0].unionByName(sides[1]).unionByName(sides[2])
    return both.groupBy("company").agg(
        F.sum("d").alias("jobs_discovered"),
        F.sum("c").alias("jobs_on_career_page"),
        F.sum("m").alias("duplicates_found"),
    )


def _count_map(counts: DataFrame, column: str) -> DataFrame:
    """Counts per value as one map; the values are a small fixed domain."""
    known = counts.filter(F.col(column).isNotNull()).groupBy(column).agg(F.sum("n").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct(column, "n")))
    return known.agg(F.map_from_entries(entries).alias("m"))


def duplication_report(discovered: DataFrame, career: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: analyzed, found, confirmed, discovered-only, rate and two distributions.

    ``discovered`` needs ats_provider and job_origin.
    """
    totals = matches.agg(
        F.count("*").alias("total_analyzed"), F.count_if("is_duplicate").alias("confirmed_duplicates")
    )
    n_career = career.agg(F.count("*").alias("total_career_page_jobs"))
    counts = discovered.groupBy("ats_provider", "job_origin").agg(F.count("*").alias("n"))
    providers = _count_map(counts.filter(F.col("ats_provider") != "unknown"), "ats_provider")
    origins = _count_map(counts, "job_origin")
    rate = F.coalesce(F.try_divide("confirmed_duplicates", "total_analyzed"), F.lit(0.0))
    # every part is one aggregated row; stacking them and keeping what is set needs no join
    parts = [
        totals,
        n_career,
        providers.select(F.col("m").alias("ats_distribution")),
        origins.select(F.col("m").alias("job_origin_distribution")),
    ]
    stacked = union_all(*parts)
    row = stacked.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in stacked.columns])
    return row.select(
        "total_analyzed",
        "total_career_page_jobs",
        "confirmed_duplicates",
        (F.col("total_analyzed") - F.col("confirmed_duplicates")).alias("discovered_only"),
        rate.alias("duplication_rate"),
        "ats_distribution",
        "job_origin_distribution",
    )


def match_pairs(discovered: DataFrame, career: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches with both full records as structs (one career row per company and job id)."""
    right = first_by(career.withColumn("company", match_company()), ["company", "job_id"], ["seq"])
    right = right.select(
        "company",
        F.col("job_id").alias("career_job_id"),
        F.struct(*[c for c in right.columns if c != "company"]).alias("career_job"),
    )
    left = discovered.select(F.col("seq").alias("discovered_seq"), F.struct(*discovered.columns).alias("discovered_job"))
    return lookup(matches.join(left, "discovered_seq"), right, ["company", "career_job_id"])
