"""Distributions, totals and display projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.functions.text import col, percent
from postmill.operators.reconcile import company_key, first_by, union_all


def distribution(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Count and share per value. The window runs over the few aggregated rows only."""
    name = name or column
    counts = df.groupBy(F.col(column).alias(name)).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    share = F.col("n") / total
    return counts.select(name, "n", (share * 100).alias("pct"), percent(share).alias("pct_text"))


def provider_distribution(df: DataFrame) -> DataFrame:
    """Known providers only; the share is of that subtotal."""
    known = df.filter(F.col("ats_provider").isNotNull() & (F.col("ats_provider") != "unknown"))
    return distribution(known, "ats_provider")


def origin_distribution(df: DataFrame) -> DataFrame:
    return distribution(df, "job_origin")


LEVELS = {0: "pair", 1: "provider", 3: "all"}


def provider_origin_rollup(df: DataFrame) -> DataFrame:
    """Counts per (provider, origin), per provider and in all, from one pass; shares of the parent level.

    ``level`` tells a subtotal from a group whose provider or origin is null. The parent's count comes from
    the aggregated rows, of which there are providers x origins, through one more grouping of those.
    """
    counts = df.rollup("ats_provider", "job_origin").agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    # rows of a provider and its subtotal differ in gid alone; the whole is the parent of all subtotals
    own = Window.partitionBy(F.when(F.col("gid") <= 1, F.struct("ats_provider")))
    subtotal = F.max(F.when(F.col("gid") == 1, F.col("n"))).over(own)
    whole = F.max(F.when(F.col("gid") == 3, F.col("n"))).over(Window.partitionBy())
    parent = F.when(F.col("gid") == 0, subtotal).otherwise(whole)
    level = F
    for gid, name in LEVELS.items():
        level = level.when(F.col("gid") == gid, name)
    share = F.col("n") / parent
    return counts.select("ats_provider", "job_origin", level.alias("level"), "n", (share * 100).alias("pct_of_parent"))


def ranked(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Most frequent first, ties by key."""
    return counts.orderBy(F.desc(n), F.asc(key))


def run_totals(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Jobs, ATS and native jobs, and distinct companies of each kind."""
    ats, native = F.col("job_origin") == "ATS", F.col("job_origin") == "LINKEDIN_NATIVE"
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("n_jobs"),
        F.count_if(ats).alias("n_ats"),
        F.count_if(native).alias("n_native"),
        F.count_distinct(F.when(ats, company_key())).alias("n_ats_companies"),
        F.count_distinct(F.when(native, company_key())).alias("n_native_companies"),
    )


def samples(df: DataFrame, by: list[str], order: list, n: int = 3) -> DataFrame:
    return first_by(df, by, order, n)


def head_with_overflow(df: DataFrame, order: list, n: int, label: str) -> DataFrame:
    """First ``n`` rows of ``label`` and, if there are more, one row "... and k more"."""
    head = df.orderBy(*order).limit(n).select(F.col(label).cast("string").alias("line"))
    more = df.agg((F.count("*") - n).alias("k")).filter(F.col("k") > 0)
    return head.unionByName(
        more.select(F.concat(F.lit("... and "), F.col("k").cast("string"), F.lit(" more")).alias("line"))
    )


def display_rows(df: DataFrame) -> DataFrame:
    """Columns of the display table, cut to width; a dash stands for null."""
    dash = F.lit("-")
    return df.select(
        F.substring("title", 1, 40).alias("title"),
        F.substring("company_name", 1, 25).alias("company"),
        F.substring(F.coalesce(F.nullif("location", F.lit("")), dash), 1, 20).alias("location"),
        F.when(F.col("job_origin") == "ATS", "ATS").otherwise("Native").alias("origin"),
        F.coalesce("ats_provider", dash).alias("ats"),
        F.col("extraction_method").alias("method"),
    )


def summary_lines(jobs: DataFrame, max_companies: int = 10, errors: DataFrame | None = None) -> DataFrame:
    """Text summary as ordered lines (part, pos, line): totals, ATS companies, the first
    native companies with an overflow mark, and errors (``pos``, ``error``).
    """
    zero = F.lit(0).cast("bigint")

    def lines(part: int, df: DataFrame, pos: Column, line: Column) -> DataFrame:
        return df.select(F.lit(part).alias("part"), pos.cast("bigint").alias("pos"), line.alias("line"))

    pairs = [
        ("Total Jobs Extracted: ", "n_jobs"),
        ("ATS Jobs: ", "n_ats"),
        ("LinkedIn-Native Jobs: ", "n_native"),
        ("ATS Companies Detected: ", "n_ats_companies"),
    ]
    shown = F.array(*[F.concat(F.lit(t), F.col(c).cast("string")) for t, c in pairs])
    totals = run_totals(jobs).select("*", F.posexplode(shown).alias("pos", "line"))
    companies = jobs.groupBy(company_key().alias("company_key"), (F.col("job_origin") == "ATS").alias("is_ats")).agg(
        F.min("seq").alias("pos"),
        F.min("company_name").alias("name"),
        F.min("ats_provider").alias("provider"),
        F.count("*").alias("n"),
    )
    ats, native = companies.filter("is_ats"), companies.filter("NOT is_ats")
    counts = native.agg(F.count("*").alias("n")).filter("n > 0")
    more = counts.filter(F.col("n") > max_companies)
    parts = [
        lines(0, totals, F.col("pos"), F.col("line")),
        lines(1, ats.agg(F.count("*").alias("n")).filter("n > 0"), zero, F.lit("ATS Companies:")),
        lines(2, ats, F.col("pos"), F.format_string("  - %s: %s (%d jobs)", "name", "provider", "n")),
        lines(3, counts, zero, F.format_string("LinkedIn-Native Companies (%d):", "n")),
        lines(4, native.orderBy("pos").limit(max_companies), F.col("pos"), F.concat(F.lit("  - "), "company_key")),
        lines(5, more, zero, F.format_string("  ... and %d more", F.col("n") - max_companies)),
    ]
    if errors is not None:
        n_errors = errors.agg(F.count("*").alias("n")).filter("n > 0")
        parts.append(lines(6, n_errors, zero, F.format_string("Errors (%d):", "n")))
        parts.append(lines(7, errors, F.col("pos"), F.concat(F.lit("  - "), "error")))
    return union_all(*parts)


def selector_usage(matches: DataFrame) -> DataFrame:
    """Matches per category and selector over all pages; unused selectors drop out."""
    total = matches.groupBy("category", "selector").agg(F.sum("n_matches").alias("n_matches"))
    return total.filter(F.col("n_matches") > 0)
