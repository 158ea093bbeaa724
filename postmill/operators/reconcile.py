"""Deduplication, precedence between sources, caps and ordering.

First-wins choices are ``row_number() <= n`` filters: Spark plans them with a
partial ``WindowGroupLimit`` before the shuffle, so a key that holds a third of
the rows sends at most n rows per input task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.functions import urls as U
from postmill.functions.text import col, is_filled
from postmill.operators.joins import lookup

# phase of a posting in the result: native ones first, then the feeds
NATIVE, FEED, DISCOVERED_ATS = 0, 1, 2


def first_by(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first ``n`` rows per key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def company_key(c: Column | str = "company_name") -> Column:
    return F.lower(col(c))


def dedup_first_wins(df: DataFrame, order: list) -> DataFrame:
    """One row per company (case-insensitive) and job id."""
    return first_by(df.withColumn("company_key", company_key()), ["company_key", "job_id"], order)


def dedup_within_crawl(df: DataFrame, order: list) -> DataFrame:
    return first_by(df, ["crawl_id", "job_id"], order)


def dedup_uids(items: DataFrame, order: list) -> DataFrame:
    """First row per company and uid; rows without a uid are dropped."""
    return first_by(items.filter(is_filled("uid")), ["company_slug", "uid"], order)


def cap_per_company(df: DataFrame, order: list, n: int = 50) -> DataFrame:
    return first_by(df.withColumn("company_key", company_key()), ["company_key"], order, n)


def representative(df: DataFrame, order: list) -> DataFrame:
    """The first posting of each company."""
    return cap_per_company(df, order, 1)


def companies(df: DataFrame) -> DataFrame:
    return df.select(company_key().alias("company_key")).distinct()


def split_origins(discovered: DataFrame) -> DataFrame:
    """Discovered postings with provider, origin and the phase they take in the result."""
    provider = U.provider_of_url("apply_url")
    rows = discovered.withColumns(
        {
            "ats_provider": provider,
            "job_origin": U.job_origin("apply_url", provider),
            "external_apply": U.external_apply("apply_url"),
        }
    )
    is_ats = (F.col("job_origin") == "ATS") & F.col("apply_url").isNotNull()
    return rows.withColumn("phase", F.when(is_ats, DISCOVERED_ATS).otherwise(NATIVE))


def supersede(discovered: DataFrame, fetched: DataFrame) -> DataFrame:
    """Native ∪ fetched ∪ discovered ATS postings of companies without a fetched one.

    Both inputs are postings with ``seq``.
    """
    found = split_origins(discovered).withColumn("company_key", company_key())
    feed = split_origins(fetched).withColumns(
        {"job_origin": F.lit("ATS"), "phase": F.lit(FEED), "company_key": company_key()}
    )
    both = found.unionByName(feed, allowMissingColumns=True)
    has_feed = companies(fetched).withColumn("has_feed", F.lit(True))
    kept = lookup(both, has_feed, ["company_key"]).filter(
        (F.col("phase") != DISCOVERED_ATS) | F.col("has_feed").isNull()
    )
    return kept.drop("has_feed")


def reconcile(discovered: DataFrame, fetched: DataFrame, max_per_company: int | None = None) -> DataFrame:
    """Supersede, then deduplicate: the full reconciliation of two sources.

    Deduplication runs first in the plan. Within one key the company is constant, so the
    order native < feed < discovered ATS gives the same rows as superseding first, and the
    join sees the reduced set, spread by (company, job).
    """
    if max_per_company is not None:
        fetched = cap_per_company(fetched, ["seq"], max_per_company).drop("company_key")
    found = split_origins(discovered).withColumn("company_key", company_key())
    feed = split_origins(fetched).withColumns(
        {"job_origin": F.lit("ATS"), "phase": F.lit(FEED), "company_key": company_key()}
    )
    both = found.unionByName(feed, allowMissingColumns=True)
    unique = first_by(both, ["company_key", "job_id"], ["phase", "seq"])
    has_feed = companies(fetched).withColumn("has_feed", F.lit(True))
    return (
        lookup(unique, has_feed, ["company_key"])
        .filter((F.col("phase") != DISCOVERED_ATS) | F.col("has_feed").isNull())
        .drop("has_feed")
    )


def cheapest_source_first(*sources: DataFrame) -> DataFrame:
    """Union of sources where a later one only serves companies no earlier one has."""
    out = sources[0].withColumn("company_key", company_key())
    for later in sources[1:]:
        rest = later.withColumn("company_key", company_key())
        missing = lookup(rest, companies(out), ["company_key"], "left_anti")
        out = out.unionByName(missing, allowMissingColumns=True)
    return out


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: are the two tables equal as multisets, and how many rows differ."""
    differ = a.exceptAll(b).unionAll(b.exceptAll(a))
    n = differ.agg(F.count("*").alias("n_different"))
    return n.select("n_different", (F.col("n_different") == 0).alias("equal"))


def with_apply_urls(postings: DataFrame, apply_urls: DataFrame) -> DataFrame:
    """Fill missing apply URLs from the map job id -> URL (one row per id)."""
    known = apply_urls.select("job_id", F.col("apply_url").alias("mapped_url"))
    rows = lookup(postings, known, ["job_id"])
    return rows.withColumn("apply_url", F.coalesce("apply_url", "mapped_url")).drop("mapped_url")


def company_dimension(postings: DataFrame, order: str = "seq") -> DataFrame:
    """Per company: name, provider and base URL of its first posting, and the job count."""
    first = F.min(
        F.struct(order, "company_name", "ats_provider", U.base_of("apply_url").alias("ats_base_url"))
    )
    rows = postings.groupBy(company_key().alias("company_key")).agg(
        first.alias("f"), F.count("*").alias("job_count")
    )
    return rows.select("company_key", "f.company_name", "f.ats_provider", "f.ats_base_url", "job_count")


def with_company_info(postings: DataFrame, dimension: DataFrame) -> DataFrame:
    """Look companies up in the dimension by lowercased name."""
    info = dimension.select(
        "company_key",
        F.col("ats_provider").alias("known_provider"),
        F.col("ats_base_url").alias("known_base_url"),
        F.lit(True).alias("is_known"),
    )
    rows = lookup(postings.withColumn("company_key", company_key()), info, ["company_key"])
    return rows.withColumn("is_known", F.coalesce("is_known", F.lit(False)))


def known_only(postings: DataFrame, dimension: DataFrame) -> DataFrame:
    keys = dimension.select("company_key")
    return lookup(postings.withColumn("company_key", company_key()), keys, ["company_key"], "left_semi")


def company_groups(postings: DataFrame, order: str = "seq") -> DataFrame:
    """Company groups in first-seen order: when first seen, size, distinct jobs.

    The members stay rows of the posting table; no group is collected into one value.
    """
    return postings.groupBy(company_key().alias("company_key")).agg(
        F.min(order).alias("first_seq"),
        F.max(order).alias("last_seq"),
        F.count("*").alias("n_jobs"),
        F.count_distinct("job_id").alias("n_job_ids"),
    )
