"""User-level jobs: the operators put together the way a daily run uses them.

Every job is lazy and takes and returns DataFrames; nothing is collected.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postmill.functions import classify as C
from postmill.functions import location as L
from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.functions import variants as V
from postmill.operators import crawls, details, html, match, normalize, quality, reconcile, report
from postmill.sources import captures, sinks
from postmill.sources.payloads import scan_details, scan_payloads
from postmill.sources.providers import PROVIDERS, Provider


class Ingested(NamedTuple):
    postings: DataFrame  # POSTING rows of the feeds with an API
    ats_jobs: DataFrame  # relational rows of the flat feed
    items: DataFrame  # items of feeds that are validated or joined with details first


def ingest_payloads(
    payloads: DataFrame, providers: dict[str, Provider] = PROVIDERS, run_at: Column | None = None
) -> Ingested:
    """Payload rows (provider, company_slug, company_name, base_url, body) -> normalized rows."""
    items = scan_payloads(payloads, providers)
    flat = normalize.flatten_smartrecruiters(items.filter("provider = 'smartrecruiters'"), ("company_slug",))
    return Ingested(
        normalize.normalize_postings(items, providers=providers, run_at=run_at),
        normalize.to_ats_jobs(flat, run_at),
        items.filter(~F.col("provider").isin([p.name for p in providers.values() if p.posting])),
    )


class Validated(NamedTuple):
    valid: DataFrame
    rejected: DataFrame
    counts: Observation  # filled once a write of ``valid`` or ``rejected`` has run


def validate_comeet(
    items: DataFrame, detail_bodies: DataFrame, statuses: DataFrame, order: list[str], name: str = "rejects"
) -> Validated:
    """List items and detail bodies -> valid relational rows and the quarantine."""
    uid = items.withColumn("uid", V.text(F.col("item"), "$.uid"))
    unique = reconcile.dedup_uids(uid, order)
    merged = details.overlay_details(unique, scan_details(detail_bodies))
    counts = Observation(name)
    checked = quality.with_reject_reason(merged, statuses).observe(
        counts,
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
    )
    valid = normalize.normalize_comeet(checked.filter(F.col("reason").isNull()))
    return Validated(valid, quality.rejected_rows(checked), counts)


def ingest_offers(items: DataFrame, detail_bodies: DataFrame | None = None) -> DataFrame:
    """Offer items (and detail bodies by slug) -> nested records."""
    rows = details.prefer_details(items, scan_details(detail_bodies)) if detail_bodies is not None else items
    return normalize.normalize_recruitee(rows)


def classify_postings(postings: DataFrame, description: str, job_type: str) -> DataFrame:
    """Add provider, origin and every label read from the posting's own text."""
    low = postings.withColumns(
        {"_low": F.lower(description), "_all": C.title_and_text("title", description)}
    )
    provider = U.provider_of_url("apply_url")
    return low.withColumns(
        {
            "ats_provider": provider,
            "job_origin": U.job_origin("apply_url", provider),
            "company_slug": U.company_slug(provider, "apply_url"),
            "city": L.location_part("location", 0),
            "state": L.location_part("location", 1),
            "country": L.location_part("location", 2),
            "work_location_type": L.work_location_type("location"),
            "remote_scope": L.remote_scope("location"),
            "experience_level": C.experience_level(job_type),
            "employment_type": C.employment_type(job_type),
            "years_experience_min": X.years_of(F.col("_low")),
            "education_required": C.education_of(F.col("_low")),
            "management_level": C.management_of(F.col("_all")),
        }
    ).drop("_low", "_all")


def discover(log: DataFrame, max_per_crawl: int | None = None, run_at: Column | None = None) -> DataFrame:
    """Capture log with bodies -> discovered postings: only what came before a block, first
    one per crawl and job, at most ``max_per_crawl`` of them.
    """
    lists = captures.job_captures(crawls.before_block(log)).filter("route = 'list'")
    entities = captures.scan_job_entities(lists)
    rows = normalize.normalize_discoveries(entities, run_at, ("crawl_id", "seq", "item_pos"))
    unique = reconcile.dedup_within_crawl(rows, ["seq", "item_pos"])
    if max_per_crawl is None:
        return unique
    return reconcile.first_by(unique, ["crawl_id"], ["seq", "item_pos"], max_per_crawl)


def pages_for_missing(pages: DataFrame, postings: DataFrame) -> DataFrame:
    """Pages of companies no feed has rows for; only these are parsed."""
    keyed = pages.withColumn("company_key", reconcile.company_key())
    return reconcile.lookup(keyed, reconcile.companies(postings), ["company_key"], "left_anti")


def jobs_from_pages(pages: DataFrame) -> DataFrame:
    """Pages (page_id, company_slug, company_name, base_url, html) -> relational rows."""
    keep = ("page_id", "company_slug", "company_name")
    cards = html.page_jobs(html.parse_pages(pages, keep=keep, parts=("jobs",)), keep)
    flat = cards.withColumnRenamed("company_name", "company").withColumn("id", F.lit(""))
    return normalize.to_ats_jobs(flat)


def reports(jobs: DataFrame) -> dict[str, DataFrame]:
    """The small tables of a run report."""
    return {
        "totals": report.run_totals(jobs),
        "providers": report.ranked(report.provider_distribution(jobs), "ats_provider"),
        "origins": report.ranked(report.origin_distribution(jobs), "job_origin"),
        "companies": report.ranked(reconcile.company_groups(jobs), "company_key", "n_jobs"),
    }


def compare_sources(discovered: DataFrame, career: DataFrame) -> dict[str, DataFrame]:
    """Duplicate matches, per-company comparison and the one-row report."""
    found = match.match_duplicates(discovered, career)
    origins = reconcile.split_origins(discovered)
    return {
        "matches": found,
        "companies": match.company_comparison(discovered, career, found),
        "report": match.duplication_report(origins, career, found),
    }


def publish(jobs: DataFrame, folder: str) -> None:
    """Postings as JSON, CSV and a partitioned table, and the text summary."""
    sinks.write_json(jobs, f"{folder}/json")
    sinks.write_csv(jobs, f"{folder}/csv")
    sinks.write_table(jobs, f"{folder}/table", ["ats_provider"])
    sinks.write_summary(jobs, f"{folder}/summary")
