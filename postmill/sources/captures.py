"""Scans of network capture logs and the job entities inside their bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import urls as U
from postmill.functions import variants as V
from postmill.sources.payloads import parse_body

# ---- fixed values ----
JSON_TYPE = "application/json"


def scan_captures(log: DataFrame, any_success: bool = False) -> DataFrame:
    """Usable captures: JSON with status 200 (or any 2xx)."""
    ok = F.col("status").between(200, 299) if any_success else F.col("status") == 200
    return log.filter(ok & F.col("content_type").contains(JSON_TYPE))


def job_captures(log: DataFrame) -> DataFrame:
    """Usable, unblocked captures of job endpoints with their route (detail or list)."""
    kept = scan_captures(log).filter(U.is_job_api("url") & U.block_reason("status", "url").isNull())
    return kept.withColumn("route", U.capture_route("url"))


def offer_captures(log: DataFrame) -> DataFrame:
    """Captured offer lists and details with slug and API base."""
    kept = scan_captures(log, any_success=True).filter(F.col("url").contains("/api/"))
    return kept.select(
        "*",
        U.offer_route("url").alias("route"),
        U.offer_slug("url").alias("offer_slug"),
        U.api_base("url").alias("api_base"),
    ).filter(F.col("route").isNotNull())


def job_entities(v: Column) -> Column:
    """Job objects in a parsed discovery response: ``included`` entities, then ``elements``,
    then the values under ``data.*job*``; duplicates are kept.
    """
    none = F.array().cast("array<variant>")

    def is_job(x: Column) -> Column:
        urn = F.coalesce(V.filled(x, "$.entityUrn"), V.text(x, "$['$recipeType']"), F.lit(""))
        return F.lower(urn).contains("jobposting") | x.cast("string").contains("fsd_jobPosting")

    under_data = F.map_filter(
        F.coalesce(V.fields(v, "$.data"), F.create_map().cast("map<string,variant>")),
        lambda k, x: F.lower(k).contains("job"),
    )
    from_data = F.flatten(
        F.transform(
            F.map_values(under_data),
            lambda x: F.when(V.is_object(x), F.array(x)).otherwise(V.objects(x)),
        )
    )
    return F.concat(
        F.filter(V.objects(v, "$.included"), is_job),
        V.objects(v, "$.elements"),
        F.coalesce(from_data, none),
    )


def scan_job_entities(captures: DataFrame) -> DataFrame:
    """Capture rows -> one row per job entity (``item``, ``item_pos``)."""
    rest = [c for c in captures.columns if c != "body"]
    parsed = parse_body(captures)
    return parsed.select(*rest, F.posexplode(job_entities(F.col("parsed"))).alias("item_pos", "item"))


def scan_included(captures: DataFrame) -> DataFrame:
    """Capture rows -> one row per object of ``included[]``."""
    rest = [c for c in captures.columns if c != "body"]
    included = V.objects(F.col("parsed"), "$.included")
    return parse_body(captures).select(*rest, F.posexplode(included).alias("item_pos", "item"))
