"""Finding company boards: seeds x URL templates, pages and API status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import urls as U
from postmill.operators.quality import with_url_status
from postmill.operators.reconcile import first_by

# ---- fixed values: careers-page templates ----
BOARD_TEMPLATES = [
    "https://www.comeet.co/jobs/{company}",
    "https://www.comeet.com/jobs/{company}",
    "https://{company}.comeet.co",
    "https://careers.{company}.com",
]
SHORT_TEMPLATES = [
    "https://www.comeet.co/jobs/{company}",
    "https://{company}.comeet.co",
    "https://careers.{company}.com",
]
API_TEMPLATE = "https://www.comeet.co/careers-api/2.0/company/{company_id}/positions"


def candidate_urls(seeds: DataFrame, templates: list[str] = BOARD_TEMPLATES) -> DataFrame:
    """Seed companies x the fixed templates (an explode, no join)."""
    each = F.posexplode(F.array(*[F.lit(t) for t in templates])).alias("template_no", "template")
    rows = seeds.select("*", each)
    url = F.replace(F.col("template"), F.lit("{company}"), F.col("company"))
    return rows.withColumn("source_url", url).drop("template")


def discovered_companies(candidates: DataFrame, pages: DataFrame, statuses: DataFrame) -> DataFrame:
    """Candidates whose page names a company id, with the API's reachability."""
    found = pages.select(
        F.col("url").alias("source_url"),
        F.coalesce("final_url", "url").alias("careers_url") if "final_url" in pages.columns else F.col("url").alias("careers_url"),
        U.company_id_in_html("html").alias("company_id"),
    ).filter(F.col("company_id").isNotNull())
    rows = candidates.join(first_by(found, ["source_url"], ["careers_url"]), "source_url")
    api = F.replace(F.lit(API_TEMPLATE), F.lit("{company_id}"), F.col("company_id"))
    checked = with_url_status(rows.withColumn("api_url", api), statuses, "api_url")
    return checked.withColumnRenamed("url_ok", "api_accessible")
