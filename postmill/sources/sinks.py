"""Publishing: JSON, CSV, text summary, tables and run envelopes.

All writers run in the executors and produce a folder; nothing goes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators import quality as Q
from postmill.operators import report as R
from postmill.schemas import CSV_COLUMNS

# ---- fixed value ----
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def iso_dates(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text."""
    return df.withColumns(
        {f.name: F.date_format(f.name, ISO_FORMAT) for f in df.schema if f.dataType.typeName() == "timestamp"}
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, nulls kept, dates as ISO text."""
    iso_dates(df).write.mode(mode).option("ignoreNullFields", "false").json(path)


def csv_rows(jobs: DataFrame) -> DataFrame:
    return iso_dates(jobs.select(*CSV_COLUMNS))


def write_csv(jobs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The twelve published columns in fixed order, with a header."""
    csv_rows(jobs).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_summary(
    jobs: DataFrame, path: str, mode: str = "errorifexists", errors: DataFrame | None = None
) -> None:
    """The text summary, in order."""
    lines = R.summary_lines(jobs, errors=errors)
    lines.orderBy("part", "pos").select("line").write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str], mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def run_envelope(
    totals: DataFrame,
    jobs: DataFrame,
    ats_type: str,
    method: str,
    by: list[str],
    title: str,
    location: str,
    url: str,
) -> DataFrame:
    """Run metadata per group: success, method, job count and quality, or the error.

    ``totals`` says per group whether anything readable was landed (``readable``).
    """
    landed = totals.groupBy(*by).agg(
        F.max("readable").alias("readable"), F.sum("total_found").alias("total_found"), F.count("*").alias("pages_scraped")
    )
    quality = Q.extraction_quality(jobs, title, location, url, by)
    rows = landed.join(quality, by, "left")
    ok = F.col("readable")
    return rows.select(
        *by,
        ok.alias("success"),
        F.lit(ats_type).alias("ats_type"),
        F.when(ok, F.lit(method)).alias("scraping_method"),
        F.when(ok, F.coalesce("n_jobs", F.lit(0))).cast("bigint").alias("total_jobs"),
        F.when(ok, F.col("total_found")).alias("total_found"),
        F.col("pages_scraped"),
        F.when(ok, F.coalesce("score", F.lit(0.0))).alias("score"),
        F.when(ok, F.concat_ws("; ", F.coalesce("issues", F.array(F.lit("No jobs extracted"))))).alias("issues"),
        F.when(~ok, F.lit("Failed to fetch postings from API")).alias("error"),
    )


def example_projection(jobs: DataFrame, columns: list[str]) -> DataFrame:
    """Jobs-only output with the chosen columns."""
    return jobs.select(*columns)


def run_summary(jobs: DataFrame, method: str, compliant: Column) -> DataFrame:
    """One-row summary object of a run."""
    all_ok = F.coalesce(F.bool_and(compliant), F.lit(False))
    quality = Q.extraction_quality(jobs, "job_title", "job_location", "job_url", ats_compliant=all_ok)
    return quality.select(
        F.col("n_jobs").alias("total_jobs"),
        F.lit(method).alias("scraping_method"),
        F.col("score").alias("quality_score"),
        "ats_compliant",
    )
