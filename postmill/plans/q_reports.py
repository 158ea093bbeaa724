"""Queries over validation, distributions, queues and published outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators import claims as CL
from postmill.operators import filters as FL
from postmill.operators import layout as LO
from postmill.operators import normalize as N
from postmill.operators import quality as Q
from postmill.operators import reconcile as RC
from postmill.operators import report as R
from postmill.operators import upsert as UP
from postmill.plans.q_functions import LOCATION_TYPE, REMOTE_SCOPE
from postmill.plans.q_reconcile import RECONCILED, reconciled
from postmill.plans.q_shapes import (
    COMEET_ITEMS,
    COMEET_ROW,
    _comeet_shown,
    comeet_items,
    flat_postings,
    smart_items,
)
from postmill.plans.registry import Inputs, query, stamp
from postmill.schemas import FIELD_GROUPS, POSTING
from postmill.session import stage, work_dir
from postmill.sources import sinks as SK
from postmill.sources.payloads import payload_totals

# ---- reject rules ----

REASONS = f"""{COMEET_ITEMS}, checked AS (SELECT payload_id, item_pos, item, CASE WHEN coalesce(item->>'$.uid', '') = '' THEN 'Missing uid'
  WHEN coalesce(item->>'$.position_url', '') = '' THEN 'Missing position_url'
  WHEN NOT coalesce((SELECT max(s.status) BETWEEN 200 AND 299 FROM url_statuses s WHERE s.url = item->>'$.position_url'), false) THEN 'position_url returns non-200 status'
  WHEN json_array_length(item, '$.details') > 0 AND len(list_filter(json_extract(item, '$.details[*]'), lambda x: x->>'$.name' = 'Description')) = 0 THEN 'details[] does not contain ''Description'''
  WHEN contains(item->>'$.name', 'General application') THEN 'Title contains ''General application''' END AS reason, company_slug FROM comeet_items)"""


def _checked(i: Inputs) -> DataFrame:
    return Q.with_reject_reason(comeet_items(i), i.view("url_statuses"))


@query(
    "reject_reasons",
    "D3 E8",
    ["payloads", "url_statuses"],
    f"WITH {REASONS} SELECT company_slug, item->>'$.uid' AS uid, coalesce(item->>'$.name', '') AS title, reason FROM checked WHERE reason IS NOT NULL",
)
def reject_reasons(i):
    return Q.rejected_rows(_checked(i))


@query(
    "valid_jobs",
    "D3 C8",
    ["payloads", "url_statuses"],
    f"WITH {REASONS}, valid AS (SELECT * FROM checked WHERE reason IS NULL) {COMEET_ROW.format('valid')}",
)
def valid_jobs(i):
    valid = _checked(i).filter(F.col("reason").isNull())
    return _comeet_shown(N.normalize_comeet(valid, ("payload_id", "item_pos")), "payload_id", "item_pos")


@query(
    "reject_counts",
    "F4",
    ["payloads", "url_statuses"],
    f"""WITH {REASONS} SELECT 'total fetched' AS measure, count(*) AS n FROM checked UNION ALL SELECT 'total valid', count(*) FROM checked WHERE reason IS NULL
    UNION ALL SELECT 'total rejected', count(*) FROM checked WHERE reason IS NOT NULL UNION ALL SELECT reason, count(*) FROM checked WHERE reason IS NOT NULL GROUP BY 1""",
)
def reject_counts(i):
    return Q.reject_counts(_checked(i))


# ---- distributions ----


@query(
    "origin_distribution",
    "F2 G9 I34",
    ["postings"],
    f"""WITH {RECONCILED} SELECT job_origin, n, 100.0 * n / sum(n) OVER () AS pct, printf('%.1f%%', 100.0 * n / sum(n) OVER ()) AS pct_text
    FROM (SELECT job_origin, count(*) AS n FROM reconciled GROUP BY 1)""",
)
def origin_distribution(i):
    return R.ranked(R.origin_distribution(reconciled(i)), "job_origin")


TOTALS = """count(*) AS n_jobs, count(*) FILTER (job_origin = 'ATS') AS n_ats, count(*) FILTER (job_origin = 'LINKEDIN_NATIVE') AS n_native,
  count(DISTINCT CASE WHEN job_origin = 'ATS' THEN company_key END) AS n_ats_companies, count(DISTINCT CASE WHEN job_origin = 'LINKEDIN_NATIVE' THEN company_key END) AS n_native_companies"""


@query("run_totals", "F3", ["postings"], f"WITH {RECONCILED} SELECT {TOTALS} FROM reconciled")
def run_totals(i):
    return R.run_totals(reconciled(i))


@query(
    "totals_by_run",
    "F15 H2",
    ["postings"],
    f"WITH {RECONCILED} SELECT coalesce(job_type, 'none') AS run_id, {TOTALS} FROM reconciled GROUP BY 1",
)
def totals_by_run(i):
    return R.run_totals(reconciled(i).withColumn("run_id", F.coalesce("job_type", F.lit("none"))), ["run_id"])


@query(
    "run_samples",
    "F15",
    ["postings"],
    "SELECT company_key, seq, title FROM (SELECT lower(company_name) AS company_key, seq, title, row_number() OVER (PARTITION BY lower(company_name) ORDER BY seq) AS rn FROM postings) WHERE rn <= 3",
)
def run_samples(i):
    rows = i.view("postings").select(RC.company_key().alias("company_key"), "seq", "title")
    return R.samples(rows, ["company_key"], ["seq"])


@query(
    "head_overflow",
    "G10",
    ["postings"],
    "SELECT line FROM (SELECT title AS line FROM postings ORDER BY seq LIMIT 25) UNION ALL SELECT '... and ' || (count(*) - 25) || ' more' FROM postings",
)
def head_overflow(i):
    return R.head_with_overflow(i.view("postings"), ["seq"], 25, "title")


@query(
    "display_rows",
    "C16",
    ["postings"],
    f"""WITH {RECONCILED} SELECT substr(title, 1, 40) AS title, substr(company_name, 1, 25) AS company, substr(coalesce(NULLIF(location, ''), '-'), 1, 20) AS location,
    CASE WHEN job_origin = 'ATS' THEN 'ATS' ELSE 'Native' END AS origin, coalesce(ats_provider, '-') AS ats, 'api' AS method FROM reconciled""",
)
def display_rows(i):
    return R.display_rows(reconciled(i).withColumn("extraction_method", F.lit("api")))


# ---- quality and constraints ----


def jobs(i: Inputs) -> DataFrame:
    return N.to_ats_jobs(flat_postings(i), keep=("seq",))


QUALITY = """SELECT {0} count(*) AS n_jobs, avg(CAST(t AS DOUBLE)) * 50 + avg(CAST(l AS DOUBLE)) * 30 + avg(CAST(u AS DOUBLE)) * 20 AS raw, avg(CAST(t AS DOUBLE)) AS t, avg(CAST(l AS DOUBLE)) AS l, avg(CAST(u AS DOUBLE)) AS u
  FROM (SELECT lower(replace(company_name, ' ', '-')) AS company_slug, (title <> '')::INT AS t, (coalesce(location, '') <> '')::INT AS l, (coalesce(apply_url, '') <> '')::INT AS u FROM postings) {1}"""
QUALITY_OUT = """n_jobs, round(raw, 6) AS score, printf('%.1f%%', 100 * t) AS title_coverage, printf('%.1f%%', 100 * l) AS location_coverage, printf('%.1f%%', 100 * u) AS url_coverage,
  concat_ws('; ', CASE WHEN t < 0.9 THEN 'Low title coverage: ' || printf('%.1f%%', 100 * t) END, CASE WHEN l < 0.7 THEN 'Low location coverage: ' || printf('%.1f%%', 100 * l) END, CASE WHEN u < 0.8 THEN 'Low URL coverage: ' || printf('%.1f%%', 100 * u) END) AS issues"""


def _quality_shown(rows: DataFrame, *by: str) -> DataFrame:
    return rows.select(
        *by,
        "n_jobs",
        F.round("score_unrounded", 6).alias("score"),
        "title_coverage",
        "location_coverage",
        "url_coverage",
        F.concat_ws("; ", "issues").alias("issues"),
    )


@query("quality_score", "F5 I34", ["postings"], f"SELECT {QUALITY_OUT} FROM ({QUALITY.format('', '')})")
def quality_score(i):
    return _quality_shown(Q.extraction_quality(jobs(i), "job_title", "job_location", "job_url"))


@query(
    "quality_by_company",
    "F5",
    ["postings"],
    f"SELECT company_slug, {QUALITY_OUT} FROM ({QUALITY.format('company_slug,', 'GROUP BY 1')})",
)
def quality_by_company(i):
    rows = Q.extraction_quality(jobs(i), "job_title", "job_location", "job_url", ["company_slug"])
    return _quality_shown(rows, "company_slug")


COVERED = ["city", "state", "country", "remote_scope", "experience_level", "years_experience_min"]


@query(
    "field_coverage",
    "F13 D14",
    ["postings"],
    f"""WITH c AS (SELECT count(*) AS n_rows, count(CASE WHEN location <> '' THEN 1 END) AS city, count(CASE WHEN contains(location, ',') THEN 1 END) AS state,
      count(CASE WHEN len(string_split(location, ',')) > 2 THEN 1 END) AS country, count({REMOTE_SCOPE}) AS remote_scope, count(job_type) AS experience_level,
      count(NULLIF(regexp_extract(lower(description), '(\\d+)\\+?\\s*years?', 1), '')) AS years_experience_min FROM postings)
    SELECT n_rows, field, n_present, n_present / CAST(n_rows AS DOUBLE) AS coverage FROM (UNPIVOT c ON {', '.join(COVERED)} INTO NAME field VALUE n_present)""",
)
def field_coverage(i):
    return Q.field_coverage(jobs(i), COVERED)


@query(
    "group_compliance",
    "D14",
    ["postings"],
    """SELECT n_rows, field_group, n_complete, true AS fields_present FROM (SELECT count(*) AS n_rows, count(*) AS core, count(*) AS processing,
      count(CASE WHEN len(string_split(location, ',')) > 2 THEN 1 END) AS location, count(job_type) AS employment, CAST(0 AS BIGINT) AS required FROM postings) UNPIVOT (n_complete FOR field_group IN (core, processing, location, employment, required))""",
)
def group_compliance(i):
    return Q.group_compliance(jobs(i), FIELD_GROUPS)


def dirty(i: Inputs) -> DataFrame:
    """Relational rows with every kind of violation worked in, by row number."""
    n = F.col("seq") % 17
    return jobs(i).withColumns(
        {
            "job_status": F.when(n == 0, "archived").otherwise(F.col("job_status")),
            "sync_status": F.when(n == 1, "lost").when(n == 2, F.lit(None)).otherwise(F.col("sync_status")),
            "ai_extraction_confidence": F.when(n == 3, 1.5).when(n == 4, -0.1).otherwise(0.95).cast("decimal(3,2)"),
            "job_id": F.when(n == 5, F.lit(None)).otherwise(F.col("job_id")),
            "country": F.when(n == 6, F.repeat(F.lit("x"), 101)).otherwise(F.col("country")),
            "remote_scope": F.when(n == 7, "moon").otherwise(F.col("remote_scope")),
            "work_location_type": F.when(n == 8, "boat").otherwise(F.col("work_location_type")),
        }
    )


DIRTY_SQL = """SELECT seq, CASE seq % 17 WHEN 0 THEN 'valid_job_status' WHEN 1 THEN 'valid_sync_status' WHEN 3 THEN 'valid_ai_confidence' WHEN 4 THEN 'valid_ai_confidence'
  WHEN 5 THEN 'not_null_job_id' WHEN 6 THEN 'length_country' WHEN 7 THEN 'valid_remote_scope' WHEN 8 THEN 'valid_work_location_type' END AS rule FROM postings"""


@query("constraint_violations", "L1 L2 L3 L4", ["postings"], f"SELECT * FROM ({DIRTY_SQL}) WHERE rule IS NOT NULL")
def constraint_violations(i):
    rows = Q.with_violations(dirty(i), strict_remote_scope=True)
    return rows.select("seq", F.explode("violations").alias("rule"))


@query(
    "violation_counts",
    "L1 L2 L3 L4",
    ["postings"],
    f"SELECT rule, count(*) AS n FROM ({DIRTY_SQL}) WHERE rule <> 'valid_remote_scope' GROUP BY 1",
)
def violation_counts(i):
    return Q.violation_counts(dirty(i))


@query(
    "duplicate_keys",
    "L5",
    ["postings"],
    "SELECT 'smartrecruiter' AS ats_source, lower(replace(company_name, ' ', '-')) AS company_slug, job_id, count(*) AS n FROM postings GROUP BY 1, 2, 3 HAVING count(*) > 1",
)
def duplicate_keys(i):
    return Q.duplicate_keys(jobs(i))


@query(
    "column_defaults",
    "L6",
    ["postings"],
    """SELECT seq, CASE WHEN title = '' THEN 'pending' ELSE title END AS processing_status, 'pending' AS sync_status, 'active' AS job_status, 0 AS reprocessing_retry_count,
    false AS embeddings_generated, '2024-06-01 00:00:00' AS created_at, 0 AS n_project_types FROM postings""",
)
def column_defaults(i):
    rows = i.view("postings").select("seq", F.nullif("title", F.lit("")).alias("processing_status"))
    filled = Q.apply_defaults(rows, F.lit("2024-06-01").cast("timestamp"))
    return filled.select(
        "seq",
        "processing_status",
        "sync_status",
        "job_status",
        "reprocessing_retry_count",
        "embeddings_generated",
        stamp("created_at"),
        F.size("project_types").alias("n_project_types"),
    )


@query(
    "posting_validation",
    "L8",
    ["postings"],
    """SELECT seq, CASE WHEN title = '' THEN 'title: missing' WHEN location IS NULL THEN 'posted_date: wrong type' END AS problem FROM postings""",
)
def posting_validation(i):
    rows = i.view("postings").select(
        "seq",
        "job_id",
        F.nullif("title", F.lit("")).alias("title"),
        "company_name",
        "source",
        F.lit("https://x.example.org").alias("source_url"),
        F.when(F.col("location").isNull(), "not a date").otherwise("2024-05-01T00:00:00Z").alias("posted_date"),
    )
    return rows.select("seq", Q.posting_problem(rows.columns).alias("problem"))


# ---- queues and lookups ----


def queued(i: Inputs) -> DataFrame:
    """Relational rows in every processing state, by row number."""
    n = F.col("seq")
    return jobs(i).withColumns(
        {
            "processing_status": F.when(n % 5 == 0, "pending").when(n % 5 < 3, "processed").otherwise("scraped"),
            "sync_status": F.when(n % 7 == 0, "synced").when(n % 7 == 1, "failed").otherwise("pending"),
            "job_status": F.when(n % 6 == 0, "expired").otherwise("active"),
            "embeddings_generated": n % 4 == 0,
            "ai_extraction_confidence": (F.lit(0.01) * (n % 100)).cast("decimal(3,2)"),
        }
    )


STATES = """SELECT seq, lower(replace(company_name, ' ', '-')) AS company_slug, CASE WHEN seq % 5 = 0 THEN 'pending' WHEN seq % 5 < 3 THEN 'processed' ELSE 'scraped' END AS processing_status,
  CASE WHEN seq % 7 = 0 THEN 'synced' WHEN seq % 7 = 1 THEN 'failed' ELSE 'pending' END AS sync_status, CASE WHEN seq % 6 = 0 THEN 'expired' ELSE 'active' END AS job_status,
  seq % 4 = 0 AS embeddings_generated, (seq % 100) / 100.0 AS confidence FROM postings"""
_QUEUES = {
    "sync": ("processing_status = 'processed' AND sync_status = 'pending'", {}),
    "processing": ("processing_status = 'pending'", {}),
    "embeddings": ("processing_status = 'processed' AND NOT embeddings_generated", {}),
    "reprocess": ("processing_status = 'scraped' AND confidence < 0.4", {"processing_status": "scraped", "below": 0.4}),
    "scraped": ("processing_status = 'scraped'", {}),
    "low_confidence": ("processing_status = 'processed' AND confidence < 0.6", {}),
    "company": ("company_slug = 'company-0'", {"company_slug": "company-0", "ats_source": "smartrecruiter"}),
}


def _queue(name: str, where: str, want: dict) -> None:
    def run(i: Inputs) -> DataFrame:
        return FL.queue(queued(i), name, **want).select("seq", "company_slug", "processing_status")

    covers = "D11 M3" if name == "embeddings" else "D11"
    sql = f"SELECT seq, company_slug, processing_status FROM ({STATES}) WHERE job_status = 'active' AND {where}"
    query(f"queue_{name}", covers, ["postings"], sql)(run)


for _n, (_w, _kw) in _QUEUES.items():
    _queue(_n, _w, _kw)


@query(
    "queue_claims",
    "M3 D11",
    ["postings"],
    f"""WITH q AS (SELECT seq, row_number() OVER (ORDER BY seq) AS rn FROM ({STATES}) WHERE job_status = 'active' AND processing_status = 'processed' AND NOT embeddings_generated),
    open AS (SELECT * FROM q WHERE rn > 20 OR seq % 4 > 1), again AS (SELECT *, row_number() OVER (ORDER BY seq) AS place FROM open)
    SELECT seq AS id, 'third' AS claim_id, CASE WHEN rn <= 40 THEN 2 ELSE 1 END AS tries FROM again WHERE place <= 50""",
)
def queue_claims(i):
    """Two claims of twenty, one acknowledged in part; an hour later the leases are over and a third takes fifty."""
    path = work_dir(i.spark, "claims")
    ids = stage(FL.queue(queued(i), "embeddings").select(F.col("seq").alias("id")), "queue")
    now, later = (F.lit(f"2024-06-01 {h}:00:00").cast("timestamp") for h in ("12", "13"))
    first = CL.claim(ids, path, "first", "a", 20, now, 600)
    CL.claim(ids, path, "second", "b", 20, now, 600)
    done = stage(first.filter("id % 4 <= 1").select("id"), "done")
    CL.acknowledge(done, path, "first", now)
    CL.claim(ids.join(done, "id", "left_anti"), path, "third", "c", 50, later, 600)
    held = CL.state(i.spark, path).filter(F.col("lease_until") > later)
    return held.select("id", "claim_id", "tries")


@query(
    "next_scraped_batch",
    "D11 G7",
    ["postings"],
    f"SELECT seq FROM ({STATES}) WHERE job_status = 'active' AND processing_status = 'scraped' ORDER BY seq LIMIT 20",
)
def next_scraped_batch(i):
    return FL.next_batch(FL.queue(queued(i), "scraped"), 20, "seq").select("seq")


@query(
    "column_lookup",
    "D12",
    ["postings"],
    f"""SELECT seq FROM postings WHERE {LOCATION_TYPE} IN ('remote', 'hybrid') AND job_id >= 'J2' AND job_id <= 'J7'
      AND lower(replace(company_name, ' ', '-')) = 'company-0' AND make_timestamp(created_at_ms * 1000) >= TIMESTAMP '2024-01-01 01:00:00'""",
)
def column_lookup(i):
    rows = FL.lookup(
        jobs(i),
        work_location_type=["remote", "hybrid"],
        job_id=("J2", "J7"),
        company_slug="company-0",
        published_date=(F.lit("2024-01-01 01:00:00").cast("timestamp"), None),
    )
    return rows.select("seq")


@query(
    "column_lookup_indexed",
    "D12",
    ["postings"],
    f"""SELECT seq, job_id FROM postings WHERE job_id >= 'J2' AND job_id <= 'J7' AND make_timestamp(created_at_ms * 1000) >= TIMESTAMP '2024-01-01 01:00:00'
      AND lower(replace(company_name, ' ', '-')) IN ('company-0', 'company-3')""",
)
def column_lookup_indexed(i):
    """The table is written in Morton order of two columns, with Bloom filters on the company, and read back."""
    path = work_dir(i.spark, "clustered")
    rows = jobs(i).select("seq", "job_id", "company_slug", "published_date")
    LO.write_clustered(rows, path, ["job_id", "published_date"], {"company_slug": 10_000}, files=16)
    table = i.spark.read.schema(rows.schema).parquet(path)
    published = (F.lit("2024-01-01 01:00:00").cast("timestamp"), None)
    return FL.lookup(table, job_id=("J2", "J7"), published_date=published, company_slug=["company-0", "company-3"]).select("seq", "job_id")


@query(
    "skills_contains",
    "D13",
    None,
    """SELECT p_partkey, list_has_all(string_split(p_name, ' '), ['red', 'widget']) AS has_all, list_has_any(string_split(p_name, ' '), ['blue', 'ring']) AS has_any FROM part
    WHERE list_has_any(string_split(p_name, ' '), ['red', 'blue', 'ring'])""",
)
def skills_contains(i):
    parts = i.table("part").withColumn("required_skills", F.split("p_name", " "))
    return parts.filter(FL.contains_any("required_skills", ["red", "blue", "ring"])).select(
        "p_partkey",
        FL.contains_all("required_skills", ["red", "widget"]).alias("has_all"),
        FL.contains_any("required_skills", ["blue", "ring"]).alias("has_any"),
    )


# ---- published outputs, written and read back ----


def _published(i: Inputs) -> DataFrame:
    rows = reconciled(i).withColumns(
        {
            "source_url": F.concat(F.lit("https://www.linkedin.com/jobs/view/"), F.col("seq").cast("string")),
            "extraction_method": F.lit("api"),
            "easy_apply": F.lit(False),
            "extracted_at": F.lit("2024-06-01 12:00:00").cast("timestamp"),
        }
    )
    return N.as_schema(rows, POSTING, "seq")


PUBLISHED = f"""{RECONCILED}, published AS (SELECT seq, job_id, title, company_name, location, apply_url, ats_provider, job_origin, 'https://www.linkedin.com/jobs/view/' || seq AS source_url,
  '2024-06-01T12:00:00' AS extracted_at, 'api' AS extraction_method, false AS easy_apply, coalesce(NOT contains(apply_url, 'linkedin.com'), false) AS external_apply FROM reconciled)"""


@query(
    "json_sink",
    "A12",
    ["postings"],
    f"WITH {PUBLISHED} SELECT seq, job_id, title, company_name, location, apply_url, ats_provider, job_origin, source_url, extracted_at, external_apply FROM published",
)
def json_sink(i):
    path = work_dir(i.spark, "json")
    rows = _published(i)
    SK.write_json(rows, path)
    back = i.spark.read.schema(SK.iso_dates(rows).schema).json(path)
    return back.select(
        "seq",
        "job_id",
        "title",
        "company_name",
        "location",
        "apply_url",
        "ats_provider",
        "job_origin",
        "source_url",
        "extracted_at",
        "external_apply",
    )


@query(
    "csv_sink",
    "A13 C16",
    ["postings"],
    f"""WITH {PUBLISHED} SELECT job_id, coalesce(title, '') AS title, company_name, coalesce(location, '') AS location, coalesce(apply_url, '') AS apply_url, coalesce(ats_provider, '') AS ats_provider, job_origin, source_url,
    extracted_at, extraction_method, CAST(easy_apply AS VARCHAR) AS easy_apply, CAST(external_apply AS VARCHAR) AS external_apply FROM published""",
)
def csv_sink(i):
    path = work_dir(i.spark, "csv")
    SK.write_csv(_published(i), path)
    back = i.spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


@query(
    "summary_sink",
    "A14 G10",
    ["postings"],
    f"""WITH {RECONCILED}, t AS (SELECT {TOTALS} FROM reconciled), native AS (SELECT company_key, min(seq) AS pos FROM reconciled WHERE job_origin = 'LINKEDIN_NATIVE' GROUP BY 1)
    SELECT unnest(['Total Jobs Extracted: ' || n_jobs, 'ATS Jobs: ' || n_ats, 'LinkedIn-Native Jobs: ' || n_native, 'ATS Companies Detected: ' || n_ats_companies]) AS line FROM t
    UNION ALL SELECT 'ATS Companies:' UNION ALL SELECT 'LinkedIn-Native Companies (' || count(*) || '):' FROM native UNION ALL SELECT 'Errors (' || count(*) || '):' FROM postings WHERE title = '' UNION ALL SELECT '  - no title: ' || seq FROM postings WHERE title = ''
    UNION ALL SELECT '  - ' || min(company_name) || ': ' || min(ats_provider) || ' (' || count(*) || ' jobs)' FROM (SELECT * FROM reconciled WHERE job_origin = 'ATS') GROUP BY company_key
    UNION ALL SELECT line FROM (SELECT '  - ' || company_key AS line FROM native ORDER BY pos LIMIT 10)
    UNION ALL SELECT '  ... and ' || (count(*) - 10) || ' more' FROM native HAVING count(*) > 10""",
)
def summary_sink(i):
    path = work_dir(i.spark, "summary")
    untitled = i.view("postings").filter("title = ''")
    errors = untitled.select(F.col("seq").alias("pos"), F.concat(F.lit("no title: "), F.col("seq").cast("string")).alias("error"))
    SK.write_summary(reconciled(i), path, errors=errors)
    return i.spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "run_envelope",
    "A16",
    ["payloads"],
    """WITH it AS (SELECT company_slug, json_valid(body) AS ok, CASE WHEN json_valid(body) THEN coalesce(CAST(body->>'$.totalFound' AS BIGINT), CAST(json_array_length(body, '$.content') AS BIGINT)) ELSE 0 END AS announced,
      CASE WHEN json_valid(body) THEN len(list_filter(json_extract(body, '$.content[*]'), lambda x: x->>'$.id' <> '')) ELSE 0 END AS n FROM payloads WHERE provider = 'smartrecruiters')
    SELECT company_slug, bool_or(ok) AS success, 'smartrecruiter' AS ats_type, CASE WHEN bool_or(ok) THEN 'api' END AS scraping_method, CASE WHEN bool_or(ok) THEN CAST(sum(n) AS BIGINT) END AS total_jobs,
    CASE WHEN bool_or(ok) THEN CAST(sum(announced) AS BIGINT) END AS total_found, count(*) AS pages_scraped, CASE WHEN bool_or(ok) THEN CASE WHEN sum(n) > 0 THEN 100.0 ELSE 0.0 END :: DOUBLE END AS score,
    CASE WHEN bool_or(ok) THEN CASE WHEN sum(n) > 0 THEN '' ELSE 'No jobs extracted' END END AS issues, CASE WHEN NOT bool_or(ok) THEN 'Failed to fetch postings from API' END AS error FROM it GROUP BY 1""",
)
def run_envelope(i):
    payloads = i.view("payloads").filter("provider = 'smartrecruiters'")
    rows = N.flatten_smartrecruiters(smart_items(i), ("company_slug",))
    return SK.run_envelope(payload_totals(payloads), rows, "smartrecruiter", "api", ["company_slug"], "title", "location", "url")


@query(
    "test_summary",
    "A18",
    ["postings"],
    "SELECT count(*) AS total_jobs, 'api' AS scraping_method, round((avg(CASE WHEN title <> '' THEN 1.0 ELSE 0.0 END) * 50 + avg(CASE WHEN coalesce(location, '') <> '' THEN 1.0 ELSE 0.0 END) * 30 + avg(CASE WHEN apply_url IS NOT NULL THEN 1.0 ELSE 0.0 END) * 20), 1) AS quality_score, true AS ats_compliant FROM postings",
)
def test_summary(i):
    compliant = F.col("ats_source").isNotNull() & F.col("job_id").isNotNull() & F.col("job_title").isNotNull()
    return SK.run_summary(jobs(i), "api", compliant)


@query(
    "ats_jobs_projection",
    "A18",
    ["postings"],
    "SELECT 'smartrecruiter' AS ats_source, lower(replace(company_name, ' ', '-')) AS company_slug, job_id, title AS job_title FROM postings",
)
def ats_jobs_projection(i):
    return SK.example_projection(jobs(i), ["ats_source", "company_slug", "job_id", "job_title"])


# ---- upsert ----

UPSERTED = """key_rows AS (SELECT lower(replace(company_name, ' ', '-')) AS company_slug, job_id, seq, title, source FROM postings),
  old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_slug, job_id ORDER BY seq) AS rn FROM key_rows WHERE source = 'linkedin') WHERE rn = 1),
  new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_slug, job_id ORDER BY seq DESC) AS rn FROM key_rows WHERE source = 'ats') WHERE rn = 1)
  SELECT coalesce(o.company_slug, n.company_slug) AS company_slug, coalesce(o.job_id, n.job_id) AS job_id, coalesce(n.title, o.title) AS job_title,
  CASE WHEN o.job_id IS NULL THEN '2024-07-01 00:00:00' ELSE '2024-06-01 00:00:00' END AS created_at,
  CASE WHEN o.job_id IS NULL OR (n.job_id IS NOT NULL AND n.title <> o.title) THEN '2024-07-01 00:00:00' ELSE '2024-06-01 00:00:00' END AS updated_at
  FROM old o FULL JOIN new n ON o.company_slug = n.company_slug AND o.job_id = n.job_id"""


def _keyed(i: Inputs) -> DataFrame:
    at = F.lit("2024-06-01").cast("timestamp")
    return N.to_ats_jobs(flat_postings(i).join(i.view("postings").select("seq", "source"), "seq"), at, keep=("seq", "source")).select(
        "seq",
        "source",
        "id",
        "ats_source",
        "company_slug",
        "job_id",
        "job_title",
        "processing_status",
        "created_at",
        "updated_at",
    )


def _upsert_shown(rows: DataFrame) -> DataFrame:
    return rows.select("company_slug", "job_id", "job_title", stamp("created_at"), stamp("updated_at"))


@query("upsert_latest", "A15 L5 L7", ["postings"], f"WITH {UPSERTED}")
def upsert_latest(i):
    rows = _keyed(i)
    current = RC.first_by(rows.filter("source = 'linkedin'"), ["company_slug", "job_id"], ["seq"])
    batch = rows.filter("source = 'ats'")
    later = F.lit("2024-07-01").cast("timestamp")
    return _upsert_shown(UP.upsert(current.drop("seq", "source"), batch, later, [F.desc("seq")]))


@query("upsert_table", "A15 K4 L7", ["postings"], f"WITH {UPSERTED}")
def upsert_table(i):
    rows, path = _keyed(i), work_dir(i.spark, "ats_jobs")
    found = rows.filter("source = 'linkedin'").drop("source")
    UP.upsert_table(i.spark, path, found, F.lit("2024-06-01").cast("timestamp"), ["seq"], 8, ("seq",))
    batch = rows.filter("source = 'ats'").drop("source")
    UP.upsert_table(i.spark, path, batch, F.lit("2024-07-01").cast("timestamp"), [F.desc("seq")], 8, ("seq",))
    return _upsert_shown(i.spark.read.parquet(path))


