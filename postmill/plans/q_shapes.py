"""Queries over payload scans, JSON shaping and the provider mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import variants as V
from postmill.operators import mappings as M
from postmill.operators import normalize as N
from postmill.operators.details import overlay_details, prefer_details
from postmill.operators.quality import offer_problem
from postmill.plans.q_functions import (
    EDUCATION,
    EMPLOYMENT,
    EXPERIENCE,
    LOCATION_TYPE,
    MANAGEMENT,
    REMOTE_SCOPE,
    SPACES,
    YEARS,
    origin_sql,
    part_sql,
    provider_sql,
)
from postmill.plans.registry import Inputs, query, stamp
from postmill.sources.captures import scan_captures, scan_job_entities
from postmill.sources.payloads import payload_totals, scan_details, scan_payloads

SHOWN = [
    "job_id",
    "title",
    "company_name",
    "location",
    "description_hash",
    "description_snippet",
    "posted_date",
    "source_url",
    "apply_url",
    "ats_provider",
    "extraction_method",
]


def items_sql(provider: str, path: str, where: str = "true") -> str:
    """Exploded items of one provider as a CTE body (DuckDB)."""
    return f"""SELECT payload_id, company_slug, company_name, base_url, item, item_pos FROM (
      SELECT payload_id, company_slug, company_name, base_url, unnest(arr) AS item, generate_subscripts(arr, 1) - 1 AS item_pos
      FROM (SELECT *, json_extract(CASE WHEN json_valid(body) THEN body END, '{path}') AS arr FROM payloads WHERE provider = '{provider}' AND {where}))"""


def posting_sql(provider: str, path: str, fields: dict[str, str], where: str, method: str = "ats_api", source_where: str = "true") -> str:
    base = {
        "job_id": "NULL",
        "title": "NULL",
        "company_name": "company_name",
        "location": "''",
        "description_hash": "CAST(NULL AS VARCHAR)",
        "description_snippet": "CAST(NULL AS VARCHAR)",
        "posted_date": "CAST(NULL AS VARCHAR)",
        "source_url": "NULL",
        "apply_url": None,
        "ats_provider": f"'{provider}'",
        "extraction_method": f"'{method}'",
    }
    base |= fields
    base["apply_url"] = base["apply_url"] or base["source_url"]
    cols = ", ".join(f"{e} AS {n}" for n, e in base.items())
    return f"SELECT payload_id, item_pos, {cols} FROM ({items_sql(provider, path, source_where)}) WHERE {where}"


ISO = "CASE WHEN {0} LIKE '____-__-__T__:__:__Z' THEN replace(replace({0}, 'T', ' '), 'Z', '') END"
FEEDS = {
    "greenhouse": posting_sql(
        "greenhouse",
        "$.jobs[*]",
        {
            "job_id": "item->>'$.id'",
            "title": "item->>'$.title'",
            "location": "coalesce(item->>'$.location.name', '')",
            "source_url": "coalesce(item->>'$.absolute_url', 'https://boards.greenhouse.io/' || company_slug || '/jobs/' || (item->>'$.id'))",
            "posted_date": ISO.format("(item->>'$.updated_at')"),
        },
        "item->>'$.title' <> ''",
    ),
    "lever": posting_sql(
        "lever",
        "$[*]",
        {
            "job_id": "item->>'$.id'",
            "title": "item->>'$.text'",
            "location": "coalesce(item->>'$.categories.location', '')",
            "source_url": "coalesce(item->>'$.hostedUrl', 'https://jobs.lever.co/' || company_slug || '/' || (item->>'$.id'))",
            "apply_url": "coalesce(item->>'$.applyUrl', item->>'$.hostedUrl', 'https://jobs.lever.co/' || company_slug || '/' || (item->>'$.id'))",
            "posted_date": "strftime(make_timestamp(CAST(item->>'$.createdAt' AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')",
            "description_hash": "md5(NULLIF(item->>'$.descriptionPlain', ''))",
            "description_snippet": "substr(NULLIF(item->>'$.descriptionPlain', ''), 1, 500)",
        },
        "item->>'$.text' <> ''",
        source_where="json_type(CASE WHEN json_valid(body) THEN body END) = 'ARRAY'",
    ),
    "ashby": posting_sql(
        "ashby",
        "$.jobs[*]",
        {
            "job_id": "item->>'$.id'",
            "title": "item->>'$.title'",
            "location": "coalesce(item->>'$.location', '')",
            "source_url": "coalesce(item->>'$.jobUrl', 'https://jobs.ashbyhq.com/' || company_slug || '/' || (item->>'$.id'))",
        },
        "item->>'$.title' <> ''",
    ),
    "workday": posting_sql(
        "workday",
        "$.jobPostings[*]",
        {
            "job_id": "coalesce(item->>'$.bulletFields[0]', substr(md5((item->>'$.title') || company_name), 1, 12))",
            "title": "item->>'$.title'",
            "location": "coalesce(NULLIF(item->>'$.locationsText', ''), item->>'$.location', '')",
            "source_url": "coalesce('https://' || company_slug || '.wd5.myworkdayjobs.com' || (item->>'$.externalPath'), base_url)",
            "posted_date": ISO.format("(item->>'$.postedOn')"),
        },
        "item->>'$.title' <> ''",
    ),
    "smartrecruiters": posting_sql(
        "smartrecruiters",
        "$.content[*]",
        {
            "job_id": "coalesce(NULLIF(item->>'$.id', ''), item->>'$.uuid')",
            "title": "item->>'$.name'",
            "location": "coalesce(item->>'$.location.city', '') || coalesce(', ' || NULLIF(item->>'$.location.region', ''), '')",
            "source_url": "'https://jobs.smartrecruiters.com/' || company_slug || '/' || coalesce(NULLIF(item->>'$.id', ''), item->>'$.uuid')",
        },
        "item->>'$.name' <> ''",
    ),
}


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "payload_id", F.col("item_pos").cast("bigint").alias("item_pos"), *[stamp(c) if c == "posted_date" else c for c in SHOWN]
    )


def _feed(provider: str, covers: str) -> None:
    def run(i: Inputs) -> DataFrame:
        payloads = i.view("payloads").filter(F.col("provider") == provider)
        return _shown(N.normalize_postings(scan_payloads(payloads), keep=("payload_id", "item_pos")))

    query(f"norm_{provider}", covers, ["payloads"], FEEDS[provider])(run)


for _name, _covers in {
    "greenhouse": "A1 C1 D1 I20",
    "lever": "A2 C2 I1 I2 I22",
    "ashby": "A3 C3",
    "workday": "A4 C4 I3 I11",
    "smartrecruiters": "A5 C5",
}.items():
    _feed(_name, _covers)


@query("ingest_feeds", "A11 H2", ["payloads"], " UNION ALL ".join(FEEDS.values()))
def ingest_feeds(i):
    return _shown(
        N.normalize_postings(scan_payloads(i.view("payloads")), keep=("payload_id", "item_pos"))
    )


_CAPTURED = {
    "greenhouse": posting_sql(
        "greenhouse",
        "$.jobs[*]",
        {
            "job_id": "item->>'$.id'",
            "title": "item->>'$.title'",
            "location": "coalesce(item->>'$.location.name', '')",
            "source_url": "coalesce(item->>'$.absolute_url', '')",
        },
        "item->>'$.title' <> ''",
        "network_interception",
    ),
    "lever": posting_sql(
        "lever",
        "$[*]",
        {
            "job_id": "item->>'$.id'",
            "title": "item->>'$.text'",
            "location": "coalesce(item->>'$.categories.location', '')",
            "source_url": "coalesce(item->>'$.hostedUrl', '')",
            "apply_url": "coalesce(item->>'$.applyUrl', item->>'$.hostedUrl', '')",
        },
        "item->>'$.text' <> ''",
        "network_interception",
        "json_type(CASE WHEN json_valid(body) THEN body END) = 'ARRAY'",
    ),
    "workday": posting_sql(
        "workday",
        "$.jobPostings[*]",
        {
            "job_id": "coalesce(item->>'$.bulletFields[0]', substr(md5((item->>'$.title') || company_name), 1, 12))",
            "title": "item->>'$.title'",
            "location": "coalesce(NULLIF(item->>'$.locationsText', ''), item->>'$.location', '')",
            "source_url": "coalesce('https://' || company_slug || '.wd5.myworkdayjobs.com' || (item->>'$.externalPath'), base_url)",
        },
        "item->>'$.title' <> ''",
        "network_interception",
    ),
}


@query("captured_feeds", "B2 C6", ["payloads"], " UNION ALL ".join(_CAPTURED.values()))
def captured_feeds(i):
    items = scan_payloads(i.view("payloads"))
    return _shown(N.normalize_postings(items, captured=True, keep=("payload_id", "item_pos")))


@query(
    "payload_totals",
    "A5 A16",
    ["payloads"],
    """SELECT payload_id, readable, n_items, coalesce(announced, n_items) AS total_found FROM (
      SELECT payload_id, json_valid(body) AS readable, CAST(json_extract_string(b, '$.totalFound') AS BIGINT) AS announced,
      coalesce(CAST(CASE provider WHEN 'greenhouse' THEN json_array_length(b, '$.jobs') WHEN 'ashby' THEN json_array_length(b, '$.jobs')
        WHEN 'workday' THEN json_array_length(b, '$.jobPostings') WHEN 'smartrecruiters' THEN json_array_length(b, '$.content')
        WHEN 'recruitee' THEN json_array_length(b, '$.offers')
        WHEN 'comeet' THEN CASE WHEN json_type(b) = 'ARRAY' THEN json_array_length(b) ELSE json_array_length(b, '$.data') END
        ELSE CASE WHEN json_type(b) = 'ARRAY' THEN json_array_length(b) ELSE 0 END END AS BIGINT), 0) AS n_items
      FROM (SELECT *, CASE WHEN json_valid(body) THEN body END AS b FROM payloads))""",
)
def totals(i):
    return payload_totals(i.view("payloads")).select("payload_id", "readable", "n_items", "total_found")


COMEET_ITEMS = f"""comeet_items AS ({items_sql('comeet', '$[*]', "json_type(CASE WHEN json_valid(body) THEN body END) = 'ARRAY'")}
  UNION ALL {items_sql('comeet', '$.data[*]', "json_type(CASE WHEN json_valid(body) THEN body END) = 'OBJECT'")})"""


def last_detail(name: str) -> str:
    return f"list_last(list_filter(json_extract(item, '$.details[*]'), lambda x: x->>'$.name' = '{name}'))->>'$.value'"


COMEET_ROW = f"""SELECT payload_id, item_pos, item->>'$.uid' AS job_id, coalesce(item->>'$.name', '') AS job_title,
  coalesce(NULLIF(item->>'$.url_active_page', ''), item->>'$.position_url') AS job_url, item->>'$.position_url' AS apply_url,
  md5(NULLIF(concat_ws(chr(10) || chr(10), NULLIF({last_detail('Description')}, ''), NULLIF({last_detail('Requirements')}, '')), '')) AS raw_md5,
  {ISO.format("(item->>'$.time_updated')")} AS updated_date,
  NULLIF(concat_ws(', ', NULLIF(item->>'$.location.city', ''), NULLIF(item->>'$.location.state', ''), NULLIF(item->>'$.location.country', '')), '') AS job_location,
  item->>'$.location.city' AS city, item->>'$.location.country' AS country,
  CASE item->>'$.workplace_type' WHEN 'Remote' THEN 'remote' WHEN 'Hybrid' THEN 'hybrid' WHEN 'On-site' THEN 'on-site' ELSE 'not_specified' END AS work_location_type,
  list_filter(json_extract(item, '$.categories[*]'), lambda x: x->>'$.name' = 'Function')[1]->>'$.value' AS job_function,
  coalesce(item->>'$.employment_type', '') AS employment_type, 'Comeet' AS ats_source, 'scraped' AS processing_status, 'active' AS job_status
  FROM {{0}}"""


def _comeet_shown(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(
        *keep,
        "job_id",
        "job_title",
        "job_url",
        "apply_url",
        F.md5("job_description_raw").alias("raw_md5"),
        stamp("updated_date"),
        "job_location",
        "city",
        "country",
        "work_location_type",
        "job_function",
        "employment_type",
        "ats_source",
        "processing_status",
        "job_status",
    )


def comeet_items(i: Inputs) -> DataFrame:
    return scan_payloads(i.view("payloads").filter("provider = 'comeet'")).withColumn(
        "item_pos", F.col("item_pos").cast("bigint")
    )


@query(
    "norm_comeet",
    "A6 C8 B10 B11 B20 I7 I10 I30",
    ["payloads"],
    f"WITH {COMEET_ITEMS} {COMEET_ROW.format('comeet_items')}",
)
def norm_comeet(i):
    return _comeet_shown(N.normalize_comeet(comeet_items(i), ("payload_id", "item_pos")), "payload_id", "item_pos")


@query(
    "comeet_raw_object",
    "B20",
    ["payloads"],
    f"""WITH {COMEET_ITEMS} SELECT payload_id, item_pos, item->>'$.uid' AS uid, item->>'$.workplace_type' AS workplace_type,
    CAST(coalesce(json_array_length(item, '$.details'), 0) AS BIGINT) AS n_details, item->>'$.location.city' AS city FROM comeet_items""",
)
def comeet_raw_object(i):
    rows = N.normalize_comeet(comeet_items(i), ("payload_id", "item_pos"))
    raw = V.parse("raw_data")
    return rows.select(
        "payload_id",
        "item_pos",
        V.text(raw, "$.uid").alias("uid"),
        V.text(raw, "$.workplace_type").alias("workplace_type"),
        F.coalesce(F.size(V.array(raw, "$.details")), F.lit(0)).cast("bigint").alias("n_details"),
        V.text(raw, "$.location.city").alias("city"),
    )


@query(
    "detail_overlay",
    "A7 E2 B17",
    ["payloads", "comeet_details"],
    f"""WITH {COMEET_ITEMS}, merged AS (SELECT payload_id, item_pos, CASE
      WHEN d.body LIKE '[%' THEN json_extract(d.body, '$[0]')
      WHEN d.body IS NOT NULL THEN json_merge_patch(json_object('time_updated', d.body->>'$.time_updated', 'url_active_page', d.body->>'$.url_active_page'), item)
      ELSE item END AS item FROM comeet_items i LEFT JOIN comeet_details d ON d.company_slug = i.company_slug AND d.uid = i.item->>'$.uid')
    {COMEET_ROW.format('merged')}""",
)
def detail_overlay(i):
    details = scan_details(i.view("comeet_details"))
    rows = overlay_details(comeet_items(i), details)
    return _comeet_shown(N.normalize_comeet(rows, ("payload_id", "item_pos")), "payload_id", "item_pos")


@query(
    "overlay_key_presence",
    "B17",
    ["payloads", "comeet_details"],
    f"""WITH {COMEET_ITEMS} SELECT payload_id, item_pos, CASE WHEN d.body LIKE '[%' THEN 'listed' WHEN item->>'$.uid' IS NULL THEN 'absent' ELSE 'null kept' END AS department
    FROM comeet_items i LEFT JOIN comeet_details d ON d.company_slug = i.company_slug AND d.uid = i.item->>'$.uid'""",
)
def overlay_key_presence(i):
    rows = overlay_details(comeet_items(i), scan_details(i.view("comeet_details")))
    kind = V.kind(F.col("item"), "$.department")
    name = V.text(F.col("item"), "$.name")
    return rows.select(
        "payload_id",
        "item_pos",
        F.when(name == "Listed", "listed")
        .when(kind == "VOID", "null kept")
        .when(kind.isNull(), "absent")
        .otherwise(V.text(F.col("item"), "$.department"))
        .alias("department"),
    )


OFFER = """SELECT payload_id, CAST(item->>'$.id' AS BIGINT) AS id, item->>'$.slug' AS slug, item->>'$.title' AS title, md5(item->>'$.description') AS description_md5,
  item->>'$.requirements' AS requirements,
  CASE WHEN json_type(item, '$.department') = 'OBJECT' THEN item->>'$.department.id' END AS department_id,
  CASE WHEN json_type(item, '$.department') = 'OBJECT' THEN item->>'$.department.name' ELSE item->>'$.department' END AS department_name,
  coalesce(array_to_string(list_transform(json_extract(item, '$.locations[*]'), lambda x: coalesce(x->>'$.city', '') || '/' || coalesce(x->>'$.country', '') || '/' || coalesce(item->>'$.remote' = 'true', false)), ';'), '') AS locations,
  CAST(item->>'$.min_salary' AS DOUBLE) AS salary_min, replace(item->>'$.created_at', ' UTC', '') AS created_at, replace(replace(item->>'$.published_at', 'T', ' '), 'Z', '') AS published_at,
  'https://' || company_slug || '.recruitee.com/o/' || (item->>'$.slug') AS careers_url,
  coalesce(item->>'$.careers_apply_url', 'https://' || company_slug || '.recruitee.com/o/' || (item->>'$.slug') || '/c/new') AS apply_url FROM {0}
  WHERE TRY_CAST(item->>'$.id' AS BIGINT) IS NOT NULL"""


def _offer_shown(rows: DataFrame) -> DataFrame:
    def shown(x):
        return F.concat_ws("/", F.coalesce(x["city"], F.lit("")), F.coalesce(x["country"], F.lit("")), x["remote"].cast("string"))

    return rows.select(
        "payload_id",
        "id",
        "slug",
        "title",
        F.md5("description").alias("description_md5"),
        "requirements",
        F.col("department.id").cast("string").alias("department_id"),
        F.col("department.name").alias("department_name"),
        F.array_join(F.transform("locations", shown), ";").alias("locations"),
        "salary_min",
        stamp("created_at"),
        stamp("published_at"),
        "careers_url",
        "apply_url",
    )


def offer_items(i: Inputs) -> DataFrame:
    return scan_payloads(i.view("payloads").filter("provider = 'recruitee'"))


@query(
    "norm_recruitee",
    "A8 C9 B8 B15 I23 L8",
    ["payloads"],
    f"WITH offers AS ({items_sql('recruitee', '$.offers[*]')}) {OFFER.format('offers')}",
)
def norm_recruitee(i):
    return _offer_shown(N.normalize_recruitee(offer_items(i), ("payload_id",)))


@query(
    "prefer_detail",
    "E1 B9 D9",
    ["payloads", "offer_details"],
    f"""WITH offers AS ({items_sql('recruitee', '$.offers[*]')}), best AS (SELECT o.payload_id, o.company_slug, coalesce(json_extract(d.body, '$.offer'), o.item) AS item
    FROM offers o LEFT JOIN offer_details d ON d.company_slug = o.company_slug AND d.slug = o.item->>'$.slug' WHERE o.item->>'$.slug' <> '') {OFFER.format('best')}""",
)
def prefer_detail(i):
    rows = prefer_details(offer_items(i), scan_details(i.view("offer_details")))
    return _offer_shown(N.normalize_recruitee(rows, ("payload_id",)))


@query(
    "offer_problems",
    "L8",
    ["payloads"],
    f"""WITH offers AS ({items_sql('recruitee', '$.offers[*]')}) SELECT payload_id, 'id: not an integer' AS problem FROM offers WHERE TRY_CAST(item->>'$.id' AS BIGINT) IS NULL""",
)
def offer_problems(i):
    rows = offer_items(i).select("payload_id", offer_problem(F.col("item")).alias("problem"))
    return rows.filter(F.col("problem").isNotNull())


SMART_ITEMS = f"smart AS ({items_sql('smartrecruiters', '$.content[*]')})"


def smart_items(i: Inputs) -> DataFrame:
    return scan_payloads(i.view("payloads").filter("provider = 'smartrecruiters'"))


@query(
    "flat_smartrecruiters",
    "C10 B12 I9",
    ["payloads"],
    f"""WITH {SMART_ITEMS} SELECT payload_id, item->>'$.id' AS id, item->>'$.name' AS title,
    concat_ws(', ', item->>'$.location.city', item->>'$.location.region', item->>'$.location.country') || CASE WHEN item->>'$.location.remote' = 'true' THEN ' (Remote)' ELSE '' END AS location,
    item->>'$.department.label' AS department, item->>'$.typeOfEmployment.label' AS type, 'https://careers.smartrecruiters.com/' || company_slug || '/jobs/' || (item->>'$.id') AS url,
    coalesce(item->>'$.company.name', company_slug) AS company, md5(item->>'$.jobAd.sections.jobDescription.text') AS description_md5, item->>'$.createdDate' AS created_at
    FROM smart WHERE item->>'$.id' <> '' AND item->>'$.name' <> ''""",
)
def flat_smartrecruiters(i):
    rows = N.flatten_smartrecruiters(smart_items(i), ("payload_id",)).drop("raw")
    return rows.withColumn("description", F.md5("description")).withColumnRenamed("description", "description_md5")


@query(
    "deep_smartrecruiters",
    "C12 B13 B14 B16 I21",
    ["payloads"],
    f"""WITH {SMART_ITEMS} SELECT payload_id, coalesce(item->>'$.id', '') AS id, item->>'$.uuid' AS uuid, item->>'$.name' AS title, md5(item->>'$.jobAd.sections.jobDescription.text') AS description_md5,
    item->>'$.jobAd.sections.qualifications.text' AS requirements, coalesce(item->>'$.company.identifier', company_slug) AS company_identifier, coalesce(item->>'$.company.name', '') AS company_name,
    item->>'$.department.label' AS department_name, 1 AS n_locations, item->>'$.location.city' AS city, coalesce(CAST(item->>'$.location.remote' AS BOOLEAN), false) AS remote,
    CAST(item->>'$.location.latitude' AS DOUBLE) AS latitude, item->>'$.typeOfEmployment.label' AS employment_label,
    replace(replace(item->>'$.createdDate', 'T', ' '), 'Z', '') AS created_at, (item->>'$.releasedDate') || ' 00:00:00' AS released_date, true AS active,
    'https://careers.smartrecruiters.com/' || company_slug || '/jobs/' || (item->>'$.id') AS careers_url,
    CAST(coalesce(json_array_length(item, '$.customField'), 0) AS BIGINT) AS n_custom, item->>'$.customField[0].fieldLabel' AS custom_label, item->>'$.creator.name' AS creator_name FROM smart""",
)
def deep_smartrecruiters(i):
    rows = N.deepen_smartrecruiters(smart_items(i), ("payload_id",))
    return rows.select(
        "payload_id",
        "id",
        "uuid",
        "title",
        F.md5("description").alias("description_md5"),
        "requirements",
        F.col("company.identifier").alias("company_identifier"),
        F.col("company.name").alias("company_name"),
        F.col("department.name").alias("department_name"),
        F.size("locations").alias("n_locations"),
        F.get("locations", F.lit(0))["city"].alias("city"),
        F.get("locations", F.lit(0))["remote"].alias("remote"),
        F.get("locations", F.lit(0))["latitude"].alias("latitude"),
        F.col("employment_type.label").alias("employment_label"),
        stamp("created_at"),
        stamp("released_date"),
        "active",
        "careers_url",
        F.size("custom_fields").cast("bigint").alias("n_custom"),
        F.get("custom_fields", F.lit(0))["field_label"].alias("custom_label"),
        "creator_name",
    )


def flat_postings(i: Inputs) -> DataFrame:
    """The posting view in the flat shape the relational mapping takes."""
    return i.view("postings").select(
        "seq",
        F.col("job_id").alias("id"),
        "title",
        "location",
        F.col("job_type").alias("type"),
        F.lit("Research").alias("department"),
        F.col("apply_url").alias("url"),
        F.col("company_name").alias("company"),
        F.lower(F.replace("company_name", F.lit(" "), F.lit("-"))).alias("company_slug"),
        "description",
        F.date_format(F.timestamp_millis("created_at_ms"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit("2024-03-01").alias("updated_at"),
    )


JOB_COLUMNS = f"""seq, 'smartrecruiter' AS ats_source, lower(replace(company_name, ' ', '-')) AS company_slug, job_id, title AS job_title,
  coalesce(apply_url, '') AS job_url, md5(description) AS raw_md5, md5(trim(regexp_replace(description, '{SPACES}', ' ', 'g'))) AS cleaned_md5,
  strftime(make_timestamp(created_at_ms * 1000), '%Y-%m-%d %H:%M:%S') AS published_date, '2024-03-01 00:00:00' AS updated_date,
  coalesce(location, '') AS job_location, {part_sql(1)} AS city, {part_sql(2)} AS state, {part_sql(3)} AS country,
  {LOCATION_TYPE} AS work_location_type, {REMOTE_SCOPE} AS remote_scope, {EXPERIENCE} AS experience_level, {YEARS} AS years_experience_min,
  {MANAGEMENT} AS management_level, {EMPLOYMENT} AS employment_type, {EMPLOYMENT} AS job_type_label, {EDUCATION} AS education_required,
  'Research' AS industry_domain, 'scraped' AS processing_status, 'pending' AS sync_status, 'active' AS job_status, 0.95 :: DOUBLE AS ai_extraction_confidence,
  0 AS n_skills, false AS embeddings_generated, 0 AS reprocessing_retry_count, 'smartrecruiter_api' AS metadata_source"""


@query("ats_jobs_row", "C11 B21 I29 I4 I5 I6 I8 I24 I25 I26 I27 I28", ["postings"], f"SELECT {JOB_COLUMNS} FROM postings")
def ats_jobs_row(i):
    rows = N.to_ats_jobs(flat_postings(i), keep=("seq",))
    return rows.select(
        "seq",
        "ats_source",
        "company_slug",
        "job_id",
        "job_title",
        "job_url",
        F.md5("job_description_raw").alias("raw_md5"),
        F.md5("job_description_cleaned").alias("cleaned_md5"),
        stamp("published_date"),
        stamp("updated_date"),
        "job_location",
        "city",
        "state",
        "country",
        "work_location_type",
        "remote_scope",
        "experience_level",
        "years_experience_min",
        "management_level",
        "employment_type",
        F.col("job_type").alias("job_type_label"),
        "education_required",
        "industry_domain",
        "processing_status",
        "sync_status",
        "job_status",
        F.col("ai_extraction_confidence").cast("double").alias("ai_extraction_confidence"),
        F.size("required_skills").alias("n_skills"),
        "embeddings_generated",
        "reprocessing_retry_count",
        F.get_json_object("ai_processing_metadata", "$.source").alias("metadata_source"),
    )


@query(
    "mapping_errors",
    "C13",
    ["postings"],
    "SELECT job_id, title AS job_title, 'error' AS processing_status, 'created date not readable' AS error_message FROM postings WHERE title = ''",
)
def mapping_errors(i):
    flat = flat_postings(i).withColumn("raw", F.to_json(F.struct("id", "title")))
    rows = N.error_rows(flat, F.col("title") == "", F.lit("created date not readable"))
    return rows.select("job_id", "job_title", "processing_status", "error_message")


# ---- discovery payloads ----

ENTITY = """d_raw AS (SELECT crawl_id, seq, body FROM discoveries WHERE status = 200 AND contains(content_type, 'application/json')),
d_parts AS (
  SELECT crawl_id, seq, 0 AS part, unnest(json_extract(body, '$.included[*]')) AS item FROM d_raw
  UNION ALL SELECT crawl_id, seq, 1, unnest(json_extract(body, '$.elements[*]')) FROM d_raw
  UNION ALL SELECT crawl_id, seq, 2, unnest(json_extract(body, '$.data.jobCards[*]')) FROM d_raw
  UNION ALL SELECT crawl_id, seq, 3, json_extract(body, '$.data.jobOfTheDay') FROM d_raw),
entities AS (SELECT crawl_id, seq, part, item,
  coalesce(NULLIF(string_split(item->>'$.entityUrn', ':')[-1], ''), item->>'$.jobPostingId', item->>'$.id', string_split(item->>'$.trackingUrn', ':')[-1], '') AS job_id
  FROM d_parts WHERE json_type(item) = 'OBJECT' AND (part > 0 OR contains(lower(coalesce(item->>'$.entityUrn', item->>'$."$recipeType"', '')), 'jobposting')))"""

COMPANY_SQL = """CASE coalesce(json_type(c), 'NONE') WHEN 'VARCHAR' THEN c->>'$' WHEN 'OBJECT' THEN coalesce(c->>'$.name', c->>'$.companyName', c->>'$.company.name', item->>'$.companyName', '')
  ELSE coalesce(item->>'$.companyName', '') END"""
APPLY_SQL = """coalesce(CASE WHEN item->>'$.applyUrl' LIKE 'http%' THEN item->>'$.applyUrl' END,
  CASE WHEN json_type(item, '$.applyMethod') = 'OBJECT' THEN coalesce(item->>'$.applyMethod.url', item->>'$.applyMethod.companyApplyUrl') END,
  CASE WHEN item->>'$.externalApplyUrl' LIKE 'http%' THEN item->>'$.externalApplyUrl' END,
  item->>'$.companyApplyUrl.url')"""
DISCOVERED = f"""{ENTITY}, d_named AS (SELECT *, CASE WHEN json_extract(item, '$.companyDetails') IS NULL OR CAST(json_extract(item, '$.companyDetails') AS VARCHAR) = '{{}}' THEN json_extract(item, '$.company') ELSE json_extract(item, '$.companyDetails') END AS c FROM entities),
d_rows AS (SELECT crawl_id, seq, part, job_id, item->>'$.title' AS title, {COMPANY_SQL} AS company_name,
  coalesce(item->>'$.formattedLocation', CASE WHEN json_type(item, '$.location') = 'OBJECT' THEN item->>'$.location.name' ELSE item->>'$.location' END, '') AS location,
  NULLIF(coalesce(CASE WHEN json_type(item, '$.description') = 'VARCHAR' THEN item->>'$.description' END, item->>'$.description.text', ''), '') AS description,
  {APPLY_SQL} AS apply_url,
  CASE WHEN json_type(item, '$.applyMethod') = 'VARCHAR' THEN contains(lower(item->>'$.applyMethod'), 'easyapply')
    WHEN contains(coalesce(item->>'$.applyMethod."$type"', ''), 'SimpleOnSiteApply') THEN true ELSE coalesce(CAST(item->>'$.easyApply' AS BOOLEAN), false) END AS easy_apply
  FROM d_named)"""


def discovery_items(i: Inputs) -> DataFrame:
    return scan_job_entities(scan_captures(i.view("discoveries")))


@query(
    "job_entities",
    "A9 B1 B4",
    ["discoveries"],
    f"WITH {ENTITY} SELECT seq, job_id, count(*) AS n FROM entities GROUP BY ALL",
)
def job_entities(i):
    rows = discovery_items(i).select("seq", M.discovered_job_id(F.col("item")).alias("job_id"))
    return rows.groupBy("seq", "job_id").agg(F.count("*").alias("n"))


@query(
    "norm_discovery",
    "C7 B3 B5 B6 B7 I2 I12 I14 I15 D1",
    ["discoveries"],
    f"""WITH {DISCOVERED} SELECT crawl_id, seq, job_id, title, company_name, location, md5(description) AS description_hash, substr(description, 1, 500) AS description_snippet,
    'https://www.linkedin.com/jobs/view/' || job_id AS source_url, apply_url, {provider_sql('apply_url')} AS ats_provider, {origin_sql('apply_url')} AS job_origin, easy_apply,
    coalesce(NOT contains(apply_url, 'linkedin.com'), false) AS external_apply FROM d_rows WHERE job_id <> '' AND title <> '' AND company_name <> ''""",
)
def norm_discovery(i):
    rows = N.normalize_discoveries(discovery_items(i), keep=("crawl_id", "seq"))
    return rows.select(
        "crawl_id",
        "seq",
        "job_id",
        "title",
        "company_name",
        "location",
        "description_hash",
        "description_snippet",
        "source_url",
        "apply_url",
        "ats_provider",
        "job_origin",
        "easy_apply",
        "external_apply",
    )
