"""Queries over the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.functions import classify as C
from postmill.functions import dates as D
from postmill.functions import location as L
from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.operators.mappings import Context, greenhouse, named_value, recruitee
from postmill.plans.registry import query, stamp

HOST = r"^[a-z]+://([^/?#]*\.)?{}(:[0-9]+)?([/?#]|$)"


def provider_sql(c: str) -> str:
    rules = [
        ("greenhouse", r"greenhouse\.io"),
        ("lever", r"lever\.co"),
        ("workday", r"(myworkdayjobs|myworkdaysite)\.com"),
        ("ashby", r"ashbyhq\.com"),
        ("smartrecruiters", r"smartrecruiters\.com"),
        ("icims", r"icims\.com"),
        ("taleo", r"taleo\.net"),
        ("bamboohr", r"bamboohr\.com"),
        ("jobvite", r"jobvite\.com"),
    ]
    whens = " ".join(
        f"WHEN regexp_matches(lower({c}), '{HOST.replace('{}', p)}') THEN '{n}'" for n, p in rules
    )
    return f"(CASE WHEN {c} IS NULL THEN NULL {whens} ELSE 'unknown' END)"


def origin_sql(c: str) -> str:
    return (
        f"(CASE WHEN {c} IS NOT NULL AND NOT contains({c}, 'linkedin.com') AND {provider_sql(c)} <> 'unknown' "
        "THEN 'ATS' ELSE 'LINKEDIN_NATIVE' END)"
    )


PROVIDER = provider_sql("apply_url")
ORIGIN = origin_sql("apply_url")
LOCATION_TYPE = """CASE WHEN contains(lower(location), 'remote') THEN 'remote' WHEN contains(lower(location), 'hybrid') THEN 'hybrid'
  WHEN regexp_matches(lower(location), 'office|on-site|onsite') THEN 'on-site' ELSE 'not_specified' END"""
REMOTE_SCOPE = """CASE WHEN contains(lower(location), 'remote') THEN CASE WHEN regexp_matches(lower(location), 'anywhere|global') THEN 'anywhere'
  WHEN contains(lower(location), 'same country') THEN 'same_country' WHEN contains(lower(location), 'same timezone') THEN 'same_timezone'
  ELSE 'anywhere' END END"""
EMPLOYMENT = """CASE WHEN job_type IS NULL OR job_type = '' THEN NULL WHEN regexp_matches(lower(job_type), 'full|permanent') THEN 'full_time'
  WHEN contains(lower(job_type), 'part') THEN 'part_time' WHEN regexp_matches(lower(job_type), 'contract|temporary') THEN 'contract'
  WHEN contains(lower(job_type), 'intern') THEN 'internship' ELSE 'not_specified' END"""
EXPERIENCE = """CASE WHEN job_type IS NULL OR job_type = '' THEN NULL WHEN regexp_matches(lower(job_type), 'intern|entry|junior') THEN 'entry_level'
  WHEN regexp_matches(lower(job_type), 'mid|associate') THEN 'mid_level' WHEN regexp_matches(lower(job_type), 'senior|lead|principal') THEN 'senior_level'
  WHEN regexp_matches(lower(job_type), 'director|vp|head') THEN 'executive' ELSE 'not_specified' END"""
MANAGEMENT = """CASE WHEN regexp_matches(lower(title || ' ' || description), 'ceo|cto|cfo|president|director') THEN 'executive'
  WHEN regexp_matches(lower(title || ' ' || description), 'manager|head of|lead|supervisor') THEN 'manager'
  WHEN regexp_matches(lower(title || ' ' || description), 'senior|principal|staff') THEN 'senior_individual' ELSE 'individual_contributor' END"""
EDUCATION = r"""CASE WHEN description IS NULL OR description = '' THEN NULL WHEN regexp_matches(lower(description), 'phd|doctorate') THEN 'doctorate'
  WHEN regexp_matches(lower(description), 'master|m\.s\.') THEN 'masters' WHEN regexp_matches(lower(description), 'bachelor|b\.s\.') THEN 'bachelors'
  WHEN contains(lower(description), 'associate') THEN 'associate' ELSE 'not_specified' END"""
YEARS = r"""TRY_CAST(NULLIF(regexp_extract(lower(description), '(\d+)\+?\s*years?', 1), '') AS INTEGER)"""
SPACES = r"[\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def part_sql(n: int) -> str:
    return f"CASE WHEN location <> '' AND len(string_split(location, ',')) >= {n} THEN trim(string_split(location, ',')[{n}]) END"


@query(
    "provider_of_url",
    "I12 D10",
    ["postings"],
    f"SELECT seq, {PROVIDER} AS ats_provider FROM postings",
)
def provider_of_url(i):
    return i.view("postings").select("seq", U.provider_of_url("apply_url").alias("ats_provider"))


@query(
    "origin_flags",
    "I14 D8 D10",
    ["postings"],
    f"""SELECT seq, {ORIGIN} AS job_origin, apply_url IS NOT NULL AND NOT contains(apply_url, 'linkedin.com') AS external_apply,
    coalesce({PROVIDER} IN ('greenhouse','lever','ashby','smartrecruiters','workday'), false) AS has_api FROM postings""",
)
def origin_flags(i):
    provider = U.provider_of_url("apply_url")
    return i.view("postings").select(
        "seq",
        U.job_origin("apply_url", provider).alias("job_origin"),
        U.external_apply("apply_url").alias("external_apply"),
        F.coalesce(U.has_api(provider), F.lit(False)).alias("has_api"),
    )


SLUG = rf"""CASE {PROVIDER}
  WHEN 'greenhouse' THEN coalesce(NULLIF(regexp_extract(apply_url, 'boards\.greenhouse\.io/([^/?#]+)', 1), ''), NULLIF(regexp_extract(apply_url, 'embed/job_board/js\?for=([^&#]+)', 1), ''))
  WHEN 'lever' THEN NULLIF(regexp_extract(apply_url, 'lever\.co/([^/?#]+)', 1), '')
  WHEN 'ashby' THEN NULLIF(regexp_extract(apply_url, 'ashbyhq\.com/([^/?#]+)', 1), '')
  WHEN 'workday' THEN coalesce(NULLIF(regexp_extract(apply_url, 'myworkdayjobs\.com/(?:[a-z][a-z]-[A-Z][A-Z]/)?([^/?#]+)', 1), ''), NULLIF(regexp_extract(apply_url, 'myworkdaysite\.com/.*/([^/?#]+)', 1), ''))
  WHEN 'smartrecruiters' THEN NULLIF(regexp_extract(apply_url, '(?:jobs|careers)\.smartrecruiters\.com/([^/?#]+)', 1), '')
  END"""


@query("company_slug", "I18", ["postings"], f"SELECT seq, {SLUG} AS company_slug FROM postings")
def company_slug(i):
    return i.view("postings").select(
        "seq", U.company_slug(U.provider_of_url("apply_url"), "apply_url").alias("company_slug")
    )


@query(
    "workday_api_url",
    "I19 I11",
    ["postings"],
    rf"""SELECT seq, CASE
      WHEN regexp_extract(apply_url, '/d/([^/]+)/', 1) <> '' THEN split_part(apply_url, '/', 1) || '//' || split_part(apply_url, '/', 3) || '/wday/cxs/' || regexp_extract(apply_url, '/d/([^/]+)/', 1) || '/jobs1/jobs'
      ELSE split_part(apply_url, '/', 1) || '//' || split_part(apply_url, '/', 3) || '/wday/cxs/' || split_part(split_part(apply_url, '/', 3), '.', 1) || '/' || regexp_extract(apply_url, 'myworkdayjobs\.com/(?:[a-z][a-z]-[A-Z][A-Z]/)?([^/?#]+)', 1) || '/jobs' END AS api_url
    FROM postings WHERE contains(apply_url, 'myworkdayjobs.com')""",
)
def workday_api_url(i):
    rows = i.view("postings").filter(F.col("apply_url").contains("myworkdayjobs.com"))
    return rows.select("seq", U.workday_api_url("apply_url", F.lit("jobs1")).alias("api_url"))


@query(
    "url_parts",
    "I11 I37",
    ["postings"],
    r"""SELECT seq, regexp_extract(apply_url, '^([a-z]+)://[^/]+', 0) AS base_url, split_part(apply_url, '/', 3) AS authority,
    NULLIF(regexp_extract(apply_url, '[?&]for=([^&#]*)', 1), '') AS for_param,
    split_part(apply_url, '/api/', 1) || '/api' AS api_base,
    regexp_extract(apply_url, '^[a-z]+://[^/]+', 0) || '/x/' || seq AS joined_root,
    regexp_replace(split_part(split_part(apply_url, '?', 1), '#', 1), '[^/]*$', '') || 'y?z=1' AS joined_relative,
    'https://other.example.org/' || seq AS joined_absolute,
    split_part(apply_url, ':', 1) || '://cdn.example.org/a' AS joined_scheme
    FROM postings WHERE apply_url IS NOT NULL""",
)
def url_parts(i):
    rows = i.view("postings").filter("apply_url IS NOT NULL")
    seq = F.col("seq").cast("string")
    return rows.select(
        "seq",
        U.base_of("apply_url").alias("base_url"),
        U.authority_of("apply_url").alias("authority"),
        U.query_param("apply_url", "for").alias("for_param"),
        U.api_base("apply_url").alias("api_base"),
        U.join_url("apply_url", F.concat(F.lit("/x/"), seq)).alias("joined_root"),
        U.join_url("apply_url", F.lit("y?z=1")).alias("joined_relative"),
        U.join_url("apply_url", F.concat(F.lit("https://other.example.org/"), seq)).alias("joined_absolute"),
        U.join_url("apply_url", F.lit("//cdn.example.org/a")).alias("joined_scheme"),
    )


@query(
    "location_parts",
    "I5 I7 I10",
    ["postings"],
    f"""SELECT seq, {part_sql(1)} AS city, {part_sql(2)} AS state, {part_sql(3)} AS country,
    CASE job_type WHEN 'Remote' THEN 'remote' WHEN 'Hybrid' THEN 'hybrid' WHEN 'On-site' THEN 'on-site' ELSE 'not_specified' END AS workplace,
    NULLIF(concat_ws(', ', NULLIF({part_sql(1)}, ''), NULLIF({part_sql(2)}, ''), NULLIF({part_sql(3)}, '')), '') AS formatted,
    coalesce(NULLIF(concat_ws(', ', NULLIF({part_sql(1)}, ''), NULLIF({part_sql(3)}, '')), ''), 'Remote') AS short_form
    FROM postings""",
)
def location_parts(i):
    city, state, country = (L.location_part("location", n) for n in range(3))
    return i.view("postings").select(
        "seq",
        city.alias("city"),
        state.alias("state"),
        country.alias("country"),
        L.workplace_type("job_type").alias("workplace"),
        L.city_state_country(city, state, country).alias("formatted"),
        L.city_country_or_remote(city, country).alias("short_form"),
    )


@query(
    "work_location_type",
    "I6 I8",
    ["postings"],
    f"SELECT seq, {LOCATION_TYPE} AS work_location_type, {REMOTE_SCOPE} AS remote_scope FROM postings",
)
def work_location_type(i):
    return i.view("postings").select(
        "seq",
        L.work_location_type("location").alias("work_location_type"),
        L.remote_scope("location").alias("remote_scope"),
    )


@query(
    "format_location",
    "I9",
    ["postings"],
    f"""SELECT seq, CASE WHEN coalesce(location, '') = '' AND NOT contains(lower(coalesce(job_type, '')), 'full') THEN NULL ELSE
    concat_ws(', ', NULLIF({part_sql(1)}, ''), NULLIF({part_sql(2)}, ''), NULLIF({part_sql(3)}, '')) || CASE WHEN contains(lower(coalesce(job_type, '')), 'full') THEN ' (Remote)' ELSE '' END END AS shown
    FROM postings""",
)
def format_location(i):
    parts = [L.location_part("location", n) for n in range(3)]
    remote = F.lower("job_type").contains("full")
    return i.view("postings").select("seq", L.format_location(*parts, remote).alias("shown"))


@query(
    "employment_type",
    "I25",
    ["postings"],
    f"SELECT seq, {EMPLOYMENT} AS employment_type FROM postings",
)
def employment_type(i):
    return i.view("postings").select("seq", C.employment_type("job_type").alias("employment_type"))


@query(
    "experience_level",
    "I24",
    ["postings"],
    f"SELECT seq, {EXPERIENCE} AS experience_level FROM postings",
)
def experience_level(i):
    return i.view("postings").select("seq", C.experience_level("job_type").alias("experience_level"))


@query(
    "management_level",
    "I27",
    ["postings"],
    f"SELECT seq, {MANAGEMENT} AS management_level FROM postings",
)
def management_level(i):
    return i.view("postings").select("seq", C.management_level("title", "description").alias("management_level"))


@query("education", "I28", ["postings"], f"SELECT seq, {EDUCATION} AS education_required FROM postings")
def education(i):
    return i.view("postings").select("seq", C.education_level("description").alias("education_required"))


@query(
    "first_years_match", "I26", ["postings"], f"SELECT seq, {YEARS} AS years_experience_min FROM postings"
)
def first_years_match(i):
    return i.view("postings").select("seq", X.first_years_match("description").alias("years_experience_min"))


@query(
    "clean_text",
    "I4",
    None,
    f"SELECT doc_id, md5(trim(regexp_replace(text, '{SPACES}', ' ', 'g'))) AS cleaned_md5, length(trim(regexp_replace(text, '{SPACES}', ' ', 'g'))) AS cleaned_chars FROM documents",
)
def clean_text(i):
    cleaned = i.table("documents").select("doc_id", X.clean_text("text").alias("t"))
    return cleaned.select("doc_id", F.md5("t").alias("cleaned_md5"), F.char_length("t").cast("bigint").alias("cleaned_chars"))


@query(
    "snippet_hash",
    "I1 I2 I3",
    ["postings"],
    """SELECT seq, substr(description, 1, 500) AS description_snippet, md5(description) AS description_hash,
    substr(md5(title || company_name), 1, 12) AS short_id FROM postings""",
)
def snippet_hash(i):
    return i.view("postings").select(
        "seq",
        X.snippet("description").alias("description_snippet"),
        X.text_hash("description").alias("description_hash"),
        X.short_id("title", "company_name").alias("short_id"),
    )


@query(
    "page_urls_of_boards",
    "I13",
    ["postings"],
    """SELECT seq, CASE WHEN contains(apply_url, '?') THEN apply_url || '&start=20' ELSE apply_url || '?start=20' END AS page_2,
    replace(CASE WHEN contains(apply_url, '?') THEN apply_url || '&start=20' ELSE apply_url || '?start=20' END, 'start=20', 'start=40') AS page_3
    FROM postings WHERE apply_url IS NOT NULL""",
)
def page_urls_of_boards(i):
    rows = i.view("postings").filter("apply_url IS NOT NULL")
    rows = rows.select("seq", U.page_url("apply_url", F.lit(2)).alias("page_2"))
    return rows.select("seq", "page_2", U.page_url("page_2", F.lit(3)).alias("page_3"))


@query(
    "dates",
    "I20 I21 I22 I23",
    ["postings"],
    """SELECT seq, strftime(make_timestamp(created_at_ms * 1000), '%Y-%m-%d %H:%M:%S') AS from_millis,
    strftime(make_timestamp(created_at_ms * 1000), '%Y-%m-%d %H:%M:%S') AS from_iso,
    strftime(make_timestamp(created_at_ms * 1000), '%Y-%m-%d') || ' 00:00:00' AS from_day,
    strftime(make_timestamp(created_at_ms * 1000), '%Y-%m-%d %H:%M:%S') AS from_utc_text,
    strftime(make_timestamp(created_at_ms * 1000) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS from_offset,
    CAST(NULL AS VARCHAR) AS from_bad FROM postings""",
)
def dates(i):
    made = D.epoch_millis("created_at_ms")
    rows = i.view("postings").select("seq", made.alias("from_millis"))
    iso = F.date_format("from_millis", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shifted = F.date_format("from_millis", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    rows = rows.withColumns(
        {
            "from_iso": D.iso_timestamp(iso),
            "from_day": D.iso_or_day(F.date_format("from_millis", "yyyy-MM-dd")),
            "from_utc_text": D.iso_or_utc_text(F.date_format("from_millis", "yyyy-MM-dd HH:mm:ss' UTC'")),
            "from_offset": D.iso_timestamp(shifted),
            "from_bad": D.iso_or_utc_text(F.concat(F.lit("soon "), F.col("seq").cast("string"))),
        }
    )
    return rows.select("seq", *[stamp(c) for c in rows.columns if c != "seq"])


@query(
    "person_names",
    "I35 I36",
    ["clients"],
    r"""SELECT client_key, CASE WHEN trim(client_name) = '' THEN 'Valued' ELSE split_part(trim(client_name), ' ', 1) END AS first_name,
    CASE WHEN contains(trim(client_name), ' ') THEN substr(trim(client_name), strpos(trim(client_name), ' ') + 1) ELSE 'Client' END AS last_name,
    strftime(TRY_CAST(start_date AS DATE) + INTERVAL 1 YEAR, '%Y-%m-%d') AS end_date FROM clients""",
)
def person_names(i):
    start = F.to_date(F.try_to_timestamp("start_date", F.lit("yyyy-MM-dd")))
    return i.view("clients").select(
        "client_key",
        X.first_name("client_name").alias("first_name"),
        X.last_name("client_name").alias("last_name"),
        F.date_format(D.one_year_later(start), "yyyy-MM-dd").alias("end_date"),
    )


@query(
    "url_templates",
    "I31",
    ["payloads"],
    """SELECT payload_id, 'https://boards.greenhouse.io/' || company_slug || '/jobs/' || payload_id AS board_url,
    'https://' || company_slug || '.recruitee.com/o/o-' || payload_id AS careers_url,
    'https://' || company_slug || '.recruitee.com/o/o-' || payload_id || '/c/new' AS apply_url FROM payloads""",
)
def url_templates(i):
    rows = i.view("payloads").select("payload_id", "company_slug")
    made = F.format_string('{"id":%d,"title":"t","slug":"o-%d"}', "payload_id", "payload_id")
    rows = rows.withColumn("item", F.parse_json(made))
    none = F.lit(None).cast("string")
    board = greenhouse(F.col("item"), Context(F.col("company_slug"), none, none))
    offer = recruitee(F.col("item"), F.col("company_slug"), F.lit(False))
    return rows.select(
        "payload_id",
        board["source_url"].alias("board_url"),
        offer["careers_url"].alias("careers_url"),
        offer["apply_url"].alias("apply_url"),
    )


@query(
    "joined_description",
    "I30 B10",
    ["postings"],
    """SELECT seq, md5(CASE WHEN title = '' THEN description ELSE description || chr(10) || chr(10) || title END) AS text_md5 FROM postings""",
)
def joined_description(i):
    def entry(name: str, value: str):
        return F.struct(F.lit(name).alias("name"), F.col(value).alias("value"))

    details = F.array(entry("Description", "job_id"), entry("Description", "description"), entry("Requirements", "title"))
    joined = X.join_filled("\n\n", named_value(details, "Description", -1), named_value(details, "Requirements", -1))
    return i.view("postings").select("seq", F.md5(joined).alias("text_md5"))


@query(
    "total_jobs_text",
    "I33 F14",
    ["careers_pages"],
    r"""SELECT page_id, CAST(regexp_extract(html, '(\d+) Jobs Found', 1) AS BIGINT) AS total_jobs,
    CAST(greatest(1, ceil(CAST(regexp_extract(html, '(\d+) Jobs Found', 1) AS BIGINT) / 20.0)) AS BIGINT) AS total_pages FROM careers_pages""",
)
def total_jobs_text(i):
    rows = i.view("careers_pages").select("page_id", X.total_jobs_in_text("html").alias("total_jobs"))
    return rows.withColumn("total_pages", X.page_count("total_jobs"))
