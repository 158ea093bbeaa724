"""Items -> target schemas, all providers in one narrow pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.functions import classify as C
from postmill.functions import dates as D
from postmill.functions import location as L
from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.operators import mappings as M
from postmill.schemas import ATS_JOBS, INSERT_DEFAULTS, NATURAL_KEY, POSTING
from postmill.sources.providers import PROVIDERS, Provider


def as_schema(df: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Select the schema's columns in order and type; absent ones become typed nulls."""
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    return df.select(*keep, *columns)


def _context(df: DataFrame) -> M.Context:
    def get(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    return M.Context(get("company_slug"), get("company_name"), get("base_url"))


def normalize_postings(
    items: DataFrame,
    captured: bool = False,
    providers: dict[str, Provider] = PROVIDERS,
    run_at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Exploded items of any provider -> POSTING rows; rows without id or title are dropped.

    ``captured`` picks the mappings for captured responses instead of the feeds.
    """
    specs = [p for p in providers.values() if (p.captured if captured else p.posting)]
    ctx, item, provider = _context(items), F.col("item"), F.col("provider")
    maps = {p.name: (p.captured if captured else p.posting)(item, ctx) for p in specs}
    out = items.filter(provider.isin(*maps))
    need_base = [p.name for p in specs if p.needs_base_url]
    if need_base:
        out = out.filter(~provider.isin(*need_base) | X.is_filled(ctx.base_url))

    def per_provider(field: str) -> Column:
        if len(maps) == 1:
            only = next(iter(maps.values()))
            return only.get(field, F.lit(None))
        hits = [(provider == n, m[field]) for n, m in maps.items() if field in m]
        return reduce(lambda e, hit: e.when(*hit), hits, F).otherwise(F.lit(None))

    names = list(dict.fromkeys(f for m in maps.values() for f in m))
    kept = list(dict.fromkeys([*keep, "provider"]))
    mapped = out.select(
        *[c for c in kept if c != "company_name"],
        ctx.company_name.alias("company_name"),
        *[per_provider(f).alias(f) for f in names],
    )
    no_id = [p.name for p in specs if not p.id_required]
    rows = mapped.filter(X.is_filled("title") & (X.is_filled("job_id") | provider.isin(*no_id)))
    rows = rows.withColumns(
        {
            "easy_apply": F.lit(False),
            "external_apply": F.lit(False),
            "extracted_at": run_at if run_at is not None else F.lit(None).cast("timestamp"),
        }
    )
    return as_schema(rows, POSTING, *[c for c in keep if c not in POSTING.names])


def normalize_discoveries(items: DataFrame, run_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Discovery entities -> POSTING rows; id, title and company are required."""
    read = items.select(*keep, *[c.alias(n) for n, c in M.discovered(F.col("item")).items()])
    # a second projection, so what several fields derive from is read only once
    mapped = read.withColumn("ats_provider", U.provider_of_url("apply_url"))
    mapped = mapped.withColumns(M.derived_discovery())
    rows = mapped.filter(X.is_filled("job_id") & X.is_filled("title") & X.is_filled("company_name"))
    if run_at is not None:
        rows = rows.withColumn("extracted_at", run_at)
    return as_schema(rows, POSTING, *keep)


def normalize_comeet(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Comeet items -> 23 columns of the relational table."""
    fields = M.comeet(F.col("item"), F.col("company_slug"))
    return items.select(*keep, *[c.alias(n) for n, c in fields.items()])


def normalize_recruitee(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Recruitee items -> nested records; rows whose id or text fields have the wrong type are dropped."""
    from_detail = F.col("from_detail") if "from_detail" in items.columns else F.lit(False)
    fields = M.recruitee(F.col("item"), F.col("company_slug"), from_detail)
    rows = items.select(*keep, *[c.alias(n) for n, c in fields.items()])
    return rows.filter(F.col("id").isNotNull())


def flatten_smartrecruiters(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """SmartRecruiters items -> flat rows with id and title."""
    fields = M.smartrecruiters_flat(F.col("item"), F.col("company_slug"))
    rows = items.select(*[k for k in keep], *[c.alias(n) for n, c in fields.items()])
    return rows.filter(X.is_filled("id") & X.is_filled("title"))


def deepen_smartrecruiters(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """SmartRecruiters items -> the deep nested record."""
    from_detail = F.col("from_detail") if "from_detail" in items.columns else F.lit(False)
    fields = M.smartrecruiters_deep(F.col("item"), F.col("company_slug"), from_detail)
    return items.select(*keep, *[c.alias(n) for n, c in fields.items()])


# ---- fixed values ----
FLAT_SOURCE = "smartrecruiter"
FLAT_CONFIDENCE = 0.95
PROCESSING_METADATA = (
    '{"source":"smartrecruiter_api","extraction_method":"api_first",'
    '"confidence_factors":["api_source","structured_data"]}'
)
EMPTY_LISTS = [
    "required_skills",
    "preferred_skills",
    "certifications_required",
    "licenses_required",
    "languages_required",
    "languages_preferred",
    "extraction_errors",
    "multiple_locations",
    "key_responsibilities",
    "project_types",
]


def surrogate_id() -> Column:
    return F.xxhash64(*NATURAL_KEY)


def to_ats_jobs(flat: DataFrame, run_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat rows -> full relational rows with every classifier applied.

    Takes ``id, title, location, department, type, url, company, company_slug, description,
    created_at, updated_at, raw``; those a source lacks are read as missing.
    """
    have = set(flat.columns)

    def get(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    def text(name: str) -> Column:
        return F.coalesce(get(name), F.lit(""))

    now = run_at if run_at is not None else F.lit(None).cast("timestamp")
    # the long text is lowercased once, below the projection that reads it several times
    flat = flat.withColumns(
        {"_low": F.lower(get("description")), "_low_all": C.title_and_text(get("title"), get("description"))}
    )
    fields = {
        "ats_source": F.lit(FLAT_SOURCE),
        "company_slug": get("company_slug"),
        "job_id": text("id"),
        "job_title": text("title"),
        "job_url": text("url"),
        "apply_url": text("url"),
        "job_description_raw": text("description"),
        "job_description_cleaned": X.clean_text(get("description")),
        "published_date": D.iso_or_day(get("created_at")),
        "updated_date": D.iso_or_day(get("updated_at")),
        "created_at": now,
        "updated_at": now,
        "job_location": text("location"),
        "city": L.location_part(get("location"), 0),
        "state": L.location_part(get("location"), 1),
        "country": L.location_part(get("location"), 2),
        "work_location_type": L.work_location_type(get("location")),
        "experience_level": C.experience_level(get("type")),
        "years_experience_min": X.years_of(F.col("_low")),
        "management_level": C.management_of(F.col("_low_all")),
        "employment_type": C.employment_type(get("type")),
        "job_type": C.employment_type(get("type")),
        "industry_domain": get("department"),
        "job_function": get("department"),
        "education_required": C.education_of(F.col("_low")),
        "processing_status": F.lit("scraped"),
        "ai_extraction_confidence": F.lit(FLAT_CONFIDENCE),
        "raw_data": get("raw"),
        "sync_status": F.lit(INSERT_DEFAULTS["sync_status"]),
        "company_name": get("company"),
        "ai_processing_metadata": F.lit(PROCESSING_METADATA),
        "job_status": F.lit(INSERT_DEFAULTS["job_status"]),
        "remote_scope": L.remote_scope(get("location")),
        "embeddings_generated": F.lit(INSERT_DEFAULTS["embeddings_generated"]),
        "reprocessing_retry_count": F.lit(INSERT_DEFAULTS["reprocessing_retry_count"]),
        **{c: F.array().cast("array<string>") for c in EMPTY_LISTS},
    }
    rows = flat.select(*keep, *[c.alias(n) for n, c in fields.items()])
    return as_schema(rows.withColumn("id", surrogate_id()), ATS_JOBS, *keep)


def error_rows(flat: DataFrame, failed: Column, message: Column) -> DataFrame:
    """Rows that could not be mapped, as minimal relational rows with status ``error``."""
    rows = flat.filter(failed).select(
        F.lit(FLAT_SOURCE).alias("ats_source"),
        "company_slug",
        F.coalesce("id", F.lit("")).alias("job_id"),
        F.coalesce("title", F.lit("")).alias("job_title"),
        F.lit("error").alias("processing_status"),
        message.alias("error_message"),
        F.col("raw").alias("raw_data"),
    )
    return as_schema(rows.withColumn("id", surrogate_id()), ATS_JOBS)
