"""Target schemas, column limits, defaults and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)
STRINGS = T.ArrayType(S)
VECTOR = T.ArrayType(T.FloatType())


def _struct(required: set[str], **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


POSTING = _struct(
    {"job_id", "title", "company_name", "source", "source_url"},
    job_id=S,
    title=S,
    company_name=S,
    location=S,
    description_hash=S,
    description_snippet=S,
    posted_date=TS,
    source=S,
    source_url=S,
    apply_url=S,
    ats_provider=S,
    job_origin=S,
    company_career_url=S,
    easy_apply=B,
    external_apply=B,
    extracted_at=TS,
    extraction_method=S,
)

# The serial id of the relational table becomes a hash of the natural key.
ATS_JOBS = _struct(
    {"id", "ats_source", "company_slug", "job_id"},
    id=L,
    ats_source=S,
    company_slug=S,
    job_id=S,
    job_title=S,
    job_url=S,
    apply_url=S,
    job_description_raw=S,
    job_description_cleaned=S,
    published_date=TS,
    updated_date=TS,
    created_at=TS,
    updated_at=TS,
    job_location=S,
    city=S,
    state=S,
    country=S,
    postal_code=S,
    work_location_type=S,
    salary_min=I,
    salary_max=I,
    salary_currency=S,
    salary_type=S,
    equity_offered=B,
    visa_sponsorship_available=B,
    visa_sponsorship_text=S,
    relocation_assistance=B,
    experience_level=S,
    years_experience_min=I,
    management_level=S,
    required_skills=STRINGS,
    preferred_skills=STRINGS,
    certifications_required=STRINGS,
    licenses_required=STRINGS,
    employment_type=S,
    job_type=S,
    contract_duration=S,
    industry_domain=S,
    sector=S,
    job_function=S,
    education_required=S,
    degree_field=S,
    retirement_401k=B,
    work_hours_per_week=I,
    languages_required=STRINGS,
    languages_preferred=STRINGS,
    job_embedding=VECTOR,
    processing_status=S,
    ai_extraction_confidence=T.DecimalType(3, 2),
    extraction_errors=STRINGS,
    raw_data=S,
    sync_status=S,
    error_message=S,
    last_processed=TS,
    company_name=S,
    ai_processing_metadata=S,
    job_status=S,
    remote_scope=S,
    multiple_locations=STRINGS,
    key_responsibilities=STRINGS,
    project_types=STRINGS,
    skills_embedding=VECTOR,
    responsibilities_embedding=VECTOR,
    project_context_embedding=VECTOR,
    searchable_embedding=VECTOR,
    embeddings_generated=B,
    embeddings_generated_at=TS,
    reprocessing_retry_count=I,
)

# ---- fixed values: natural key, required columns, domains, limits, defaults ----
NATURAL_KEY = ["ats_source", "company_slug", "job_id"]
POSTING_REQUIRED = ["job_id", "title", "company_name", "source", "source_url"]
CSV_COLUMNS = [
    "job_id",
    "title",
    "company_name",
    "location",
    "apply_url",
    "ats_provider",
    "job_origin",
    "source_url",
    "extracted_at",
    "extraction_method",
    "easy_apply",
    "external_apply",
]
FIELD_GROUPS = {
    "core": ["ats_source", "company_slug", "job_id", "job_title", "job_url"],
    "processing": ["processing_status", "job_status", "ai_extraction_confidence"],
    "location": ["job_location", "city", "country", "work_location_type"],
    "employment": ["employment_type", "experience_level", "management_level"],
    "required": [
        "ats_source",
        "company_slug",
        "job_id",
        "job_title",
        "job_url",
        "job_description_raw",
        "processing_status",
        "job_status",
        "created_at",
    ],
}
DOMAINS = {
    "job_status": ["active", "expired"],
    "sync_status": ["pending", "synced", "failed"],
    "work_location_type": ["remote", "hybrid", "on-site", "not_specified"],
}
REMOTE_SCOPES = ["anywhere", "same_country", "same_timezone"]
MAX_LENGTH = {
    "ats_source": 50,
    "company_slug": 255,
    "job_id": 255,
    "city": 255,
    "state": 100,
    "country": 100,
    "postal_code": 20,
    "work_location_type": 50,
    "salary_currency": 10,
    "salary_type": 20,
    "experience_level": 50,
    "management_level": 50,
    "employment_type": 50,
    "job_type": 50,
    "contract_duration": 100,
    "industry_domain": 100,
    "sector": 100,
    "job_function": 100,
    "education_required": 50,
    "degree_field": 100,
    "processing_status": 50,
    "sync_status": 50,
    "company_name": 255,
    "job_status": 20,
    "remote_scope": 50,
}
INSERT_DEFAULTS = {
    "processing_status": "pending",
    "sync_status": "pending",
    "job_status": "active",
    "embeddings_generated": False,
    "reprocessing_retry_count": 0,
}
EMPTY_ARRAY_DEFAULTS = ["key_responsibilities", "project_types"]
