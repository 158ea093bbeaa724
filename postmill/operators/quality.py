"""Validation: ordered reject reasons, table constraints, coverage, compliance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import text as X
from postmill.functions import variants as V
from postmill.operators import mappings as M
from postmill.operators.joins import lookup
from postmill.schemas import (
    DOMAINS,
    EMPTY_ARRAY_DEFAULTS,
    INSERT_DEFAULTS,
    MAX_LENGTH,
    NATURAL_KEY,
    POSTING,
    POSTING_REQUIRED,
    REMOTE_SCOPES,
)

# ---- fixed values: reject reasons, in order of precedence ----
MISSING_UID = "Missing uid"
MISSING_URL = "Missing position_url"
BAD_URL = "position_url returns non-200 status"
NO_DESCRIPTION = "details[] does not contain 'Description'"
GENERAL_TITLE = "Title contains 'General application'"
GENERAL_WORDS = "General application"


def latest_status(statuses: DataFrame) -> DataFrame:
    """Latest status per URL (integers only, so the aggregation stays hash-based)."""
    return statuses.groupBy("url").agg(F.max_by("status", "seq").alias("status"))


def with_url_status(rows: DataFrame, statuses: DataFrame, url: str) -> DataFrame:
    """Add ``url_ok``: the URL's latest status is 2xx; an unseen URL is not ok."""
    last = latest_status(statuses).select(F.col("url").alias(url), "status")
    joined = lookup(rows, last, [url])
    return joined.withColumn(
        "url_ok", F.coalesce(F.col("status").between(200, 299), F.lit(False))
    ).drop("status")


def reject_reason(item: Column, url_ok: Column) -> Column:
    """First rule a Comeet item breaks; null when it is valid. Empty details pass."""
    details = V.array(item, "$.details", M.NAME_VALUE)
    has_description = F.exists(details, lambda d: F.coalesce(d["name"] == "Description", F.lit(False)))
    title = F.coalesce(V.text(item, "$.name"), F.lit(""))
    return (
        F.when(V.filled(item, "$.uid").isNull(), MISSING_UID)
        .when(V.filled(item, "$.position_url").isNull(), MISSING_URL)
        .when(~url_ok, BAD_URL)
        .when((F.size(details) > 0) & ~has_description, NO_DESCRIPTION)
        .when(title.contains(GENERAL_WORDS), GENERAL_TITLE)
    )


def with_reject_reason(items: DataFrame, statuses: DataFrame) -> DataFrame:
    """Items with ``reason`` (null = valid); valid and rejected rows stay in one frame."""
    rows = items.withColumn("position_url", V.filled(F.col("item"), "$.position_url"))
    checked = with_url_status(rows, statuses, "position_url")
    return checked.withColumn("reason", reject_reason(F.col("item"), F.col("url_ok")))


def rejected_rows(checked: DataFrame) -> DataFrame:
    item = F.col("item")
    return checked.filter(F.col("reason").isNotNull()).select(
        "company_slug",
        V.text(item, "$.uid").alias("uid"),
        F.coalesce(V.text(item, "$.name"), F.lit("")).alias("title"),
        "reason",
    )


def reject_counts(checked: DataFrame) -> DataFrame:
    """Counts per reason plus the totals fetched, valid and rejected, in one aggregation."""
    by_reason = checked.groupBy("reason").agg(F.count("*").alias("n"))
    measures = F.array(
        F.struct(F.lit("total fetched").alias("measure"), F.col("n").alias("n")),
        F.struct(
            F.when(F.col("reason").isNull(), "total valid").otherwise("total rejected").alias("measure"),
            F.col("n").alias("n"),
        ),
        F.struct(F.col("reason").alias("measure"), F.col("n").alias("n")),
    )
    rows = by_reason.select(F.explode(measures).alias("m")).select("m.*")
    return rows.filter(F.col("measure").isNotNull()).groupBy("measure").agg(F.sum("n").alias("n"))


# ---- table constraints ----


def constraint_checks(columns: list[str], strict_remote_scope: bool = False) -> dict[str, Column]:
    """Constraint name -> violated (never null; null values pass every check), for the columns there are."""
    checks = {(f"not_null_{c}", c): F.col(c).isNull() for c in NATURAL_KEY}
    confidence = "ai_extraction_confidence"
    checks["valid_ai_confidence", confidence] = ~F.col(confidence).between(0, 1)
    for c, values in DOMAINS.items():
        checks[f"valid_{c}", c] = ~F.col(c).isin(*values)
    if strict_remote_scope:
        # As written the constraint's list holds a NULL and so never rejects.
        checks["valid_remote_scope", "remote_scope"] = ~F.col("remote_scope").isin(*REMOTE_SCOPES)
    for c, n in MAX_LENGTH.items():
        checks[f"length_{c}", c] = F.char_length(c) > n
    return {name: F.coalesce(bad, F.lit(False)) for (name, c), bad in checks.items() if c in columns}


def with_violations(rows: DataFrame, strict_remote_scope: bool = False) -> DataFrame:
    """Add ``violations``, the names of the constraints each row breaks."""
    checks = constraint_checks(rows.columns, strict_remote_scope)
    named = [F.when(bad, F.lit(n)) for n, bad in checks.items()]
    return rows.withColumn("violations", F.array_compact(F.array(*named)))


def violation_counts(rows: DataFrame, strict_remote_scope: bool = False) -> DataFrame:
    checked = with_violations(rows, strict_remote_scope).select(F.explode("violations").alias("rule"))
    return checked.groupBy("rule").agg(F.count("*").alias("n"))


def duplicate_keys(rows: DataFrame, keys: list[str] = NATURAL_KEY) -> DataFrame:
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > 1)


def apply_defaults(rows: DataFrame, now: Column) -> DataFrame:
    """Column defaults of a new row; values already present stay."""
    have = set(rows.columns)

    def get(c: str) -> Column:
        return F.col(c) if c in have else F.lit(None)

    out = {c: F.coalesce(get(c), F.lit(v)) for c, v in INSERT_DEFAULTS.items()}
    out |= {c: F.coalesce(get(c).cast("timestamp"), now) for c in ("created_at", "updated_at")}
    empty = F.array().cast("array<string>")
    out |= {c: F.coalesce(get(c).cast("array<string>"), empty) for c in EMPTY_ARRAY_DEFAULTS}
    return rows.withColumns(out)


# ---- record validation ----

# ---- fixed values: allowed values of the enumerated posting fields ----
POSTING_DOMAINS = {
    "source": ["linkedin", "career_page", "ats"],
    "job_origin": ["ATS", "LINKEDIN_NATIVE"],
    "ats_provider": [
        "workday",
        "greenhouse",
        "lever",
        "icims",
        "taleo",
        "bamboohr",
        "jobvite",
        "smartrecruiters",
        "ashby",
        "unknown",
    ],
}


def posting_problem(columns: list[str]) -> Column:
    """First problem of a loosely typed posting row; null when it is valid."""
    have = set(columns)
    expr = F
    for c in POSTING_REQUIRED:
        missing = F.col(c).isNull() if c in have else F.lit(True)
        expr = expr.when(missing, f"{c}: missing")
    for c, values in POSTING_DOMAINS.items():
        if c in have:
            expr = expr.when(~F.col(c).isin(*values), f"{c}: not allowed")
    for f in POSTING:
        if f.name in have and f.dataType.simpleString() in ("timestamp", "boolean"):
            typed = F.col(f.name).try_cast(f.dataType)
            expr = expr.when(F.col(f.name).isNotNull() & typed.isNull(), f"{f.name}: wrong type")
    return expr.otherwise(F.lit(None).cast("string"))


def validate_postings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed valid rows and the quarantine with its reason."""
    checked = rows.withColumn("problem", posting_problem(rows.columns))
    have = set(rows.columns)
    valid = checked.filter(F.col("problem").isNull()).select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in POSTING
        ]
    )
    return valid, checked.filter(F.col("problem").isNotNull())


def offer_problem(item: Column) -> Column:
    """First problem of a raw offer: an id that is no integer, or non-string slug or title."""

    def bad_text(path: str) -> Column:
        return V.has(item, path) & ~V.is_string(item, path)

    return (
        F.when(V.text(item, "$.id").try_cast("bigint").isNull(), "id: not an integer")
        .when(bad_text("$.slug"), "slug: not a string")
        .when(bad_text("$.title"), "title: not a string")
    )


# ---- coverage ----


def field_coverage(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Share of non-null values per field, in one pass."""
    present = [F.count(c).alias(c) for c in fields]
    counts = rows.agg(F.count("*").alias("n_rows"), *present)
    long = counts.unpivot("n_rows", fields, "field", "n_present")
    return long.withColumn("coverage", F.col("n_present") / F.greatest("n_rows", F.lit(1)))


def missing_fields(rows: DataFrame, fields: list[str]) -> list[str]:
    """Fields a table lacks; known from its schema, no job is run."""
    return [f for f in fields if f not in rows.columns]


def group_compliance(rows: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Per field group: are all fields there, and how many rows have them all filled."""
    have = set(rows.columns)

    def complete(names: list[str]) -> Column:
        tests = [F.col(n).isNotNull() if n in have else F.lit(False) for n in names]
        return reduce(lambda a, b: a & b, tests)

    counts = rows.agg(
        F.count("*").alias("n_rows"), *[F.count_if(complete(v)).alias(k) for k, v in groups.items()]
    )
    long = counts.unpivot("n_rows", list(groups), "field_group", "n_complete")
    present = F.create_map(
        *[x for k, v in groups.items() for x in (F.lit(k), F.lit(not missing_fields(rows, v)))]
    )
    return long.withColumn("fields_present", present[F.col("field_group")])


# ---- extraction quality ----

# ---- fixed values: weight and lowest acceptable coverage ----
QUALITY = {"title": (50, 0.9), "location": (30, 0.7), "URL": (20, 0.8)}


def extraction_quality(
    rows: DataFrame, title: str, location: str, url: str, by: list[str] | None = None, **more: Column
) -> DataFrame:
    """Coverage of three columns, weighted score 0-100 and the list of issues.

    ``more`` are further aggregates of the same pass.
    """
    names = {"title": title, "location": location, "URL": url}
    aggs = [F.avg(X.is_filled(c).cast("double")).alias(f"_{k}") for k, c in names.items()]
    aggs += [c.alias(n) for n, c in more.items()]
    stats = rows.groupBy(*(by or [])).agg(F.count("*").alias("n_jobs"), *aggs)
    share = {k: F.coalesce(F.col(f"_{k}"), F.lit(0.0)) for k in QUALITY}
    score = reduce(lambda a, b: a + b, [share[k] * w for k, (w, _) in QUALITY.items()])
    issues = [
        F.when(share[k] < low, F.concat(F.lit(f"Low {k} coverage: "), X.percent(share[k])))
        for k, (_, low) in QUALITY.items()
    ]
    return stats.select(
        *(by or []),
        "n_jobs",
        F.round(score, 1).alias("score"),
        score.alias("score_unrounded"),
        *[X.percent(share[k]).alias(f"{k.lower()}_coverage") for k in QUALITY],
        F.when(F.col("n_jobs") == 0, F.array(F.lit("No jobs extracted")))
        .otherwise(F.array_compact(F.array(*issues)))
        .alias("issues"),
        *more,
    )

