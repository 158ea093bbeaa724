"""Item -> target-field mappings, one function per provider shape.

``item`` is a VARIANT object; a missing key and a JSON null both mean missing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions import dates as D
from postmill.functions import location as L
from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.functions import variants as V

def _empty() -> Column:
    return F.lit("")


class Context(NamedTuple):
    """Columns of the payload row a mapping may need."""

    company_slug: Column
    company_name: Column
    base_url: Column


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, _empty())


def _ats(provider: str, method: str, job_id: Column, title: Column, location: Column, url: Column,
         apply_url: Column | None = None, **more: Column) -> dict[str, Column]:
    return {
        "job_id": job_id,
        "title": title,
        "location": _or_empty(location),
        "source": F.lit("ats"),
        "source_url": url,
        "apply_url": url if apply_url is None else apply_url,
        "ats_provider": F.lit(provider),
        "job_origin": F.lit("ATS"),
        "extraction_method": F.lit(method),
        **more,
    }


# ---- the five feeds with an API ----


def greenhouse(item: Column, ctx: Context) -> dict[str, Column]:
    job_id = V.text(item, "$.id")
    board = F.concat(F.lit("https://boards.greenhouse.io/"), ctx.company_slug, F.lit("/jobs/"), job_id)
    return _ats(
        "greenhouse",
        "ats_api",
        job_id,
        V.string(item, "$.title"),
        V.text(item, "$.location.name"),
        F.coalesce(V.text(item, "$.absolute_url"), board),
        posted_date=D.iso_timestamp(V.text(item, "$.updated_at")),
    )


def lever(item: Column, ctx: Context) -> dict[str, Column]:
    job_id = V.text(item, "$.id")
    hosted = F.concat(F.lit("https://jobs.lever.co/"), ctx.company_slug, F.lit("/"), job_id)
    url = F.coalesce(V.text(item, "$.hostedUrl"), hosted)
    description = V.string(item, "$.descriptionPlain")
    return _ats(
        "lever",
        "ats_api",
        job_id,
        V.string(item, "$.text"),
        V.text(item, "$.categories.location"),
        url,
        F.coalesce(V.text(item, "$.applyUrl"), url),
        posted_date=D.epoch_millis(V.text(item, "$.createdAt")),
        description_hash=X.text_hash(description),
        description_snippet=X.snippet(description),
    )


def ashby(item: Column, ctx: Context) -> dict[str, Column]:
    job_id = V.text(item, "$.id")
    board = F.concat(F.lit("https://jobs.ashbyhq.com/"), ctx.company_slug, F.lit("/"), job_id)
    return _ats(
        "ashby",
        "ats_api",
        job_id,
        V.string(item, "$.title"),
        V.string(item, "$.location"),
        F.coalesce(V.text(item, "$.jobUrl"), board),
    )


def _workday(item: Column, ctx: Context, method: str, url: Column, **more: Column) -> dict[str, Column]:
    title = V.string(item, "$.title")
    bullet = F.get(V.array(item, "$.bulletFields", "string"), F.lit(0))
    return _ats(
        "workday",
        method,
        F.coalesce(bullet, X.short_id(title, ctx.company_name)),
        title,
        F.coalesce(V.filled(item, "$.locationsText"), V.string(item, "$.location")),
        url,
        **more,
    )


def workday(item: Column, ctx: Context) -> dict[str, Column]:
    path = V.filled(item, "$.externalPath")
    url = F.when(path.isNotNull(), U.join_url(U.base_of(ctx.base_url), path)).otherwise(ctx.base_url)
    posted = D.iso_timestamp(V.text(item, "$.postedOn"))
    return _workday(item, ctx, "ats_api", url, posted_date=posted)


def smartrecruiters(item: Column, ctx: Context) -> dict[str, Column]:
    job_id = F.coalesce(V.filled(item, "$.id"), V.text(item, "$.uuid"))
    region = V.filled(item, "$.location.region")
    place = F.concat(
        _or_empty(V.text(item, "$.location.city")),
        F.coalesce(F.concat(F.lit(", "), region), _empty()),
    )
    url = F.concat(F.lit("https://jobs.smartrecruiters.com/"), ctx.company_slug, F.lit("/"), job_id)
    return _ats("smartrecruiters", "ats_api", job_id, V.string(item, "$.name"), place, url)


# ---- the same postings seen in captured responses: no date, no URL default ----


def greenhouse_captured(item: Column, ctx: Context) -> dict[str, Column]:
    return _ats(
        "greenhouse",
        "network_interception",
        V.text(item, "$.id"),
        V.string(item, "$.title"),
        V.text(item, "$.location.name"),
        _or_empty(V.text(item, "$.absolute_url")),
    )


def lever_captured(item: Column, ctx: Context) -> dict[str, Column]:
    url = _or_empty(V.text(item, "$.hostedUrl"))
    return _ats(
        "lever",
        "network_interception",
        V.text(item, "$.id"),
        V.string(item, "$.text"),
        V.text(item, "$.categories.location"),
        url,
        F.coalesce(V.text(item, "$.applyUrl"), url),
    )


def workday_captured(item: Column, ctx: Context) -> dict[str, Column]:
    path = V.filled(item, "$.externalPath")
    url = F.coalesce(F.concat(U.base_of(ctx.base_url), path), ctx.base_url)
    return _workday(item, ctx, "network_interception", url)


# ---- discovery entities ----


def discovered_job_id(item: Column) -> Column:
    """Tail of the entity URN, else posting id, else id, else tail of the tracking URN."""

    def tail(path: str) -> Column:
        return X.blank_to_null(F.substring_index(V.text(item, path), ":", -1))

    return F.coalesce(
        tail("$.entityUrn"),
        V.filled(item, "$.jobPostingId"),
        V.filled(item, "$.id"),
        tail("$.trackingUrn"),
        _empty(),
    )


def discovered_company(item: Column) -> Column:
    """Company from ``companyDetails`` or ``company``: object, nested object or string."""
    details = F.when(V.truthy(item, "$.companyDetails"), V.node(item, "$.companyDetails"))
    data = F.coalesce(details, V.node(item, "$.company"))
    return (
        F.when(V.is_string(data), V.text(data, "$"))
        .when(
            V.is_object(data),
            F.coalesce(
                V.filled(data, "$.name"),
                V.filled(data, "$.companyName"),
                F.when(V.is_object(data, "$.company"), _or_empty(V.text(data, "$.company.name"))),
                V.text(item, "$.companyName"),
                _empty(),
            ),
        )
        .otherwise(_or_empty(V.text(item, "$.companyName")))
    )


def discovered_location(item: Column) -> Column:
    formatted = F.when(V.truthy(item, "$.formattedLocation"), V.node(item, "$.formattedLocation"))
    data = F.coalesce(formatted, V.node(item, "$.location"))
    return (
        F.when(V.is_string(data), V.text(data, "$"))
        .when(
            V.is_object(data),
            F.coalesce(V.filled(data, "$.defaultLocalizedName"), V.text(data, "$.name"), _empty()),
        )
        .otherwise(_or_empty(V.text(item, "$.locationName")))
    )


def discovered_description(item: Column) -> Column:
    return F.coalesce(
        V.string(item, "$.description"),
        V.filled(item, "$.description.text"),
        V.text(item, "$.description.rawText"),
        _empty(),
    )


# ---- fixed values: keys probed for the apply URL, in order ----
APPLY_URL_KEYS = ["applyUrl", "applyMethod", "externalApplyUrl", "companyApplyUrl", "offSiteApplyUrl"]
EASY_APPLY_MARK = "SimpleOnSiteApply"


def discovered_apply_url(item: Column) -> Column:
    """First usable apply URL: an http string, or ``url``/``companyApplyUrl`` of an object.

    The off-site apply method needs no rule of its own: its ``companyApplyUrl`` is already
    read by the object form.
    """
    tries = []
    for key in APPLY_URL_KEYS:
        plain = V.string(item, f"$.{key}")
        tries += [
            F.when(plain.startswith("http"), plain),
            V.filled(item, f"$.{key}.url"),
            V.filled(item, f"$.{key}.companyApplyUrl"),
        ]
    return F.coalesce(*tries)


def discovered_easy_apply(item: Column) -> Column:
    """By the type of the apply method, else the string form, else the flag."""
    plain = V.string(item, "$.applyMethod")
    type_text = F.coalesce(V.filled(item, "$.applyMethod['$type']"), V.text(item, "$.applyMethod.type"), _empty())
    by_type = F.lower(type_text).contains("easyapply") | type_text.contains(EASY_APPLY_MARK)
    return (
        F.when(plain.isNotNull(), F.lower(plain).contains("easyapply"))
        .when(by_type, True)
        .otherwise(F.coalesce(V.text(item, "$.easyApply").try_cast("boolean"), F.lit(False)))
    )


def discovered(item: Column) -> dict[str, Column]:
    """What is read from the entity itself."""
    return {
        "job_id": discovered_job_id(item),
        "title": V.string(item, "$.title"),
        "company_name": discovered_company(item),
        "location": discovered_location(item),
        "description": discovered_description(item),
        "apply_url": discovered_apply_url(item),
        "easy_apply": discovered_easy_apply(item),
    }


def derived_discovery() -> dict[str, Column]:
    """What follows from the fields read (and ``ats_provider``)."""
    return {
        "description_hash": X.text_hash("description"),
        "description_snippet": X.snippet("description"),
        "source": F.lit("linkedin"),
        "source_url": F.concat(F.lit("https://www.linkedin.com/jobs/view/"), "job_id"),
        "job_origin": U.job_origin("apply_url", F.col("ats_provider")),
        "external_apply": U.external_apply("apply_url"),
        "extraction_method": F.lit("api"),
    }


# ---- feeds that map straight to the relational table or a nested record ----


def named_value(items: Column, name: str, position: int) -> Column:
    """Value of the first (1) or last (-1) ``{name, value}`` entry with that name."""
    hits = F.filter(items, lambda e: e["name"] == name)
    return F.try_element_at(hits, F.lit(position))["value"]


NAME_VALUE = "struct<name:string,value:string>"
# ---- fixed values: keys kept in the rebuilt raw object ----
COMEET_RAW_KEYS = [
    "uid",
    "name",
    "department",
    "employment_type",
    "experience_level",
    "workplace_type",
    "categories",
    "details",
    "location",
    "position_url",
    "time_updated",
]


def comeet(item: Column, company_slug: Column) -> dict[str, Column]:
    details = V.array(item, "$.details", NAME_VALUE)
    city, state, country = (V.text(item, f"$.location.{k}") for k in ("city", "state", "country"))
    position_url = V.text(item, "$.position_url")
    return {
        "ats_source": F.lit("Comeet"),
        "company_slug": company_slug,
        "job_id": V.text(item, "$.uid"),
        "job_title": _or_empty(V.text(item, "$.name")),
        "job_url": F.coalesce(
            V.filled(item, "$.url_active_page"), V.filled(item, "$.url_comeet_hosted_page"), position_url
        ),
        "apply_url": position_url,
        "job_description_raw": X.join_filled(
            "\n\n", named_value(details, "Description", -1), named_value(details, "Requirements", -1)
        ),
        "job_description_cleaned": F.lit(None).cast("string"),
        "published_date": F.lit(None).cast("timestamp"),
        "updated_date": D.iso_timestamp(V.text(item, "$.time_updated")),
        "job_location": L.city_state_country(city, state, country),
        "city": city,
        "state": state,
        "country": country,
        "postal_code": V.text(item, "$.location.postal_code"),
        "work_location_type": L.workplace_type(V.text(item, "$.workplace_type")),
        "experience_level": _or_empty(V.text(item, "$.experience_level")),
        "employment_type": _or_empty(V.text(item, "$.employment_type")),
        "job_function": named_value(V.array(item, "$.categories", NAME_VALUE), "Function", 1),
        "company_name": _or_empty(V.text(item, "$.company_name")),
        "raw_data": F.to_json(F.struct(*[V.node(item, f"$.{k}").alias(k) for k in COMEET_RAW_KEYS])),
        "processing_status": F.lit("scraped"),
        "job_status": F.lit("active"),
    }


LOCATIONS = "struct<city:string,country:string,country_code:string,region:string>"


def recruitee(item: Column, company_slug: Column, from_detail: Column) -> dict[str, Column]:
    slug = _or_empty(V.text(item, "$.slug"))
    base = F.concat(F.lit("https://"), company_slug, F.lit(".recruitee.com"))
    careers = F.when(slug != "", F.concat(base, F.lit("/o/"), slug))
    remote = V.truthy(item, "$.remote")
    locations = F.coalesce(
        V.array(item, "$.locations", LOCATIONS), F.array().cast(f"array<{LOCATIONS}>")
    )
    department = (
        F.when(
            V.is_object(item, "$.department"),
            F.struct(
                V.text(item, "$.department.id").try_cast("bigint").alias("id"),
                V.text(item, "$.department.name").alias("name"),
            ),
        )
        .when(
            V.is_string(item, "$.department") & V.filled(item, "$.department").isNotNull(),
            F.struct(F.lit(None).cast("bigint").alias("id"), V.text(item, "$.department").alias("name")),
        )
    )
    return {
        "id": V.text(item, "$.id").try_cast("bigint"),
        "slug": slug,
        "title": _or_empty(V.text(item, "$.title")),
        "description": V.text(item, "$.description"),
        "requirements": V.text(item, "$.requirements"),
        "department": department,
        "locations": F.transform(locations, lambda x: x.withField("remote", remote)),
        "employment_type": V.text(item, "$.employment_type_code"),
        "experience_level": V.text(item, "$.experience_code"),
        "education_level": V.text(item, "$.education_code"),
        "remote_option": V.text(item, "$.remote"),
        "salary_min": V.text(item, "$.min_salary").try_cast("double"),
        "salary_max": V.text(item, "$.max_salary").try_cast("double"),
        "salary_currency": V.text(item, "$.salary_currency"),
        "created_at": D.iso_or_utc_text(V.text(item, "$.created_at")),
        "published_at": D.iso_or_utc_text(V.text(item, "$.published_at")),
        "careers_url": careers,
        "apply_url": F.coalesce(
            V.filled(item, "$.careers_apply_url"), F.concat(careers, F.lit("/c/new"))
        ),
        "company_slug": company_slug,
        "raw_data": F.when(from_detail, F.to_json(item)),
    }


# ---- fixed values: sections that may hold the description, in order ----
DESCRIPTION_SECTIONS = ["jobDescription", "description", "about"]


def section_text(item: Column) -> Column:
    """Text of the first section whose key is present (its text may be null)."""
    expr = F
    for key in DESCRIPTION_SECTIONS:
        expr = expr.when(V.has(item, f"$.jobAd.sections.{key}"), V.text(item, f"$.jobAd.sections.{key}.text"))
    return expr.otherwise(F.lit(None).cast("string"))


def smartrecruiters_flat(item: Column, company_slug: Column) -> dict[str, Column]:
    where = {k: V.text(item, f"$.location.{k}") for k in ("city", "region", "country")}
    return {
        "id": V.text(item, "$.id"),
        "title": V.text(item, "$.name"),
        "location": L.format_location(
            where["city"], where["region"], where["country"], V.truthy(item, "$.location.remote")
        ),
        "department": V.text(item, "$.department.label"),
        "type": V.text(item, "$.typeOfEmployment.label"),
        "url": F.concat(
            F.lit("https://careers.smartrecruiters.com/"), company_slug, F.lit("/jobs/"), V.text(item, "$.id")
        ),
        "company": F.coalesce(V.text(item, "$.company.name"), company_slug),
        "description": section_text(item),
        "created_at": V.text(item, "$.createdDate"),
        "raw": F.to_json(item),
    }


def _labelled(item: Column, path: str) -> Column:
    return F.when(
        V.is_object(item, path),
        F.struct(V.text(item, f"{path}.id").alias("id"), V.text(item, f"{path}.label").alias("label")),
    )


CUSTOM_FIELD = "struct<fieldId:string,fieldLabel:string,valueId:string,valueLabel:string>"
SECTIONS = "map<string,struct<title:string,text:string>>"


def smartrecruiters_deep(item: Column, company_slug: Column, from_detail: Column) -> dict[str, Column]:
    place = F.struct(
        V.text(item, "$.location.city").alias("city"),
        V.text(item, "$.location.country").alias("country"),
        V.text(item, "$.location.region").alias("region"),
        F.coalesce(V.text(item, "$.location.remote").try_cast("boolean"), F.lit(False)).alias("remote"),
        V.filled(item, "$.location.latitude").try_cast("double").alias("latitude"),
        V.filled(item, "$.location.longitude").try_cast("double").alias("longitude"),
    )
    custom = F.coalesce(
        V.array(item, "$.customField", CUSTOM_FIELD), F.array().cast(f"array<{CUSTOM_FIELD}>")
    )
    sections = F.try_variant_get(item, "$.jobAd.sections", SECTIONS)
    job_id = _or_empty(V.text(item, "$.id"))
    base = F.concat(F.lit("https://careers.smartrecruiters.com/"), company_slug)
    return {
        "id": job_id,
        "uuid": V.text(item, "$.uuid"),
        "slug": job_id,
        "title": _or_empty(V.text(item, "$.name")),
        "description": F.get(F.array(sections["jobDescription"]["text"]), F.lit(0)),
        "requirements": F.get(F.array(sections["qualifications"]["text"]), F.lit(0)),
        "company": F.struct(
            F.coalesce(V.text(item, "$.company.identifier"), company_slug).alias("identifier"),
            _or_empty(V.text(item, "$.company.name")).alias("name"),
        ),
        "department": F.when(
            V.is_object(item, "$.department"),
            F.struct(
                V.text(item, "$.department.id").alias("id"),
                V.text(item, "$.department.label").alias("name"),
                V.text(item, "$.department.description").alias("description"),
            ),
        ),
        "function": _labelled(item, "$.function"),
        "locations": F.when(V.truthy(item, "$.location"), F.array(place)).otherwise(
            F.slice(F.array(place), 1, 0)
        ),
        "employment_type": _labelled(item, "$.typeOfEmployment"),
        "experience_level": _labelled(item, "$.experienceLevel"),
        "industry": _labelled(item, "$.industry"),
        "remote_option": V.text(item, "$.location.remote").try_cast("boolean"),
        "created_at": D.iso_or_day(V.text(item, "$.createdDate")),
        "released_date": D.iso_or_day(V.text(item, "$.releasedDate")),
        "active": F.coalesce(V.text(item, "$.active").try_cast("boolean"), F.lit(True)),
        "careers_url": F.when(job_id != "", F.concat(base, F.lit("/jobs/"), job_id)),
        "apply_url": V.text(item, "$.applyUrl"),
        "job_ad": F.when(sections.isNotNull(), F.struct(sections.alias("sections"))),
        "custom_fields": F.transform(
            custom,
            lambda x: F.struct(
                x["fieldId"].alias("field_id"),
                x["fieldLabel"].alias("field_label"),
                x["valueId"].alias("value_id"),
                x["valueLabel"].alias("value_label"),
            ),
        ),
        "creator_name": V.text(item, "$.creator.name"),
        "creator_avatar": V.text(item, "$.creator.avatarUrl"),
        "raw_data": F.when(from_detail, F.to_json(item)),
    }
