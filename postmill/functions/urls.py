"""URL rules: provider, origin, slug, joins, templates and block detection."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.classify import has_any
from postmill.functions.text import blank_to_null, col

# ---- fixed values: registrable domain -> provider ----
PROVIDER_DOMAINS = {
    "myworkdayjobs.com": "workday",
    "myworkdaysite.com": "workday",
    "greenhouse.io": "greenhouse",
    "lever.co": "lever",
    "icims.com": "icims",
    "taleo.net": "taleo",
    "bamboohr.com": "bamboohr",
    "jobvite.com": "jobvite",
    "smartrecruiters.com": "smartrecruiters",
    "ashbyhq.com": "ashby",
}
API_PROVIDERS = ["greenhouse", "lever", "ashby", "smartrecruiters", "workday"]
# provider -> slug patterns, first match wins; a locale segment is not a slug
SLUG_PATTERNS = {
    "greenhouse": [
        r"boards\.greenhouse\.io/([^/?#]+)",
        r"greenhouse\.io/.*embed/job_board/js\?for=([^&#]+)",
    ],
    "lever": [r"lever\.co/([^/?#]+)"],
    "ashby": [r"ashbyhq\.com/([^/?#]+)"],
    "workday": [
        r"myworkdayjobs\.com/(?:[a-z]{2}-[A-Z]{2}/)?([^/?#]+)",
        r"wd\d+\.myworkdaysite\.com/(?:[^?#]*/)?([^/?#]+)",
    ],
    "smartrecruiters": [r"(?:jobs|careers)\.smartrecruiters\.com/([^/?#]+)"],
}
# network paths that carry job data
JOB_API_PATTERNS = [
    r"/voyager/api/jobs/jobPostings",
    r"/voyager/api/jobs/jobDetails",
    r"/voyager/api/graphql.*job",
    r"/voyager/api/entities/companies",
    r"/jobs-guest/jobs/api/",
    r"/jobs/api/",
    r"/voyager/api/search/dash",
    r"/voyager/api/jobs/search",
]
# block reason -> patterns, in order of precedence
BLOCK_PATTERNS = {
    "login_required": [r"/login", r"/signin", r"/sign-in", r"/uas/login"],
    "authwall": [r"/authwall", r"/auth-wall"],
    "checkpoint": [r"/checkpoint", r"/security-check"],
    "captcha_detected": [
        r"/captcha",
        r"/challenge",
        r"/security-verification",
        r"challenge\.linkedin\.com",
    ],
}
BLOCK_REASONS = ["rate_limited", *BLOCK_PATTERNS]
BLOCK_WORDS = ["captcha", "login", "signin", "auth", "challenge"]
OFFER_LIST_PATTERN = r"/api/offers/?(\?.*)?$"
OFFER_DETAIL_PATTERN = r"/api/offers/([^/\?]+)(\?.*)?$"
COMPANY_ID_PATTERN = r"/careers-api/2\.0/company/([\d.]+)"

_DOMAIN = (
    r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:[^/?#:@]*\.)?("
    + "|".join(d.replace(".", r"\.") for d in PROVIDER_DOMAINS)
    + r")(?::\d+)?(?:[/?#]|$)"
)


def provider_of_url(c: Column | str) -> Column:
    """Provider by the host of the URL, ``unknown`` when no domain fits, null for null."""
    domain = F.regexp_extract(F.lower(col(c)), _DOMAIN, 1)
    expr = F.when(col(c).isNull(), F.lit(None).cast("string"))
    for provider in dict.fromkeys(PROVIDER_DOMAINS.values()):
        domains = [d for d, p in PROVIDER_DOMAINS.items() if p == provider]
        expr = expr.when(domain.isin(*domains), provider)
    return expr.otherwise("unknown")


def has_api(provider: Column | str) -> Column:
    return col(provider).isin(*API_PROVIDERS)


def external_apply(apply_url: Column | str) -> Column:
    return F.coalesce(~col(apply_url).contains("linkedin.com"), F.lit(False))


def job_origin(apply_url: Column | str, provider: Column) -> Column:
    known = F.coalesce(provider != "unknown", F.lit(False))
    return F.when(external_apply(apply_url) & known, "ATS").otherwise("LINKEDIN_NATIVE")


def company_slug(provider: Column | str, url: Column | str) -> Column:
    """Slug by the patterns of the row's provider; null when none matches."""
    expr = F
    for name, patterns in SLUG_PATTERNS.items():
        tries = [blank_to_null(F.regexp_extract(col(url), p, 1)) for p in patterns]
        expr = expr.when(col(provider) == name, F.coalesce(*tries))
    return expr.otherwise(F.lit(None).cast("string"))


def scheme_of(url: Column | str) -> Column:
    return F.regexp_extract(col(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def authority_of(url: Column | str) -> Column:
    """Host with its port."""
    return F.regexp_extract(col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def base_of(url: Column | str) -> Column:
    return F.concat(scheme_of(url), F.lit("://"), authority_of(url))


def query_param(url: Column | str, key: str) -> Column:
    return blank_to_null(F.regexp_extract(col(url), rf"[?&]{key}=([^&#]*)", 1))


def join_url(base: Column | str, href: Column | str) -> Column:
    """Resolve a link against the page it stands on (no dot segments)."""
    page, link = col(base), col(href)
    path = F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(blank_to_null(F.regexp_replace(path, r"[^/]*$", "")), F.lit("/"))
    return (
        F.when(link.isNull() | (link == ""), page)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme_of(page), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(base_of(page), link))
        .when(link.startswith("?"), F.concat(base_of(page), path, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(page, r"#.*$", ""), link))
        .otherwise(F.concat(base_of(page), folder, link))
    )


def workday_api_url(base: Column | str, slug: Column | str) -> Column:
    tenant = blank_to_null(F.regexp_extract(col(base), r"/d/([^/]+)/", 1))
    site = blank_to_null(F.regexp_extract(col(base), SLUG_PATTERNS["workday"][0], 1))
    host0 = F.substring_index(authority_of(base), ".", 1)
    root = F.concat(base_of(base), F.lit("/wday/cxs/"))
    return F.when(
        tenant.isNotNull(), F.concat(root, tenant, F.lit("/"), col(slug), F.lit("/jobs"))
    ).when(site.isNotNull(), F.concat(root, host0, F.lit("/"), site, F.lit("/jobs")))


def page_url(base: Column | str, page: Column | str, page_size: int = 20) -> Column:
    """URL of the n-th result page by the ``start`` offset."""
    url, n = col(base), col(page)
    start = F.concat(F.lit("start="), ((n - 1) * page_size).cast("string"))
    before = F.concat(F.lit("start="), ((n - 2) * page_size).cast("string"))
    return (
        F.when(~url.contains("?"), F.concat(url, F.lit("?"), start))
        .when(url.contains("start="), F.replace(url, before, start))
        .otherwise(F.concat(url, F.lit("&"), start))
    )


def api_base(url: Column | str) -> Column:
    return F.concat(F.substring_index(col(url), "/api/", 1), F.lit("/api"))


def is_job_api(url: Column | str) -> Column:
    return any_pattern(col(url), JOB_API_PATTERNS)


def capture_route(url: Column | str) -> Column:
    """Detail or list, for a captured job response."""
    detail = col(url).contains("/jobDetails") | col(url).contains("jobPosting")
    return F.when(detail, "detail").otherwise("list")


def offer_route(url: Column | str) -> Column:
    return F.when(col(url).rlike(OFFER_LIST_PATTERN), "list").when(
        col(url).rlike(OFFER_DETAIL_PATTERN), "detail"
    )


def offer_slug(url: Column | str) -> Column:
    return F.when(
        offer_route(url) == "detail", F.regexp_extract(col(url), OFFER_DETAIL_PATTERN, 1)
    )


def _found(c: Column, pattern: str) -> Column:
    """Pattern occurs; a pattern without regex marks is searched as plain text, which is faster."""
    literal = pattern.replace(r"\.", "")
    if re.fullmatch(r"[\w/-]+", literal):
        return c.contains(pattern.replace(r"\.", "."))
    return c.rlike(pattern)


def any_pattern(c: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [_found(c, p) for p in patterns])


def first_pattern(c: Column | str, patterns: dict[str, list[str]]) -> Column:
    """Label of the first entry one of whose patterns is found; the order is the priority.

    A pattern table becomes one CASE expression: no join, each row is read once.
    """
    expr = F
    for label, options in patterns.items():
        expr = expr.when(any_pattern(col(c), options), label)
    return expr.otherwise(F.lit(None).cast("string"))


def block_reason_of_url(url: Column | str) -> Column:
    return first_pattern(F.lower(col(url)), BLOCK_PATTERNS)


def block_reason(status: Column | str, url: Column | str) -> Column:
    return (
        F.when(col(status) == 429, "rate_limited")
        .when(col(status).isin(401, 403), "login_required")
        .otherwise(block_reason_of_url(url))
    )


def looks_blocked(url: Column | str) -> Column:
    """Loose block test: any of the words anywhere in the URL."""
    return has_any(F.lower(col(url)), BLOCK_WORDS)


def company_id_in_html(html: Column | str) -> Column:
    return blank_to_null(F.regexp_extract(col(html), COMPANY_ID_PATTERN, 1))
