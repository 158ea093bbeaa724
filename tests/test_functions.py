"""Literal cases of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from postmill.functions import classify as C
from postmill.functions import dates as D
from postmill.functions import location as L
from postmill.functions import text as X
from postmill.functions import urls as U


def apply(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


CASES = [
    (
        U.provider_of_url,
        {
            "https://boards.greenhouse.io/saltworks/jobs/4711": "greenhouse",
            "https://job-boards.greenhouse.io/limekiln": "greenhouse",
            "https://jobs.lever.co/quaybooks/0f-9e": "lever",
            "https://northmills.wd3.myworkdayjobs.com/de-DE/Werk": "workday",
            "https://wd1.myworkdayjobs.com/tinworks": "workday",
            "https://jobs.ashbyhq.com/harbour": "ashby",
            "https://careers-oven.icims.com/jobs": "icims",
            "https://oven.taleo.net": "taleo",
            "https://oven.bamboohr.com:443/jobs": "bamboohr",
            "https://jobs.jobvite.com/oven": "jobvite",
            "https://jobs.smartrecruiters.com/oven": "smartrecruiters",
            "https://www.linkedin.com/jobs/view/88": "unknown",
            "https://saltworks.example/jobs": "unknown",
            "https://else.example/?u=jobs.lever.co": "unknown",
            "https://cantilever.co/x": "unknown",
            "": "unknown",
            None: None,
        },
    ),
    (
        U.block_reason_of_url,
        {
            "https://www.linkedin.com/login?next=1": "login_required",
            "https://www.linkedin.com/uas/login-submit": "login_required",
            "https://www.linkedin.com/signin/v2": "login_required",
            "https://www.linkedin.com/authwall?trk=x": "authwall",
            "https://www.linkedin.com/checkpoint/challenge/AB": "checkpoint",
            "https://challenge.linkedin.com/q": "captcha_detected",
            "https://www.linkedin.com/jobs/collections": None,
            "https://www.linkedin.com/jobs/view/88": None,
        },
    ),
    (
        lambda c: U.company_slug(U.provider_of_url(c), c),
        {
            "https://boards.greenhouse.io/saltworks/jobs/4711": "saltworks",
            "https://northmills.wd3.myworkdayjobs.com/de-DE/Werk": "Werk",
            "https://northmills.wd3.myworkdayjobs.com/Werk": "Werk",
            "https://jobs.lever.co/quaybooks?ref=2": "quaybooks",
            "https://saltworks.example": None,
        },
    ),
    (
        X.first_years_match,
        {
            "5+ years": 5,
            "3-5 years": 5,
            "Minimum 10 YEARS": 10,
            "no number of years": None,
            "99999999999 years": None,
            "": None,
            None: None,
        },
    ),
    (X.clean_text, {"  a \n\n b c\t": "a b c", "": "", None: "", "x\x1fy": "x y"}),
    (X.total_jobs_in_text, {"1,234 jobs found": 1234, "20 JOB FOUND": 20, "none": None}),
    (
        L.work_location_type,
        {
            "Austin (Remote)": "remote",
            "London hybrid": "hybrid",
            "HQ Onsite": "on-site",
            "Berlin": "not_specified",
            "": "not_specified",
            None: "not_specified",
        },
    ),
    (
        L.remote_scope,
        {
            "Remote, same country": "same_country",
            "Remote same timezone": "same_timezone",
            "Remote global": "anywhere",
            "remote": "anywhere",
            "Berlin": None,
            None: None,
        },
    ),
    (lambda c: L.location_part(c, 2), {"Berlin, BE, de (Remote), x": "de (Remote)", "Berlin": None, "": None}),
    (
        C.experience_level,
        {
            "International": "entry_level",
            "Associate": "mid_level",
            "Principal": "senior_level",
            "Head": "executive",
            "x": "not_specified",
            "": None,
            None: None,
        },
    ),
    (C.employment_type, {"Permanent": "full_time", "Part-time": "part_time", "x": "not_specified", None: None}),
    (C.education_level, {"Scrum Master": "masters", "B.S. needed": "bachelors", "bxsx": "not_specified", "": None}),
    (lambda c: C.management_level(c, F.lit(None)), {"Director": "executive", "Leader": "manager", "Staff": "senior_individual", "Cook": "individual_contributor"}),
    (X.first_name, {"Ada Mary Example": "Ada", "": "Valued", None: "Valued"}),
    (X.last_name, {"Ada Mary Example": "Mary Example", "Solo": "Client", "": "Client"}),
    (
        lambda c: U.page_url(c, F.lit(3)),
        {
            "https://a.b/c": "https://a.b/c?start=40",
            "https://a.b/c?q=1": "https://a.b/c?q=1&start=40",
            "https://a.b/c?start=20": "https://a.b/c?start=40",
        },
    ),
    (
        lambda c: F.date_format(D.iso_or_utc_text(c), "yyyy-MM-dd HH:mm:ss"),
        {
            "2025-01-02 14:22:42 UTC": "2025-01-02 14:22:42",
            "2024-01-15T10:00:00+02:00": "2024-01-15 08:00:00",
            "2024-01-15T10:00:00.5Z": "2024-01-15 10:00:00",
            "2024-01-15": "2024-01-15 00:00:00",
            "2024-01-15T10:00Z": "2024-01-15 10:00:00",
            "2024-01-15T10:00-02:30": "2024-01-15 12:30:00",
            "2024-13-45": None,
            "soon": None,
            None: None,
        },
    ),
    (
        lambda c: F.date_format(D.one_year_later(F.to_date(c)), "yyyy-MM-dd"),
        {"2024-02-29": "2025-02-28", "2024-06-01": "2025-06-01"},
    ),
    (
        lambda c: U.join_url(F.lit("https://a.b:8/c/d?e#f"), c),
        {
            "/x": "https://a.b:8/x",
            "x": "https://a.b:8/c/x",
            "?y=1": "https://a.b:8/c/d?y=1",
            "//h/z": "https://h/z",
            "mailto:x": "mailto:x",
        },
    ),
]


@pytest.mark.parametrize("rule,cases", CASES)
def test_rule(spark, rule, cases):
    assert apply(spark, rule, list(cases)) == list(cases.values())


def test_percent_rounds_half_even(spark):
    df = spark.createDataFrame([(0.125,), (1.0,), (0.0,), (0.1234,)], "x double")
    assert [r[0] for r in df.select(X.percent(F.col("x"))).collect()] == ["12.5%", "100.0%", "0.0%", "12.3%"]
