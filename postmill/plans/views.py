"""Input views: posting, payload, capture and page shapes derived from the tables.

Each view is a list of select expressions in the dialect Spark SQL and DuckDB
share, over one whole table. Spark builds them with ``selectExpr`` (so Catalyst
prunes what a query does not use); the SQL check builds them as CTEs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ID = "CAST(doc_id AS STRING)"


def _pick(mod: int, *values: str | None, key: str = "doc_id") -> str:
    """CASE over ``key % mod``; the last value is the ELSE branch."""
    shown = ["NULL" if v is None else v if v.startswith("=") else f"'{v}'" for v in values]
    shown = [v[1:] if v.startswith("=") else v for v in shown]
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(shown[:-1]))
    return f"(CASE {key} % {mod} {whens} ELSE {shown[-1]} END)"


def _text(template: str) -> str:
    """Template with ``<<sql>>`` holes -> one concat() expression."""
    parts = re.split(r"<<(.*?)>>", template)
    shown = [p if i % 2 else f"'{p}'" for i, p in enumerate(parts) if p]
    return f"concat({', '.join(shown)})"


# Whole text with control and non-ASCII characters, quotes and marks blanked, for JSON and
# HTML bodies. One range per class: Java runs classes of many ranges ten times slower.
PLAIN = "regexp_replace(text, '[^ -~]+', ' '{global})"
for _char in ("'\"'", "chr(92)", "'<'", "'&'"):
    PLAIN = f"replace({PLAIN}, {_char}, ' ')"

# A third of all rows belongs to company 0, crawl 0 and so on: the hot key. The others have
# some eighteen postings each, so companies, job ids and titles grow with the table.
NUMBER = "CAST(floor(doc_id / 27) AS BIGINT)"
COMPANY = f"(CASE WHEN doc_id % 3 = 1 THEN 0 ELSE {NUMBER} END)"
JOB = "CAST(CAST(floor(doc_id / 5) AS BIGINT) AS STRING)"
# the text's second word in plain letters
WORD = "regexp_replace(lower(split_part(text, ' ', 2)), '[^a-z]+', ''{global})"

TITLE = _pick(
    8,
    "Senior Data Engineer",
    "Director of Sales",
    "Engineering Manager",
    "Staff Scientist",
    "General application",
    "Intern",
    "",
    "Product Designer",
)
APPLY_URL = _pick(
    17,
    f"={_text('https://boards.greenhouse.io/acme/jobs/<<CAST(doc_id % 50 AS STRING)>>')}",
    "https://job-boards.greenhouse.io/acme",
    f"={_text('https://jobs.lever.co/acme/abc-<<CAST(doc_id % 50 AS STRING)>>?src=x')}",
    "https://acme.wd5.myworkdayjobs.com/en-US/External",
    "https://jobs.ashbyhq.com/acme",
    "https://jobs.smartrecruiters.com/acme/7",
    "https://careers-acme.icims.com/jobs/7",
    "https://acme.taleo.net/careersection/1",
    "https://acme.bamboohr.com/jobs",
    "https://jobs.jobvite.com/acme",
    "https://www.linkedin.com/jobs/view/1",
    "https://acme.com/careers",
    "https://api.greenhouse.io/embed/job_board/js?for=acme&b=1",
    "https://acme.wd1.myworkdayjobs.com:8443/d/tenant1/inst/2",
    "https://careers.smartrecruiters.com/Acme2?x=1",
    "https://wd3.myworkdaysite.com/recruiting/acme/Careers",
    None,
)
LOCATION = _pick(
    9,
    "Berlin, BE, DE",
    "Austin, TX, US (Remote)",
    "Remote - Anywhere",
    "London (Hybrid)",
    "HQ office, NY",
    "",
    "Remote, same country",
    "Remote, same timezone",
    None,
)
JOB_TYPE = _pick(
    7, "Full-time", "Part-time", "Contract", "Temporary", "Internship", "Senior permanent", None
)
REQUIREMENT = _pick(
    6,
    "5+ years of work. Bachelor degree.",
    "3-5 years; Master preferred.",
    "PhD required.",
    "Minimum 10 years.",
    "Associate degree.",
    "",
)
SOURCE = f"CASE WHEN doc_id % 3 = 0 AND {NUMBER} % 5 < 3 OR doc_id % 12 = 1 THEN 'ats' ELSE 'linkedin' END"

GREENHOUSE = _text(
    f'{{"jobs":[{{"id":<<{ID}>>,"title":"Engineer <<lang>>","location":{{"name":"Berlin"}},'
    '"updated_at":"2024-01-15T10:00:00Z"},{"id":1,"title":""},'
    f'{{"id":"G<<{ID}>>","title":"Writer","location":null,'
    f'"absolute_url":"https://boards.greenhouse.io/own/jobs/<<{ID}>>","updated_at":"soon"}}]}}'
)
LEVER = _pick(
    5,
    '{"id":"L0","text":"not a list"}',
    "="
    + _text(
        f'[{{"id":"L<<{ID}>>","text":"Analyst <<lang>>","categories":{{"location":"Paris"}},'
        f'"hostedUrl":"https://jobs.lever.co/acme/<<{ID}>>",'
        '"createdAt":<<CAST(1704067200000 + doc_id * 60000 AS STRING)>>,'
        f'"descriptionPlain":"<<{PLAIN}>>"}},'
        f'{{"id":"M<<{ID}>>","text":"Cook","applyUrl":"https://jobs.lever.co/acme/apply"}}]'
    ),
)
ASHBY = _text(
    f'{{"jobs":[{{"id":"A<<{ID}>>","title":"Designer","location":"Remote"}},'
    f'{{"id":"B<<{ID}>>","title":"Driver","jobUrl":"https://jobs.ashbyhq.com/x/<<{ID}>>"}}]}}'
)
WORKDAY = _text(
    f'{{"jobPostings":[{{"title":"Data Engineer","bulletFields":["REQ-<<{ID}>>"],'
    f'"locationsText":"New York, NY","externalPath":"/job/<<{ID}>>",'
    '"postedOn":"2024-01-15T00:00:00Z"},'
    '{"title":"Senior Developer","bulletFields":[],"location":"Rome"},{"title":null}]}'
)
TOTAL_FOUND = _pick(2, '"totalFound":9,', "")
SMART = _text(
    f'{{<<{TOTAL_FOUND}>>"content":[{{"id":"S<<{ID}>>",'
    f'"uuid":"u-<<{ID}>>","name":"Senior AI Engineer","location":{{"city":"Berlin","region":"BE",'
    '"country":"de","remote":true,"latitude":"52.5"},"company":{"identifier":"acme","name":"Acme"},'
    '"department":{"id":"7","label":"Research"},"typeOfEmployment":{"id":"p","label":"Full-time"},'
    '"customField":[{"fieldId":"f1","fieldLabel":"Brand","valueId":"v1","valueLabel":"Main"}],'
    f'"jobAd":{{"sections":{{"jobDescription":{{"title":"Job","text":"5+ years. <<{PLAIN}>>"}},'
    '"qualifications":{"title":"Q","text":"Master"}}},'
    '"creator":{"name":"Ann"},"createdDate":"2024-02-01T00:00:00Z","releasedDate":"2024-02-03"},'
    f'{{"uuid":"w-<<{ID}>>","name":"Porter","location":{{"city":"Oslo"}}}}]}}'
)
OLD_DETAIL = _pick(4, "", '{"name":"Description","value":"<p>old</p>"},')
COMEET_ITEM = (
    f'{{"uid":"C<<{ID}>>","name":"<<{_pick(3, "General application", "Mate", "Cook")}>>",'
    '"department":null,"workplace_type":"Hybrid",'
    f'"position_url":"<<{_pick(11, "", "=" + _text(f"https://example.org/<<{ID}>>"))}>>",'
    f'"details":[<<{OLD_DETAIL}>>'
    f'{{"name":"<<{_pick(5, "Perks", "Description")}>>","value":"<p><<{PLAIN}>></p>"}},'
    '{"name":"Requirements","value":"<p>r</p>"}],'
    '"categories":[{"name":"Level","value":"1"},{"name":"Function","value":"Ops"},'
    '{"name":"Function","value":"Late"}],"location":{"city":"Haifa","state":"","country":"IL"}}'
)
COMEET = _pick(
    2,
    "=" + _text('{"data":[' + COMEET_ITEM + "," + COMEET_ITEM.replace('"Hybrid"', '"Remote"') + "]}"),
    "=" + _text("[" + COMEET_ITEM + ',{"name":"no uid"}]'),
)
OFFER_ID = _pick(13, '"x"', f"={ID}")
OFFER_DEPARTMENT = "CASE WHEN doc_id % 4 < 2 THEN '\"Care\"' ELSE '{\"id\":3,\"name\":\"Care\"}' END"
RECRUITEE_ITEM = (
    f'{{"id":<<{OFFER_ID}>>,"slug":"o-<<{ID}>>","title":"Nurse",'
    f'"remote":<<{_pick(2, "true", "false")}>>,"description":"<<{PLAIN}>>","min_salary":10.5,'
    f'"department":<<{OFFER_DEPARTMENT}>>,'
    '"locations":[{"city":"Utrecht","country":"NL"},{"city":"Gent"}],'
    '"created_at":"2025-01-02 14:22:42 UTC"}'
)
RECRUITEE = _text('{"offers":[' + RECRUITEE_ITEM + "]}")

COMPANY_DETAILS = _pick(4, '{"name":"Acme"}', '{"company":{"name":"Deep Co"}}', '"Flat Co"', "{}")
APPLY_METHOD = _pick(
    5,
    '{"$type":"com.linkedin.voyager.jobs.OffsiteApply","companyApplyUrl":"https://jobs.lever.co/acme/1"}',
    '{"$type":"com.linkedin.SimpleOnSiteApply"}',
    '"EasyApply"',
    "null",
    "{}",
)
DISCOVERY = _text(
    '{"included":['
    '{"entityUrn":"urn:li:fsd_jobPosting:<<CAST(doc_id % 301 AS STRING)>>",'
    f'"title":"<<{TITLE}>>","companyDetails":<<{COMPANY_DETAILS}>>,'
    f'"companyName":"Fallback Co","formattedLocation":"Berlin","applyMethod":<<{APPLY_METHOD}>>,'
    f'"description":{{"text":"<<{PLAIN}>>"}}}},'
    '{"entityUrn":"urn:li:fsd_company:5","name":"not a job"},'
    '{"$recipeType":"x.JobPosting","jobPostingId":77,"title":"Cook",'
    '"company":{"companyName":"Diner"},"location":{"name":"Rome"},'
    f'"externalApplyUrl":"https://boards.greenhouse.io/diner/jobs/<<{ID}>>",'
    '"description":"plain text","easyApply":true}],'
    f'"elements":[{{"id":<<{ID}>>,"title":"Guide","company":"Tours","location":"Oslo",'
    '"applyUrl":"ftp://nope","companyApplyUrl":{"url":"https://acme.com/careers"}},7],'
    '"data":{"jobCards":[{"trackingUrn":"urn:li:job:<<CAST(doc_id % 19 AS STRING)>>","title":"Clerk",'
    '"companyName":"Office"},1],"jobOfTheDay":{"id":5,"title":"Baker","companyName":"Bread"},'
    '"other":[{"id":6}]}}'
)

CARDS = _text(
    '<html><body><div class="top"><span>1,234</span> <p><<CAST(1 + doc_id % 90 AS STRING)>> Jobs Found</p></div>'
    f'<div class="job-item" data-job-id="J<<{ID}>>"><h2 class="job-title"><a href="/jobs/<<{ID}>>"><<{TITLE}>></a></h2>'
    '<span class="job-location">Berlin</span><span class="job-type">Full-time</span>'
    f'<p><<{PLAIN}>></p></div>'
    '<ul><li class="opening-item"><h3> </h3><a href="https://x.example.org/job/9">none</a></li></ul>'
    f'<div data-posting-id="P<<{ID}>>" data-location-id="12"><h3>Role <<lang>></h3><div class="department">Ops</div>'
    f'<a href="https://abs.example.org/position/<<{ID}>>">go</a></div>'
    f'<section><div class="opening"><a href="/acme/jobs/<<{ID}>>">Opening <<lang>></a><span class="location">Oslo</span></div>'
    '<div class="opening"><a href="x">ab</a></div></section>'
    '<form action="/search" method="post"><input name="q"><select name="loc"></select><textarea></textarea></form>'
    '<div class="pagination"><span class="current">2</span><a href="?page=1">1</a><a href="?page=2">2</a></div>'
    "</body></html>"
)

# view -> (table, select expressions)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "postings": (
        "documents",
        [
            "doc_id AS seq",
            f"{SOURCE} AS source",
            f"concat(CASE WHEN doc_id % 2 = 0 THEN 'Company ' ELSE 'COMPANY ' END, CAST({COMPANY} AS STRING)) AS company_name",
            f"concat('J', {JOB}) AS job_id",
            f"trim(concat({TITLE}, CASE WHEN doc_id % 8 = 6 THEN '' WHEN doc_id % 5 = 0 THEN concat('s ', {WORD}) ELSE concat(' ', {WORD}) END)) AS title",
            f"{LOCATION} AS location",
            f"{JOB_TYPE} AS job_type",
            f"concat({REQUIREMENT}, '  ', text) AS description",
            f"{APPLY_URL} AS apply_url",
            "1704067200000 + doc_id * 60000 AS created_at_ms",
        ],
    ),
    "payloads": (
        "documents",
        [
            "doc_id AS payload_id",
            "concat('company-', CAST(doc_id % 37 AS STRING)) AS company_slug",
            "concat('Company ', CAST(doc_id % 37 AS STRING)) AS company_name",
            "concat('https://company-', CAST(doc_id % 37 AS STRING), '.wd5.myworkdayjobs.com/en-US/External') AS base_url",
            _pick(
                7, "greenhouse", "lever", "ashby", "workday", "smartrecruiters", "comeet", "recruitee"
            )
            + " AS provider",
            "CASE WHEN doc_id % 29 = 3 THEN '{broken' ELSE "
            + _pick(
                7, *[f"={b}" for b in (GREENHOUSE, LEVER, ASHBY, WORKDAY, SMART, COMEET, RECRUITEE)]
            )
            + " END AS body",
        ],
    ),
    "comeet_details": (
        "documents",
        [
            "concat('company-', CAST(doc_id % 37 AS STRING)) AS company_slug",
            f"concat('C', {ID}) AS uid",
            _pick(
                3,
                "="
                + _text(
                    f'{{"uid":"C<<{ID}>>","name":"Detail name","department":"Detail dept",'
                    '"time_updated":"2024-03-01T08:00:00Z","url_active_page":"https://active.example.org/'
                    f'<<{ID}>>"}}'
                ),
                "=" + _text(f'[{{"uid":"C<<{ID}>>","name":"Listed","position_url":"https://listed.example.org/<<{ID}>>"}}]'),
                None,
            )
            + " AS body",
        ],
    ),
    "offer_details": (
        "documents",
        [
            "concat('company-', CAST(doc_id % 37 AS STRING)) AS company_slug",
            f"concat('o-', {ID}) AS slug",
            _pick(
                2,
                "="
                + _text(
                    f'{{"offer":{{"id":<<{ID}>>,"slug":"o-<<{ID}>>","title":"Head nurse","requirements":"RN",'
                    '"published_at":"2025-02-01T00:00:00Z","careers_apply_url":"https://apply.example.org"}}'
                ),
                None,
            )
            + " AS body",
        ],
    ),
    "discoveries": (
        "documents",
        [
            f"{COMPANY} AS crawl_id",
            "doc_id AS seq",
            "CASE WHEN doc_id % 10 = 0 THEN 'https://www.linkedin.com/voyager/api/jobs/jobPostings/9' ELSE 'https://www.linkedin.com/voyager/api/jobs/search' END AS url",
            "CASE WHEN doc_id % 23 = 0 THEN 500 ELSE 200 END AS status",
            "CASE WHEN doc_id % 31 = 0 THEN 'text/html' ELSE 'application/json; charset=utf-8' END AS content_type",
            f"{DISCOVERY} AS body",
        ],
    ),
    "capture_log": (
        "events",
        [
            "CASE WHEN event_id % 3 = 1 THEN 0 ELSE user_id END AS crawl_id",
            "event_id AS seq",
            "ts",
            "CASE event_type WHEN 'click' THEN 'https://www.linkedin.com/voyager/api/jobs/jobPostings/1' "
            "WHEN 'view' THEN 'https://www.linkedin.com/jobs-guest/jobs/api/seeMoreJobPostings/search' "
            "WHEN 'signup' THEN concat('https://acme.recruitee.com/api/offers/', CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '?limit=5' ELSE concat('o-', CAST(event_id % 70 AS STRING)) END) "
            "WHEN 'purchase' THEN 'https://www.linkedin.com/voyager/api/jobs/search' "
            "ELSE CASE event_id % 97 WHEN 0 THEN 'https://www.linkedin.com/uas/login' WHEN 1 THEN 'https://www.linkedin.com/authwall' "
            "WHEN 2 THEN 'https://www.linkedin.com/checkpoint/challenge' WHEN 3 THEN 'https://challenge.linkedin.com/x' "
            "ELSE concat('https://www.linkedin.com/jobs/view/', CAST(event_id % 41 AS STRING)) END END AS url",
            "CASE WHEN event_type = 'error' AND event_id % 211 = 4 THEN 429 WHEN event_type = 'error' AND event_id % 211 = 5 THEN 403 ELSE 200 END AS status",
            "CASE WHEN event_id % 4 = 0 THEN 'text/html' ELSE 'application/json; charset=utf-8' END AS content_type",
            "CASE WHEN event_id % 2 = 0 THEN concat('https://start.example.org/', CAST(event_id % 61 AS STRING)) ELSE NULL END AS redirected_from",
        ],
    ),
    "url_statuses": (
        "documents",
        [
            f"concat('https://example.org/', {ID}) AS url",
            "doc_id AS seq",
            "CASE doc_id % 9 WHEN 0 THEN 404 WHEN 1 THEN 301 ELSE 204 END AS status",
        ],
    ),
    "careers_pages": (
        "documents",
        [
            "doc_id AS page_id",
            f"concat('Company ', CAST({COMPANY} AS STRING)) AS company_name",
            "'https://careers.example.org/list/all?lang=en' AS base_url",
            "'greenhouse' AS provider",
            f"{CARDS} AS html",
        ],
    ),
    "url_patterns": (
        "supplier",
        [
            "s_suppkey AS priority",
            "concat('rule-', CAST(s_suppkey % 400 AS STRING)) AS label",
            "CASE s_suppkey % 8 WHEN 0 THEN concat('linkedin[.]com/jobs/view/', CAST(s_suppkey % 60 AS STRING), '$') "
            "WHEN 1 THEN concat('/api/offers/o-', CAST(s_suppkey % 90 AS STRING), '([?]|$)') "
            "WHEN 2 THEN concat('jobs/view/(', CAST(s_suppkey % 50 AS STRING), '|', CAST(s_suppkey % 7 AS STRING), ')$') "
            "WHEN 3 THEN concat('offers[?]limit=', CAST(s_suppkey % 9 AS STRING)) "
            "WHEN 4 THEN concat('never-', CAST(s_suppkey AS STRING), '/seen') "
            "WHEN 5 THEN concat('https?://[a-z]+.linkedin.com/.*', CAST(s_suppkey % 30 AS STRING), '$') "
            "WHEN 6 THEN concat('(uas|authwall).*', CAST(s_suppkey % 3 AS STRING), '?$') ELSE concat('^x', CAST(s_suppkey AS STRING)) END AS pattern",
        ],
    ),
    "clients": (
        "customer",
        [
            "c_custkey AS client_key",
            "CASE c_custkey % 4 WHEN 0 THEN 'Ada Mary Example' WHEN 1 THEN 'Solo' WHEN 2 THEN '' ELSE c_name END AS client_name",
            "CASE WHEN c_custkey % 10 = 0 THEN 'not-an-email' ELSE concat('c', CAST(c_custkey AS STRING), '@example.org') END AS client_email",
            "CASE c_custkey % 3 WHEN 0 THEN '2024-02-29' WHEN 1 THEN '2024-06-01' ELSE 'bad-date' END AS start_date",
            "c_mktsegment AS service_plan",
        ],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, exprs = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[e.replace("{global}", "") for e in exprs])


def view_sql(name: str) -> str:
    """The same view as a DuckDB CTE."""
    source, exprs = VIEWS[name]
    body = ", ".join(exprs).replace("{global}", ", 'g'")
    return f"{name} AS (SELECT {body} FROM {source})"


def with_views(names: list[str], sql: str) -> str:
    """Prefix a DuckDB query with the CTEs it needs."""
    ctes = ", ".join(view_sql(n) for n in names)
    rest = sql.strip()
    if rest.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {rest[15:]}"
    if rest.upper().startswith("WITH "):
        return f"WITH {ctes}, {rest[5:]}"
    return f"WITH {ctes} {rest}"
