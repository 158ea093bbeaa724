"""Queries over capture logs, HTML pages, vectors, agreements and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.operators import agreements as AG
from postmill.operators import crawls as CR
from postmill.operators import html as H
from postmill.operators import normalize as N
from postmill.operators import patterns as PT
from postmill.operators import report as R
from postmill.operators import vector_join as VJ
from postmill.operators import vectors as VC
from postmill.plans.q_reports import UPSERTED, _keyed, _upsert_shown
from postmill.plans.q_shapes import DISCOVERED, FEEDS, SHOWN, discovery_items
from postmill.plans.registry import Inputs, query, stamp
from postmill.plans.views import VIEWS
from postmill.session import stage, work_dir
from postmill.sources import captures as SC
from postmill.streaming import jobs as ST
from postmill.streaming import stateful as SS

# ---- capture log ----

BLOCK_URL = """CASE WHEN regexp_matches(lower(url), '/login|/signin|/sign-in|/uas/login') THEN 'login_required' WHEN regexp_matches(lower(url), '/authwall|/auth-wall') THEN 'authwall'
  WHEN regexp_matches(lower(url), '/checkpoint|/security-check') THEN 'checkpoint' WHEN regexp_matches(lower(url), '/captcha|/challenge|/security-verification|challenge\\.linkedin\\.com') THEN 'captcha_detected' END"""
BLOCK = f"CASE WHEN status = 429 THEN 'rate_limited' WHEN status IN (401, 403) THEN 'login_required' ELSE {BLOCK_URL} END"
JOB_API = "regexp_matches(url, '/voyager/api/jobs/jobPostings|/voyager/api/jobs/jobDetails|/voyager/api/graphql.*job|/voyager/api/entities/companies|/jobs-guest/jobs/api/|/jobs/api/|/voyager/api/search/dash|/voyager/api/jobs/search')"


@query(
    "block_reason",
    "I16 I17 D7 E9",
    ["capture_log"],
    f"SELECT seq, {BLOCK} AS block_reason, {BLOCK_URL} AS by_url, regexp_matches(lower(url), 'captcha|login|signin|auth|challenge') AS looks_blocked FROM capture_log",
)
def block_reason(i):
    return i.view("capture_log").select(
        "seq",
        U.block_reason("status", "url").alias("block_reason"),
        U.block_reason_of_url("url").alias("by_url"),
        U.looks_blocked("url").alias("looks_blocked"),
    )


@query(
    "url_labels",
    "E9",
    ["capture_log", "url_patterns"],
    """SELECT seq, label, priority FROM capture_log LEFT JOIN (SELECT url, arg_min(label, priority) AS label, min(priority) AS priority
    FROM (SELECT DISTINCT url FROM capture_log) JOIN url_patterns ON regexp_matches(url, pattern) GROUP BY url) USING (url)""",
)
def url_labels(i):
    """Captures with the first of the table's patterns that their URL matches."""
    return PT.first_labels(i.view("capture_log"), "url", i.view("url_patterns")).select("seq", "label", "priority")


@query(
    "routed_captures",
    "A9 D4 D6",
    ["capture_log"],
    f"""SELECT crawl_id, seq, CASE WHEN contains(url, '/jobDetails') OR contains(url, 'jobPosting') THEN 'detail' ELSE 'list' END AS route FROM capture_log
    WHERE status = 200 AND contains(content_type, 'application/json') AND {JOB_API} AND ({BLOCK}) IS NULL""",
)
def routed_captures(i):
    return SC.job_captures(i.view("capture_log")).select("crawl_id", "seq", "route")


@query(
    "offer_captures",
    "A9 D5 I37",
    ["capture_log"],
    r"""SELECT seq, CASE WHEN regexp_matches(url, '/api/offers/?(\?.*)?$') THEN 'list' ELSE 'detail' END AS route, NULLIF(regexp_extract(url, '/api/offers/([^/?]+)(\?.*)?$', 1), '') AS offer_slug,
    'https://acme.recruitee.com/api' AS api_base FROM capture_log WHERE status BETWEEN 200 AND 299 AND contains(content_type, 'application/json') AND contains(url, '/api/offers')""",
)
def offer_captures(i):
    return SC.offer_captures(i.view("capture_log")).select("seq", "route", "offer_slug", "api_base")


@query(
    "crawl_state",
    "F7",
    ["capture_log"],
    f"""SELECT crawl_id, count(*) AS requests_made, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_request_time,
    count(*) FILTER (status = 200 AND contains(content_type, 'application/json') AND {JOB_API} AND reason IS NULL) AS api_responses_captured,
    count(reason) AS n_blocks, count(reason) > 0 AS is_blocked, arg_min(reason, seq) FILTER (reason IS NOT NULL) AS block_reason, count(*) FILTER (status >= 400) AS n_errors
    FROM (SELECT *, {BLOCK} AS reason FROM capture_log) GROUP BY 1""",
)
def crawl_state(i):
    rows = CR.crawl_state(i.view("capture_log"))
    return rows.withColumn("last_request_time", F.date_format("last_request_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "jobs_collected",
    "F7 G2",
    ["discoveries"],
    f"WITH {DISCOVERED} SELECT crawl_id, count(DISTINCT job_id) AS jobs_collected FROM d_rows WHERE job_id <> '' AND title <> '' AND company_name <> '' GROUP BY 1",
)
def jobs_collected(i):
    return CR.jobs_collected(N.normalize_discoveries(discovery_items(i), keep=("crawl_id",)))


LATCH = f"""SELECT crawl_id, seq FROM (SELECT *, max(CASE WHEN ({BLOCK}) IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY crawl_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latched FROM capture_log) WHERE latched = 0"""


@query("partial_before_block", "G8 K3", ["capture_log"], LATCH)
def partial_before_block(i):
    return CR.before_block(i.view("capture_log")).select("crawl_id", "seq")


@query(
    "redirect_chain",
    "G12 H3",
    ["capture_log"],
    """SELECT crawl_id, start_url, array_to_string(list_filter(chain, lambda x, i: list_position(chain, x) = i), ' > ') AS chain, len(list_distinct(chain)) AS n_urls FROM (
      SELECT crawl_id, start_url, list_concat([start_url], list(url ORDER BY seq)) AS chain FROM (SELECT crawl_id, redirected_from AS start_url, seq, url, row_number() OVER (PARTITION BY crawl_id, redirected_from ORDER BY seq) AS rn
      FROM capture_log WHERE redirected_from IS NOT NULL) WHERE rn <= 10 GROUP BY 1, 2)""",
)
def redirect_chain(i):
    rows = CR.redirect_chains(i.view("capture_log"))
    return rows.select("crawl_id", "start_url", F.array_join("chain", " > ").alias("chain"), F.size("chain").cast("bigint").alias("n_urls"))


# ---- HTML pages ----


@query(
    "page_links",
    "J3",
    None,
    """SELECT page_id, unnest(h) AS href, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS link_no FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) AS h FROM pages)""",
)
def page_links(i):
    return H.page_links(i.table("pages")).select("page_id", "href", "link_no")


@query(
    "page_titles",
    "A10 J2",
    None,
    "SELECT page_id, NULLIF(trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)), '') AS heading, NULLIF(trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)), '') AS title FROM pages",
)
def page_titles(i):
    return H.page_headings(i.table("pages"))


# The real pages carry no job markup, so they are read with these selectors.
PAGE_SELECTORS = {
    "job_container": ["article"],
    "job_title": ["h1"],
    "job_location": ["footer"],
    "job_department": ["b"],
    "job_type": [".ad"],
    "job_url": ["a"],
    "pagination": ["nav"],
}


@query(
    "page_extract",
    "A10 J1 J2 J7",
    None,
    "SELECT page_id, 0 AS card_no, regexp_replace(replace(replace(replace(replace(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '&quot;', chr(34)), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS title FROM pages WHERE contains(html, '<article>') AND trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) <> ''",
)
def page_extract(i):
    pages = i.table("pages").select("page_id", F.col("url").alias("base_url"), "html")
    return H.page_jobs(H.parse_pages(pages, PAGE_SELECTORS, parts=("jobs",))).select("page_id", "card_no", "title")


def _parsed(i: Inputs, part: str) -> DataFrame:
    return H.parse_pages(i.view("careers_pages"), parts=(part,))


CARDS_SQL = """SELECT page_id, title, location, department, type, url, meta FROM (
  SELECT page_id, 0 AS no, NULLIF(regexp_extract(html, '<a href="/jobs/[0-9]+">([^<]*)</a>', 1), '') AS title, 'Berlin' AS location, NULL AS department, 'Full-time' AS type,
    'https://careers.example.org/jobs/' || page_id AS url, 'data-job-id=J' || page_id AS meta FROM careers_pages
  UNION ALL SELECT page_id, 1, regexp_extract(html, '<h3>(Role [^<]*)</h3>', 1), NULL, 'Ops', NULL, 'https://abs.example.org/position/' || page_id, 'data-location-id=12,data-posting-id=P' || page_id FROM careers_pages) WHERE title IS NOT NULL"""


@query("page_cards", "J1 J2 J3 J7 C14 B18 G4", ["careers_pages"], CARDS_SQL)
def page_cards(i):
    rows = H.page_jobs(_parsed(i, "jobs"))
    entries = F.array_sort(F.map_entries("metadata"))
    meta = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return rows.select("page_id", "title", "location", "department", "type", "url", meta.alias("meta"))


@query(
    "page_jobs_row",
    "J7 C11 D1",
    ["careers_pages"],
    f"""SELECT page_id, title AS job_title, coalesce(location, '') AS job_location, url AS job_url, CASE WHEN type IS NULL THEN NULL ELSE 'full_time' END AS employment_type, department AS job_function,
    'scraped' AS processing_status FROM ({CARDS_SQL})""",
)
def page_jobs_row(i):
    flat = H.page_jobs(_parsed(i, "jobs")).withColumns({"id": F.lit(""), "company_slug": F.lit("acme")})
    rows = N.to_ats_jobs(flat, keep=("page_id",))
    return rows.select(
        "page_id", "job_title", "job_location", "job_url", "employment_type", "job_function", "processing_status"
    )


@query(
    "page_pagination",
    "J4 I33 F14",
    ["careers_pages"],
    """SELECT page_id, total_jobs, '2' AS current_page, CAST(greatest(1, ceil(total_jobs / 20.0)) AS BIGINT) AS total_pages FROM (
    SELECT page_id, CAST(regexp_extract(html, '(\\d+) Jobs Found', 1) AS BIGINT) AS total_jobs FROM careers_pages)""",
)
def page_pagination(i):
    return H.page_pagination(_parsed(i, "pagination"))


@query(
    "page_urls",
    "G11 I13 F14",
    ["careers_pages"],
    """SELECT page_id, CAST(n AS BIGINT) AS page_no, 'https://careers.example.org/list/all?lang=en&start=' || ((n - 1) * 20) AS url FROM (
    SELECT page_id, unnest(generate_series(2, least(5, CAST(greatest(1, ceil(CAST(regexp_extract(html, '(\\d+) Jobs Found', 1) AS BIGINT) / 20.0)) AS BIGINT)))) AS n FROM careers_pages)""",
)
def page_urls(i):
    rows = i.view("careers_pages").select("page_id", "base_url", X.total_jobs_in_text("html").alias("total_jobs"))
    return H.page_urls(rows.withColumn("total_pages", X.page_count("total_jobs")), 5).select("page_id", "page_no", "url")


@query(
    "search_forms",
    "J5",
    ["careers_pages"],
    "SELECT page_id, '/search' AS search_url, 'post' AS search_method, 'q,loc' AS search_fields FROM careers_pages",
)
def search_forms(i):
    return _parsed(i, "search").select("page_id", "search_url", "search_method", F.array_join("search_fields", ",").alias("search_fields"))


USED = [
    ("job_container", ".job-item", 1),
    ("job_container", ".opening-item", 1),
    ("job_container", "[data-job-id]", 1),
    ("job_container", "[data-posting-id]", 1),
    ("job_title", ".job-title", 1),
    ("job_title", "h2", 1),
    ("job_title", "h3", 2),
    ("job_location", ".job-location", 1),
    ("job_location", ".location", 1),
    ("job_department", ".department", 1),
    ("job_type", ".job-type", 1),
    ("job_url", 'a[href*="/jobs/"]', 2),
    ("job_url", 'a[href*="/job/"]', 1),
    ("job_url", 'a[href*="/position/"]', 1),
    ("job_url", ".job-title a", 1),
    ("pagination", ".pagination", 1),
]
USED_SQL = ", ".join(f"('{c}', '{s}', {n})" for c, s, n in USED)


@query(
    "selector_usage",
    "F6",
    None,
    f"SELECT category, selector, per_page * n_pages AS n_matches FROM (VALUES {USED_SQL}) AS used(category, selector, per_page), (SELECT count(*) AS n_pages FROM documents)",
)
def selector_usage(i):
    return R.selector_usage(H.selector_matches(_parsed(i, "usage")))


@query(
    "html_fallback",
    "C15 J6 D2",
    ["careers_pages"],
    """SELECT page_id, job_id, title, company_name, location, source_url, 'greenhouse' AS ats_provider, 'html_fallback' AS extraction_method FROM (
      SELECT page_id, substr(md5(regexp_extract(html, '<a href="/jobs/[0-9]+">([^<]*)</a>', 1) || company_name), 1, 12) AS job_id, regexp_extract(html, '<a href="/jobs/[0-9]+">([^<]*)</a>', 1) AS title, company_name, 'Berlin' AS location, base_url AS source_url FROM careers_pages
      UNION ALL SELECT page_id, CAST(page_id AS VARCHAR), regexp_extract(html, '>(Opening [^<]*)</a>', 1), company_name, 'Oslo', base_url FROM careers_pages) WHERE length(trim(title)) >= 3""",
)
def html_fallback(i):
    rows = H.fallback_jobs(i.view("careers_pages"))
    return rows.select(
        "page_id", "job_id", "title", "company_name", "location", "source_url", "ats_provider", "extraction_method"
    )


# ---- vectors ----


def _centres(i: Inputs) -> DataFrame:
    return VC.label_centres(i.table("embeddings"), "label", "embedding")


CENTRES = """centres AS (SELECT label, list(x ORDER BY pos) AS centre FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"""


NEAREST = f"""WITH {CENTRES} SELECT query_id, id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
      SELECT c.label AS query_id, vec_id AS id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre) AS similarity,
      row_number() OVER (PARTITION BY c.label ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre) DESC, vec_id) AS rank FROM embeddings e CROSS JOIN centres c) WHERE rank <= 10"""


def _nearest_shown(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("query_id").cast("int").alias("query_id"), "id", F.round("similarity", 6).alias("similarity"), "rank")


@query("knn_exact", "M1", None, NEAREST)
def knn_exact(i):
    return _nearest_shown(VC.knn(i.table("embeddings"), "vec_id", "embedding", _centres(i), "label", "centre", 10))


@query("knn_grid", "M1", None, NEAREST)
def knn_grid(i):
    """The same search in blocks of four queries."""
    rows = VC.knn(i.table("embeddings"), "vec_id", "embedding", _centres(i), "label", "centre", 10, query_block=4)
    return _nearest_shown(rows)


def _lists(i: Inputs) -> DataFrame:
    """One list per label, around the label's mean."""
    return _centres(i).select(F.col("label").cast("int").alias("list_id"), "centre")


def _searched(i: Inputs, centres: DataFrame, probes: int) -> DataFrame:
    path, centres = work_dir(i.spark, "lists"), stage(centres, "centres")
    VC.write_lists(i.table("embeddings"), "embedding", centres, path)
    return VC.knn_ivf(path, centres, "vec_id", "embedding", _centres(i), "label", "centre", 10, probes)


@query("knn_ivf_every_list", "M2", None, NEAREST)
def knn_ivf_every_list(i):
    """With every list probed the inverted lists give the exact answer."""
    return _nearest_shown(_searched(i, VC.train_lists(i.table("embeddings"), "embedding", 12), 12))


@query(
    "knn_ivf",
    "M2",
    None,
    f"""WITH {CENTRES}, inlist AS (SELECT vec_id, e.embedding, c.label AS list_id, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre), 12) DESC, c.label) AS near FROM embeddings e CROSS JOIN centres c),
      probed AS (SELECT q.label AS query_id, c.label AS list_id, row_number() OVER (PARTITION BY q.label ORDER BY round(list_cosine_similarity(q.centre, c.centre), 12) DESC, c.label) AS near FROM centres q CROSS JOIN centres c)
      SELECT query_id, id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT c.label AS query_id, vec_id AS id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre) AS similarity,
      row_number() OVER (PARTITION BY c.label ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre) DESC, vec_id) AS rank
      FROM inlist e JOIN probed p ON p.list_id = e.list_id AND e.near = 1 AND p.near <= 3 JOIN centres c ON c.label = p.query_id) WHERE rank <= 10""",
)
def knn_ivf(i):
    """Three of the lists are probed; the lists lie around the label means, so SQL can state them."""
    return _nearest_shown(_searched(i, _lists(i), 3))


def _fiftieth(i: Inputs) -> DataFrame:
    return i.table("embeddings").filter("vec_id % 50 = 0").select("vec_id", "embedding")


@query(
    "knn_join",
    "M1",
    None,
    """SELECT query_id, id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
      SELECT q.vec_id AS query_id, e.vec_id AS id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS similarity,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 12) DESC, e.vec_id) AS rank
      FROM embeddings e CROSS JOIN embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 10""",
)
def knn_join(i):
    """Every fiftieth row as a query against all rows, exact, as a join of packets."""
    rows = VJ.search_exact(i.table("embeddings"), "vec_id", "embedding", _fiftieth(i), "vec_id", "embedding", 10, 64)
    return rows.select("query_id", "id", F.round("similarity", 6).alias("similarity"), "rank")


LISTS, PROBES = 64, 40


@query(
    "knn_recall",
    "M2",
    None,
    "SELECT count(*) AS n_queries, 10 * count(*) AS n_exact, true AS enough FROM embeddings WHERE vec_id % 50 = 0",
)
def knn_recall(i):
    """Recall of the search by lists and codes for every fiftieth row: at least 0.9 of the exact ten.

    The vectors have next to no clusters, so the neighbours lie in some two thirds of the lists.
    """
    rows, path = i.table("embeddings"), work_dir(i.spark, "codes")
    centres = stage(VC.train_lists(rows, "embedding", LISTS), "centres")
    books = VJ.train_codebooks(rows, "vec_id", "embedding")
    VJ.write_codes(rows, "vec_id", "embedding", centres, books, path)
    found = VJ.search_lists(path, centres, books, rows, "vec_id", "embedding", _fiftieth(i), "vec_id", "embedding", 10, PROBES)
    exact = VJ.search_exact(rows, "vec_id", "embedding", _fiftieth(i), "vec_id", "embedding", 10, 64)
    per_query = VC.recall(exact, found)
    return per_query.agg(F.count("*").alias("n_queries"), F.sum("n_exact").alias("n_exact"), (F.avg("recall") >= 0.9).alias("enough"))


# ---- agreements ----


def _agreements(i: Inputs) -> DataFrame:
    clients = i.view("clients").withColumn(
        "requested_at", F.timestamp_seconds(F.lit(1717200000) + F.col("client_key"))
    )
    return AG.with_agreement_fields(clients, F.lit("2024-06-01").cast("timestamp"))


AGREED = """agreed AS (SELECT client_key, client_email, coalesce(NULLIF(trim(client_name), ''), 'Valued Client') AS client_name, service_plan, start_date,
  'AGR-' || strftime(make_timestamp((1717200000 + client_key) * 1000000), '%Y%m%d%H%M%S') AS agreement_id,
  strftime(coalesce(TRY_CAST(start_date AS DATE), CAST(make_timestamp((1717200000 + client_key) * 1000000) AS DATE)) + INTERVAL 1 YEAR, '%Y-%m-%d') AS end_date FROM clients WHERE contains(client_email, '@'))"""


@query(
    "agreement_rows",
    "N1 I35 I36",
    ["clients"],
    f"""WITH {AGREED} SELECT client_key, agreement_id, end_date, 'Service Agreement - ' || client_name AS name, 'Service agreement for ' || client_name || ' with agreement ID: ' || agreement_id AS description,
    'tpl-1' AS template_id, 168 AS expiration_hours, split_part(client_name, ' ', 1) AS first_name, CASE WHEN contains(client_name, ' ') THEN substr(client_name, strpos(client_name, ' ') + 1) ELSE 'Client' END AS last_name,
    client_email AS email, 'signer' AS role, true AS allow_download, false AS allow_editing, 'tpl-1' AS json_template FROM agreed""",
)
def agreement_rows(i):
    rows = AG.signing_requests(_agreements(i), "tpl-1")
    recipient = F.get("request.recipients", F.lit(0))
    return rows.select(
        "client_key",
        "agreement_id",
        "end_date",
        "request.name",
        "request.description",
        "request.template_id",
        "request.expiration_hours",
        recipient["first_name"].alias("first_name"),
        recipient["last_name"].alias("last_name"),
        recipient["email"].alias("email"),
        recipient["role"].alias("role"),
        F.col("request.settings.allow_download").alias("allow_download"),
        F.col("request.settings.allow_editing_before_sending").alias("allow_editing"),
        F.get_json_object("request_json", "$.template_id").alias("json_template"),
    )


@query(
    "agreement_text",
    "N2",
    ["clients"],
    f"""WITH {AGREED} SELECT client_key, concat_ws(chr(10), 'CLIENT SERVICE AGREEMENT', 'This agreement is made between:', 'Company: Your Company Name', 'Client: ' || client_name, 'Client Information:', 'Name: ' || client_name,
    'Address: {{{{client_address}}}}', 'Date: {{{{sign_date}}}}', 'Service Details:', 'Agreement ID: ' || agreement_id, 'Service Plan: ' || service_plan, 'Pricing: $999/month', 'Service Period: ' || start_date || ' to ' || end_date,
    'Client Signature: {{{{client_signature}}}}', 'By signing below, the Client agrees to the terms', 'outlined in this agreement.') AS agreement_text FROM agreed""",
)
def agreement_text(i):
    return AG.merge_text(_agreements(i)).select("client_key", "agreement_text")


# ---- streams: run over the whole table, then read what they wrote ----


def _stream(i: Inputs, name: str) -> DataFrame:
    """A view as a stream over its table's files."""
    source, exprs = VIEWS[name]
    schema = T.StructType.fromJson(i.table(source).schema.jsonValue())
    files = ST.landing(i.spark, f"{i.sf_dir}/{source[:-1]}[{source[-1]}].parquet", schema)
    return files.selectExpr(*[e.replace("{global}", "") for e in exprs])


@query("stream_ingest", "K1", ["payloads"], " UNION ALL ".join(FEEDS.values()))
def stream_ingest(i):
    out, check = work_dir(i.spark, "ingest"), work_dir(i.spark, "ingest-checkpoint")
    ST.stream_ingest(_stream(i, "payloads"), out, check, ("payload_id", "item_pos")).awaitTermination()
    rows = i.spark.read.parquet(out)
    return rows.select(
        "payload_id", F.col("item_pos").cast("bigint").alias("item_pos"), *[stamp(c) if c == "posted_date" else c for c in SHOWN]
    )


@query(
    "stream_dedup",
    "K2",
    ["postings"],
    "SELECT lower(company_name) AS company_key, job_id, min(seq) AS seq FROM postings GROUP BY ALL",
)
def stream_dedup(i):
    out, check = work_dir(i.spark, "dedup"), work_dir(i.spark, "dedup-checkpoint")
    ST.stream_dedup(_stream(i, "postings").select("company_name", "job_id", "seq"), out, check, ["seq"]).awaitTermination()
    return i.spark.read.parquet(out).select("company_key", "job_id", "seq")


@query("stream_block_latch", "K3 G8", ["capture_log"], LATCH)
def stream_block_latch(i):
    out, check = work_dir(i.spark, "latched"), work_dir(i.spark, "latch-checkpoint")
    latches = work_dir(i.spark, "latches")
    ST.stream_block_latch(_stream(i, "capture_log"), out, latches, check).awaitTermination()
    return ST.latched(i.spark, out, latches).select("crawl_id", "seq")


@query(
    "stream_state_dedup",
    "K2",
    ["postings"],
    "SELECT lower(company_name) AS company_key, job_id, min(seq) AS seq FROM postings GROUP BY ALL",
)
def stream_state_dedup(i):
    """The running dedup by keyed state instead of a table of keys."""
    out, check = work_dir(i.spark, "state-dedup"), work_dir(i.spark, "state-dedup-checkpoint")
    rows = _stream(i, "postings").select("company_name", "job_id", "seq")
    SS.stream_first_of_key(rows, out, check, ["seq"]).awaitTermination()
    return i.spark.read.parquet(out).select("company_key", "job_id", "seq")


@query("stream_state_latch", "K3", ["capture_log"], LATCH)
def stream_state_latch(i):
    """The block latch by keyed state."""
    out, check = work_dir(i.spark, "state-latch"), work_dir(i.spark, "state-latch-checkpoint")
    SS.stream_latch(_stream(i, "capture_log"), out, check).awaitTermination()
    return SS.open_rows(i.spark, out)


@query("stream_upsert", "K4 A15 L7", ["postings"], f"WITH {UPSERTED}")
def stream_upsert(i):
    path = work_dir(i.spark, "ats_jobs")
    june, july = (F.lit(d).cast("timestamp") for d in ("2024-06-01", "2024-07-01"))
    for source, now, order in (("linkedin", june, [F.col("seq")]), ("ats", july, [F.desc("seq")])):
        landed = work_dir(i.spark, "landed")
        rows = _keyed(i).filter(F.col("source") == source).drop("source")
        rows.write.parquet(landed)
        stream = ST.landing(i.spark, landed, rows.schema)
        check = work_dir(i.spark, "upsert-checkpoint")
        ST.stream_upsert(stream, path, check, order, now, 8, ("seq",)).awaitTermination()
    return _upsert_shown(i.spark.read.parquet(path))


