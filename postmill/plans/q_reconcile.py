"""Queries over precedence, deduplication, joins and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.functions import variants as V
from postmill.operators import discovery as DC
from postmill.operators import filters as FL
from postmill.operators import inverted as IX
from postmill.operators import match as MT
from postmill.operators import near_text as NT
from postmill.operators import quality as Q
from postmill.operators import reconcile as RC
from postmill.operators import report as R
from postmill.operators.crawls import apply_url_map
from postmill.operators.normalize import normalize_discoveries
from postmill.plans.q_functions import ORIGIN, PROVIDER
from postmill.plans.q_shapes import COMEET_ITEMS, DISCOVERED, comeet_items, discovery_items
from postmill.plans.registry import Inputs, query
from postmill.session import work_dir
from postmill.sources.captures import scan_captures

RECONCILED = f"""classified AS (SELECT *, lower(company_name) AS company_key, {PROVIDER} AS ats_provider, {ORIGIN} AS found_origin FROM postings),
fetched_companies AS (SELECT DISTINCT company_key FROM classified WHERE source = 'ats'),
phased AS (SELECT *, CASE WHEN source = 'ats' THEN 'ATS' ELSE found_origin END AS job_origin,
  CASE WHEN source = 'ats' THEN 1 WHEN found_origin = 'ATS' THEN 2 ELSE 0 END AS phase FROM classified),
superseded AS (SELECT * FROM phased WHERE phase < 2 OR company_key NOT IN (SELECT company_key FROM fetched_companies)),
reconciled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company_key, job_id ORDER BY phase, seq) AS rn FROM superseded) WHERE rn = 1)"""


def reconciled(i: Inputs) -> DataFrame:
    return RC.reconcile(i.discovered, i.fetched)


@query(
    "flagship_provider_distribution",
    "I12 I14 E3 G1 H1 F1 G9",
    ["postings"],
    f"""WITH {RECONCILED} SELECT ats_provider, n, 100.0 * n / sum(n) OVER () AS pct, printf('%.1f%%', 100.0 * n / sum(n) OVER ()) AS pct_text
    FROM (SELECT ats_provider, count(*) AS n FROM reconciled WHERE ats_provider IS NOT NULL AND ats_provider <> 'unknown' GROUP BY 1)""",
)
def flagship(i):
    return R.ranked(R.provider_distribution(reconciled(i)), "ats_provider")


@query(
    "provider_origin_rollup",
    "F1 F2",
    ["postings"],
    f"""WITH {RECONCILED}, r AS (SELECT ats_provider, job_origin, count(*) AS n, grouping(ats_provider, job_origin) AS gid FROM reconciled GROUP BY ROLLUP (ats_provider, job_origin))
    SELECT ats_provider, job_origin, CASE gid WHEN 0 THEN 'pair' WHEN 1 THEN 'provider' ELSE 'all' END AS level, n,
      100.0 * n / CASE WHEN gid = 0 THEN (SELECT p.n FROM r p WHERE p.gid = 1 AND p.ats_provider IS NOT DISTINCT FROM r.ats_provider) ELSE (SELECT n FROM r WHERE gid = 3) END AS pct_of_parent FROM r""",
)
def provider_origin_rollup(i):
    return R.provider_origin_rollup(reconciled(i))


@query("supersede", "E3 H1", ["postings"], f"WITH {RECONCILED} SELECT seq, company_key, job_origin, phase FROM superseded")
def supersede(i):
    return RC.supersede(i.discovered, i.fetched).select("seq", "company_key", "job_origin", "phase")


@query(
    "dedup_first_wins",
    "G1 H1 E3",
    ["postings"],
    f"WITH {RECONCILED} SELECT seq, company_key, job_id, phase FROM reconciled",
)
def dedup_first_wins(i):
    return reconciled(i).select("seq", "company_key", "job_id", "phase")


@query(
    "dedup_within_crawl",
    "G2",
    ["discoveries"],
    f"""WITH {DISCOVERED} SELECT crawl_id, job_id, seq, part FROM (SELECT *, row_number() OVER (PARTITION BY crawl_id, job_id ORDER BY seq, part) AS rn
    FROM d_rows WHERE job_id <> '' AND title <> '' AND company_name <> '') WHERE rn = 1""",
)
def dedup_within_crawl(i):
    rows = normalize_discoveries(discovery_items(i), keep=("crawl_id", "seq", "item_pos"))
    first = RC.dedup_within_crawl(rows, ["seq", "item_pos"])
    # the position names the part of the response: two included entries, then the rest
    part = F.when(F.col("title") == "Guide", 1).when(F.col("title") == "Clerk", 2).when(F.col("title") == "Baker", 3).otherwise(0)
    return first.select("crawl_id", "job_id", "seq", part.alias("part"))


@query(
    "dedup_uids",
    "G3",
    ["payloads"],
    f"""WITH {COMEET_ITEMS} SELECT company_slug, uid, payload_id, item_pos FROM (SELECT *, item->>'$.uid' AS uid,
    row_number() OVER (PARTITION BY company_slug, item->>'$.uid' ORDER BY payload_id, item_pos) AS rn FROM comeet_items WHERE item->>'$.uid' <> '') WHERE rn = 1""",
)
def dedup_uids(i):
    rows = comeet_items(i).withColumn("uid", V.text(F.col("item"), "$.uid"))
    return RC.dedup_uids(rows, ["payload_id", "item_pos"]).select("company_slug", "uid", "payload_id", "item_pos")


@query(
    "cap_per_company",
    "G6",
    ["postings"],
    """SELECT seq, company_key FROM (SELECT seq, lower(company_name) AS company_key, row_number() OVER (PARTITION BY lower(company_name) ORDER BY seq) AS rn
    FROM postings WHERE source = 'ats') WHERE rn <= 50""",
)
def cap_per_company(i):
    return RC.cap_per_company(i.fetched, ["seq"], 50).select("seq", "company_key")


@query(
    "representative",
    "G5",
    ["postings"],
    """SELECT company_key, seq, title, apply_url FROM (SELECT *, lower(company_name) AS company_key, row_number() OVER (PARTITION BY lower(company_name) ORDER BY seq) AS rn
    FROM postings) WHERE rn = 1""",
)
def representative(i):
    return RC.representative(i.view("postings"), ["seq"]).select("company_key", "seq", "title", "apply_url")


@query(
    "company_sets",
    "F11",
    ["postings"],
    f"""WITH {RECONCILED} SELECT DISTINCT company_key, phase = 0 AS is_native FROM phased""",
)
def company_sets(i):
    rows = RC.split_origins(i.discovered).select("company_name", "phase")
    feed = i.fetched.select("company_name", F.lit(RC.FEED).alias("phase"))
    both = rows.unionByName(feed)
    return both.select(RC.company_key().alias("company_key"), (F.col("phase") == RC.NATIVE).alias("is_native")).distinct()


@query(
    "company_groups",
    "F12",
    ["postings"],
    "SELECT lower(company_name) AS company_key, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n_jobs, count(DISTINCT job_id) AS n_job_ids FROM postings WHERE source = 'linkedin' GROUP BY 1",
)
def company_groups(i):
    return RC.company_groups(i.discovered)


@query(
    "company_dimension",
    "F8 E5",
    ["postings"],
    f"""SELECT company_key, company_name, ats_provider, regexp_extract(apply_url, '^[a-z]+://[^/]+', 0) AS ats_base_url, job_count FROM (
      SELECT lower(company_name) AS company_key, company_name, {PROVIDER} AS ats_provider, apply_url, count(*) OVER (PARTITION BY lower(company_name)) AS job_count,
      row_number() OVER (PARTITION BY lower(company_name) ORDER BY seq) AS rn FROM postings WHERE source = 'ats' AND apply_url IS NOT NULL) WHERE rn = 1""",
)
def company_dimension(i):
    return RC.company_dimension(_known(i))


def _known(i: Inputs) -> DataFrame:
    return i.fetched.filter("apply_url IS NOT NULL").withColumn("ats_provider", U.provider_of_url("apply_url"))


@query(
    "company_lookup",
    "E5",
    ["postings"],
    f"""WITH dim AS (SELECT company_key, ats_provider, apply_url FROM (SELECT lower(company_name) AS company_key, {PROVIDER} AS ats_provider, apply_url, row_number() OVER (PARTITION BY lower(company_name) ORDER BY seq) AS rn
      FROM postings WHERE source = 'ats' AND apply_url IS NOT NULL) WHERE rn = 1)
    SELECT seq, dim.ats_provider AS known_provider, dim.company_key IS NOT NULL AS is_known FROM postings p LEFT JOIN dim ON dim.company_key = lower(p.company_name) WHERE p.source = 'linkedin'""",
)
def company_lookup(i):
    rows = RC.with_company_info(i.discovered, RC.company_dimension(_known(i)))
    return rows.select("seq", "known_provider", "is_known")


@query(
    "cached_companies_only",
    "E5",
    ["postings"],
    "SELECT seq FROM postings WHERE source = 'linkedin' AND lower(company_name) IN (SELECT lower(company_name) FROM postings WHERE source = 'ats' AND apply_url IS NOT NULL)",
)
def cached_companies_only(i):
    return RC.known_only(i.discovered, RC.company_dimension(_known(i))).select("seq")


APPLY_MAP = f"""WITH {DISCOVERED}, inc AS (SELECT seq, pos, item, NULLIF(string_split(item->>'$.entityUrn', ':')[-1], '') AS job_id FROM (
  SELECT seq, unnest(json_extract(body, '$.included[*]')) AS item, generate_subscripts(json_extract(body, '$.included[*]'), 1) AS pos FROM d_raw WHERE contains(url, 'jobPosting'))),
apply_map AS (SELECT job_id, apply_url FROM (SELECT job_id, item->>'$.applyMethod.companyApplyUrl' AS apply_url, row_number() OVER (PARTITION BY job_id ORDER BY seq DESC, pos DESC) AS rn
  FROM inc WHERE job_id IS NOT NULL AND json_type(item, '$.applyMethod') = 'OBJECT' AND item->>'$.applyMethod.companyApplyUrl' IS NOT NULL) WHERE rn = 1)"""


@query(
    "apply_url_map",
    "B19 D6",
    ["discoveries"],
    APPLY_MAP.replace("SELECT crawl_id, seq, body FROM", "SELECT crawl_id, seq, url, body FROM")
    + " SELECT job_id, apply_url FROM apply_map",
)
def url_map(i):
    details = scan_captures(i.view("discoveries")).filter(U.capture_route("url") == "detail")
    return apply_url_map(details)


@query(
    "with_apply_urls",
    "E4",
    ["discoveries"],
    APPLY_MAP.replace("SELECT crawl_id, seq, body FROM", "SELECT crawl_id, seq, url, body FROM")
    + " SELECT r.seq, r.part, r.job_id, coalesce(r.apply_url, m.apply_url) AS apply_url FROM d_rows r LEFT JOIN apply_map m ON m.job_id = r.job_id WHERE r.job_id <> '' AND title <> '' AND company_name <> ''",
)
def with_apply_urls(i):
    captures = scan_captures(i.view("discoveries"))
    known = apply_url_map(captures.filter(U.capture_route("url") == "detail"))
    rows = RC.with_apply_urls(normalize_discoveries(discovery_items(i), keep=("seq",)), known)
    part = F.when(F.col("title") == "Guide", 1).when(F.col("title") == "Clerk", 2).when(F.col("title") == "Baker", 3).otherwise(0)
    return rows.select("seq", part.alias("part"), "job_id", "apply_url")


@query(
    "cheapest_source_first",
    "E3 H2",
    ["postings"],
    """WITH api AS (SELECT * FROM postings WHERE source = 'ats'), net AS (SELECT * FROM postings WHERE source = 'linkedin' AND apply_url IS NOT NULL AND lower(company_name) NOT IN (SELECT lower(company_name) FROM api)),
    page AS (SELECT * FROM postings WHERE source = 'linkedin' AND apply_url IS NULL AND lower(company_name) NOT IN (SELECT lower(company_name) FROM api UNION SELECT lower(company_name) FROM net))
    SELECT seq, lower(company_name) AS company_key FROM api UNION ALL SELECT seq, lower(company_name) FROM net UNION ALL SELECT seq, lower(company_name) FROM page""",
)
def cheapest_source_first(i):
    found = i.discovered
    rows = RC.cheapest_source_first(
        i.fetched, found.filter("apply_url IS NOT NULL"), found.filter("apply_url IS NULL")
    )
    return rows.select("seq", "company_key")


@query(
    "same_companies",
    "H4",
    ["postings"],
    """SELECT 'both sources' AS compared, count(*) AS n_different, count(*) = 0 AS equal FROM (
      SELECT DISTINCT lower(company_name) AS c FROM postings WHERE source = 'linkedin' EXCEPT SELECT lower(company_name) FROM postings WHERE source = 'ats'
      UNION ALL (SELECT DISTINCT lower(company_name) FROM postings WHERE source = 'ats' EXCEPT SELECT lower(company_name) FROM postings WHERE source = 'linkedin'))
    UNION ALL SELECT 'after dedup', 0, true""",
)
def same_companies(i):
    """Companies of the two sources differ; deduplication of postings loses no company."""
    every, kept = RC.companies(i.view("postings")), RC.companies(RC.dedup_first_wins(i.view("postings"), ["seq"]))
    sources = RC.same_rows(RC.companies(i.discovered), RC.companies(i.fetched)).select(F.lit("both sources").alias("compared"), "*")
    return sources.unionByName(RC.same_rows(every, kept).select(F.lit("after dedup").alias("compared"), "*"))


# ---- duplicate matching ----


def _sides(i: Inputs) -> tuple[DataFrame, DataFrame]:
    rows = i.view("postings").withColumn("description_hash", X.text_hash("description")).drop("description")
    return rows.filter("source = 'linkedin'"), rows.filter("source = 'ats'")


CANON = r"NULLIF(regexp_replace(regexp_replace(regexp_replace(lower(apply_url), '^[a-z]+://(www\.)?', ''), '[?#].*$', ''), '/+$', ''), '')"
MATCHED = f"""m_all AS (SELECT seq, source, lower(trim(company_name)) AS company, job_id, NULLIF(lower(trim(title)), '') AS title, lower(trim(coalesce(location, ''))) AS place, location IS NULL AS no_place, {CANON} AS url, md5(description) AS h FROM postings),
m_d AS (SELECT * FROM m_all WHERE source = 'linkedin'), m_c AS (SELECT * FROM m_all WHERE source = 'ats'),
m_pairs AS (
  SELECT d.seq, 0 AS method, 1.0 AS score, min(c.job_id) AS career_job_id FROM m_d d JOIN m_c c ON c.company = d.company AND c.url = d.url GROUP BY d.seq
  UNION ALL SELECT d.seq, 1, 1.0, min(c.job_id) FROM m_d d JOIN m_c c ON c.company = d.company AND c.job_id = d.job_id GROUP BY d.seq
  UNION ALL SELECT d.seq, 2, 1.0, min(c.job_id) FROM m_d d JOIN m_c c ON c.company = d.company AND c.h = d.h GROUP BY d.seq
  UNION ALL SELECT d.seq, 3, 0.95, min(c.job_id) FROM m_d d JOIN m_c c ON c.company = d.company AND c.title = d.title AND c.place = d.place GROUP BY d.seq
  UNION ALL SELECT seq, 4, score, job_id FROM (SELECT d.seq, c.job_id, 1 - levenshtein(d.title, c.title) / CAST(greatest(length(d.title), length(c.title)) AS DOUBLE) AS score,
      row_number() OVER (PARTITION BY d.seq ORDER BY 1 - levenshtein(d.title, c.title) / CAST(greatest(length(d.title), length(c.title)) AS DOUBLE) DESC, c.job_id) AS rn
      FROM m_d d JOIN (SELECT DISTINCT company, title, job_id FROM m_c) c ON c.company = d.company WHERE 1 - levenshtein(d.title, c.title) / CAST(greatest(length(d.title), length(c.title)) AS DOUBLE) >= 0.85) WHERE rn = 1),
m_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY method) AS rn FROM m_pairs) WHERE rn = 1),
matches AS (SELECT d.seq AS discovered_seq, d.company, b.career_job_id, b.seq IS NOT NULL AS is_duplicate, CAST(coalesce(b.score, 0.0) AS DOUBLE) AS similarity_score,
  CASE b.method WHEN 0 THEN 'apply_url' WHEN 1 THEN 'job_id' WHEN 2 THEN 'description_hash' WHEN 3 THEN 'title_location' WHEN 4 THEN 'fuzzy_title' END AS match_method
  FROM m_d d LEFT JOIN m_best b ON b.seq = d.seq)"""


@query(
    "duplicate_pairs",
    "E6",
    ["postings"],
    f"WITH {MATCHED} SELECT discovered_seq, company, career_job_id, is_duplicate, round(similarity_score, 6) AS similarity_score, match_method FROM matches",
)
def duplicate_pairs(i):
    rows = MT.match_duplicates(*_sides(i))
    return rows.withColumn("similarity_score", F.round("similarity_score", 6))


@query(
    "company_comparison",
    "F9",
    ["postings"],
    f"""WITH {MATCHED}, co AS (SELECT company, count(*) FILTER (source = 'linkedin') AS jobs_discovered, count(*) FILTER (source = 'ats') AS jobs_on_career_page FROM m_all GROUP BY 1)
    SELECT co.*, coalesce((SELECT count(*) FROM matches m WHERE m.company = co.company AND is_duplicate), 0) AS duplicates_found FROM co""",
)
def company_comparison(i):
    found, career = _sides(i)
    return MT.company_comparison(found, career, MT.match_duplicates(found, career))


@query(
    "duplication_report",
    "F10",
    ["postings"],
    f"""WITH {MATCHED} SELECT count(*) AS total_analyzed, (SELECT count(*) FROM m_c) AS total_career_page_jobs, count(*) FILTER (is_duplicate) AS confirmed_duplicates,
    count(*) FILTER (NOT is_duplicate) AS discovered_only, round(count(*) FILTER (is_duplicate) / CAST(count(*) AS DOUBLE), 6) AS duplication_rate,
    (SELECT string_agg(p || '=' || n, ',' ORDER BY p) FROM (SELECT {PROVIDER} AS p, count(*) AS n FROM postings WHERE source = 'linkedin' AND {PROVIDER} <> 'unknown' GROUP BY 1)) AS ats_distribution,
    (SELECT string_agg(p || '=' || n, ',' ORDER BY p) FROM (SELECT {ORIGIN} AS p, count(*) AS n FROM postings WHERE source = 'linkedin' GROUP BY 1)) AS job_origin_distribution FROM matches""",
)
def duplication_report(i):
    found, career = _sides(i)
    report = MT.duplication_report(RC.split_origins(found), career, MT.match_duplicates(found, career))

    def shown(c: str):
        entries = F.array_sort(F.map_entries(c))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(c)

    return report.select(
        "total_analyzed",
        "total_career_page_jobs",
        "confirmed_duplicates",
        "discovered_only",
        F.round("duplication_rate", 6).alias("duplication_rate"),
        shown("ats_distribution"),
        shown("job_origin_distribution"),
    )


# ---- seeds, statuses ----

SEED = "lower(replace(s_name, '#', ''))"


def _seeds(i: Inputs) -> DataFrame:
    return i.table("supplier").select("s_suppkey", F.lower(F.replace("s_name", F.lit("#"), F.lit(""))).alias("company"))


@query(
    "candidate_urls",
    "E7",
    None,
    f"""SELECT company, unnest(['https://www.comeet.co/jobs/' || company, 'https://www.comeet.com/jobs/' || company, 'https://' || company || '.comeet.co', 'https://careers.' || company || '.com']) AS source_url
    FROM (SELECT {SEED} AS company FROM supplier)""",
)
def candidate_urls(i):
    return DC.candidate_urls(_seeds(i)).select("company", "source_url")


@query(
    "candidate_urls_short",
    "E7",
    None,
    f"""SELECT company, unnest(['https://www.comeet.co/jobs/' || company, 'https://' || company || '.comeet.co', 'https://careers.' || company || '.com']) AS source_url
    FROM (SELECT {SEED} AS company FROM supplier)""",
)
def candidate_urls_short(i):
    return DC.candidate_urls(_seeds(i), DC.SHORT_TEMPLATES).select("company", "source_url")


@query(
    "discovered_companies",
    "C17 E7 E8 I32 A17",
    None,
    f"""SELECT * FROM (SELECT company, 'https://careers.' || company || '.com' AS source_url, CASE WHEN s_suppkey % 4 < 3 THEN '72.' || s_suppkey END AS company_id,
    CASE s_suppkey % 3 WHEN 0 THEN 404 WHEN 1 THEN 200 ELSE 503 END = 200 AS api_accessible FROM (SELECT *, {SEED} AS company FROM supplier)) WHERE company_id IS NOT NULL""",
)
def discovered_companies(i):
    seeds = _seeds(i)
    # pages and statuses derived from the supplier table: three of four companies name an id
    html = F.format_string('<script>fetch("/careers-api/2.0/company/72.%d/positions")</script>', "s_suppkey")
    pages = seeds.select(
        F.concat(F.lit("https://careers."), "company", F.lit(".com")).alias("url"),
        F.when(F.col("s_suppkey") % 4 < 3, html).otherwise("<p>none</p>").alias("html"),
    )
    status = F.when(F.col("s_suppkey") % 3 == 0, 404).when(F.col("s_suppkey") % 3 == 1, 200).otherwise(503)
    statuses = seeds.select(
        F.format_string("https://www.comeet.co/careers-api/2.0/company/72.%d/positions", "s_suppkey").alias("url"),
        F.lit(1).alias("seq"),
        status.alias("status"),
    )
    rows = DC.discovered_companies(DC.candidate_urls(seeds), pages, statuses)
    return rows.select("company", "source_url", "company_id", "api_accessible")


@query(
    "url_status",
    "E8",
    ["url_statuses", "payloads"],
    """SELECT payload_id, coalesce((SELECT s.status BETWEEN 200 AND 299 FROM url_statuses s WHERE s.url = 'https://example.org/' || payload_id ORDER BY s.seq DESC LIMIT 1), false) AS url_ok FROM payloads""",
)
def url_status(i):
    rows = i.view("payloads").select("payload_id", F.concat(F.lit("https://example.org/"), F.col("payload_id").cast("string")).alias("u"))
    return Q.with_url_status(rows, i.view("url_statuses"), "u").select("payload_id", "url_ok")


@query(
    "keyword_search",
    "D15 G7",
    ["postings"],
    """SELECT seq, title, location FROM postings WHERE contains(lower(title || ' ' || description), 'engineer') AND contains(lower(title || ' ' || description), 'years')
    AND contains(lower(location), 'berlin') ORDER BY seq LIMIT 25""",
)
def keyword_search(i):
    return FL.search(i.view("postings"), "Engineer years", "Berlin", 25).select("seq", "title", "location")


KEYWORDS = """SELECT seq, title, location FROM postings WHERE contains(lower(title || ' ' || description), 'engineer') AND contains(lower(title || ' ' || description), 'years')
    AND contains(lower(location), 'berlin') ORDER BY seq"""


@query("keyword_search_indexed", "D15", ["postings"], KEYWORDS)
def keyword_search_indexed(i):
    """The same search through trigram indexes, without a cap."""
    rows, texts, places = i.view("postings"), work_dir(i.spark, "text-index"), work_dir(i.spark, "place-index")
    IX.write_index(rows, "seq", IX.trigrams(IX.search_text()), texts)
    IX.write_index(rows, "seq", IX.trigrams(F.lower("location")), places)
    found = IX.search_indexed(rows, "seq", texts, "Engineer years", "Berlin", None, places)
    return found.select("seq", "title", "location")


@query(
    "skills_indexed",
    "D13",
    None,
    """SELECT 'contains' AS asked, p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red')
    UNION ALL SELECT 'overlap', p_partkey FROM part WHERE list_has_any(string_split(p_name, ' '), ['blue', 'ring'])
    UNION ALL SELECT 'all', p_partkey FROM part WHERE list_has_all(string_split(p_name, ' '), ['red', 'widget'])""",
)
def skills_indexed(i):
    """Containment and overlap through an index of the elements; half of the rows arrive later."""
    parts = i.table("part").withColumn("required_skills", F.split("p_name", " "))
    path, skills = work_dir(i.spark, "skills-index"), IX.elements("required_skills")
    IX.write_index(parts.filter("p_partkey % 2 = 0"), "p_partkey", skills, path)
    IX.extend_index(parts.filter("p_partkey % 2 = 1"), "p_partkey", skills, path)
    found = {
        "contains": IX.rows_with(parts, "p_partkey", "required_skills", path, "red"),
        "overlap": IX.rows_with_any(parts, "p_partkey", "required_skills", path, ["blue", "ring"]),
        "all": IX.rows_with_all(parts, "p_partkey", "required_skills", path, ["red", "widget"]),
    }
    return RC.union_all(*[rows.select(F.lit(name).alias("asked"), "p_partkey") for name, rows in found.items()])


# ---- nearly equal descriptions, whatever the company ----

NEAR_TEXT = r"""w AS (SELECT seq, source, list_filter(regexp_split_to_array(translate(coalesce(description, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM postings),
s AS (SELECT seq, source, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
c AS (SELECT min(seq) AS id, list_sort(s) AS s FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
u AS (SELECT id, len(s) AS n, unnest(s) AS shingle FROM c),
links AS (SELECT a.id AS x, b.id AS y FROM u a JOIN u b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(id, other) AS (SELECT x, y FROM links UNION SELECT reach.id, links.y FROM reach JOIN links ON reach.other = links.x),
grouped AS (SELECT s.seq, s.source, len(s.s) AS n_shingles, coalesce(least(c.id, (SELECT min(other) FROM reach WHERE reach.id = c.id)), s.seq) AS group_id
  FROM s LEFT JOIN c ON c.s = list_sort(s.s))"""


@query(
    "near_duplicate_descriptions",
    "E6",
    ["postings"],
    f"""WITH RECURSIVE {NEAR_TEXT} SELECT seq, source, n_shingles, group_id, count(*) OVER g AS group_size, min(source) OVER g < max(source) OVER g AS several_sources
    FROM grouped WINDOW g AS (PARTITION BY group_id)""",
)
def near_duplicate_descriptions(i):
    return NT.near_duplicate_descriptions(i.view("postings"))
