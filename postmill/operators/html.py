"""Job cards, pagination and search forms in HTML pages.

The one place where Python touches rows: HTML has no JVM-side reader. An Arrow
UDF gets only the page text, parses it once and returns everything a page
yields; all rules on the extracted values are column expressions again.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from postmill.functions import text as X
from postmill.functions import urls as U
from postmill.session import run_on_workers

run_on_workers(__name__)

# ---- fixed values: selectors per field, in order of preference ----
SELECTORS = {
    "job_container": [
        ".job-item",
        ".job-posting",
        ".job-listing",
        ".opening-item",
        ".position-item",
        "[data-job-id]",
        "[data-posting-id]",
        ".css-1q2dra3",
        '[data-automation-id*="job"]',
        '[data-automation-id*="posting"]',
    ],
    "job_title": [
        ".job-title",
        ".job-name",
        ".position-title",
        ".opening-title",
        "h2",
        "h3",
        '[data-automation-id*="title"]',
        ".job-posting-title",
    ],
    "job_location": [
        ".job-location",
        ".job-city",
        ".location",
        ".position-location",
        ".opening-location",
        '[data-automation-id*="location"]',
        ".job-posting-location",
    ],
    "job_department": [
        ".job-department",
        ".department",
        ".job-category",
        ".job-function",
        '[data-automation-id*="department"]',
    ],
    "job_type": [
        ".job-type",
        ".employment-type",
        ".job-status",
        ".position-type",
        '[data-automation-id*="type"]',
    ],
    "job_url": [
        'a[href*="/jobs/"]',
        'a[href*="/job/"]',
        'a[href*="/position/"]',
        ".job-title a",
        ".job-posting a",
        '[data-automation-id*="title"] a',
    ],
    "pagination": [
        ".pagination",
        ".pagination-controls",
        ".page-navigation",
        '[data-automation-id*="pagination"]',
    ],
}
CURRENT_PAGE = '.current, .active, [aria-current="page"]'
PAGE_LINKS = 'a[href*="page"], a[href*="start="]'
SEARCH_FORM = 'form[action*="search"], form[action*="filter"]'
FORM_FIELDS = "input, select, textarea"
# provider -> selectors of the last-resort reader
PROVIDER_SELECTORS = {
    "greenhouse": {
        "container": ".opening, [data-job-id], .job-post",
        "title": "a, .job-title, h3",
        "location": ".location, .job-location",
    },
    "lever": {
        "container": ".posting, [data-qa='posting-name']",
        "title": "h5, .posting-title, a",
        "location": ".location, .posting-categories .sort-by-location",
    },
    "workday": {
        "container": "[data-automation-id='jobTitle'], .css-19uc56f, .job-listing",
        "title": "a, span",
        "location": "[data-automation-id='location'], .css-location",
    },
    "ashby": {
        "container": ".ashby-job-posting, [data-job-id]",
        "title": "a, h3, .job-title",
        "location": ".location",
    },
}
JOB_ID_IN_HREF = r"/jobs?/(\d+)"
MIN_TITLE_CHARS = 3

PAGE_TYPE = (
    "jobs array<struct<title:string,location:string,department:string,type:string,url:string,"
    "metadata:map<string,string>>>, "
    "total_jobs bigint, current_page string, page_links bigint, "
    "search_url string, search_method string, search_fields array<string>, "
    "usage array<struct<category:string,selector:string,n_matches:bigint>>"
)
CARD_TYPE = "cards array<struct<title:string,location:string,href:string>>"

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PART = re.compile(r"""([A-Za-z][\w-]*)|\.([\w-]+)|\[([\w-]+)(?:(\*?=)["']?([^"'\]]*)["']?)?\]""")


class _Node:
    __slots__ = ("tag", "attrs", "classes", "parent", "first", "last", "begin", "end")

    def __init__(self, tag, attrs, parent, first, begin):
        self.tag, self.attrs, self.parent, self.first, self.begin = tag, attrs, parent, first, begin
        self.classes = (attrs.get("class") or "").split()
        self.last = self.end = None


class Page(HTMLParser):
    """Parsed page: nodes in document order, indexed by tag, class and attribute."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[_Node] = []
        self.texts: list[tuple[int, str]] = []  # (number of nodes opened before, text)
        self.index: dict[tuple[str, str], list[int]] = defaultdict(list)
        self._open: list[_Node] = []
        try:
            self.feed(html)
            self.close()
        except AssertionError:
            pass  # markup the parser rejects: keep what was read so far
        while self._open:
            self._shut(self._open.pop())
        self._starts = [n for n, _ in self.texts]

    def _shut(self, node: _Node) -> None:
        node.last, node.end = len(self.nodes), len(self.texts)

    def handle_starttag(self, tag, attrs):
        parent = self._open[-1] if self._open else None
        node = _Node(tag, {k: v or "" for k, v in attrs}, parent, len(self.nodes), len(self.texts))
        self.nodes.append(node)
        self.index["tag", tag].append(node.first)
        for c in set(node.classes):
            self.index["class", c].append(node.first)
        for a in node.attrs:
            self.index["attr", a].append(node.first)
        if tag in _VOID:
            self._shut(node)
        else:
            self._open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._shut(self._open.pop())

    def handle_endtag(self, tag):
        if any(n.tag == tag for n in self._open):
            while True:
                node = self._open.pop()
                self._shut(node)
                if node.tag == tag:
                    return

    def handle_data(self, data):
        if data.strip():
            self.texts.append((len(self.nodes), data.strip()))

    def text(self, node: _Node) -> str:
        return "".join(t for _, t in self.texts[node.begin : node.end])

    def signature(self, node: _Node) -> tuple:
        """Equal for elements with equal markup."""
        inside = self.nodes[node.first : node.last]
        shape = tuple((n.tag, tuple(n.attrs.items()), n.last - n.first) for n in inside)
        return shape, tuple((n - node.first, t) for n, t in self.texts[node.begin : node.end])

    def select(self, selector: str, within: _Node | None = None) -> list[_Node]:
        """Matches in document order; ``within`` limits them to its descendants."""
        return [self.nodes[i] for i in sorted(set(self._hits(selector, within)))]

    def first(self, selector: str, within: _Node | None = None) -> _Node | None:
        hit = min(self._hits(selector, within), default=None)
        return None if hit is None else self.nodes[hit]

    def _hits(self, selector: str, within: _Node | None) -> Iterator[int]:
        lo, hi = (within.first + 1, within.last) if within else (0, len(self.nodes))
        for key, chain in _COMPILED.get(selector) or _compile(selector):
            spots = self.index.get(key)
            if spots:
                for i in spots[bisect_left(spots, lo) : bisect_left(spots, hi)]:
                    if _matches(self.nodes[i], chain):
                        yield i

    def first_text(self, selectors: list[str], within: _Node) -> str | None:
        for s in selectors:
            node = self.first(s, within)
            if node and self.text(node):
                return self.text(node)
        return None


_COMPILED: dict[str, list] = {}


def _compile(selector: str) -> list:
    """Comma list of descendant chains of (kind, name, operator, value) tests, each with
    the index entry its last element is found by.
    """
    alternatives = []
    for part in selector.split(","):
        chain = []
        for compound in part.split():
            tests = []
            for tag, cls, attr, op, value in _PART.findall(compound):
                if tag:
                    tests.append(("tag", tag, "", ""))
                elif cls:
                    tests.append(("class", cls, "", ""))
                else:
                    tests.append(("attr", attr, op, value))
            chain.append(tests)
        alternatives.append((chain[-1][0][:2], chain))
    _COMPILED[selector] = alternatives
    return alternatives


def _passes(node: _Node, tests: list) -> bool:
    for kind, name, op, value in tests:
        if kind == "tag":
            ok = node.tag == name
        elif kind == "class":
            ok = name in node.classes
        else:
            have = node.attrs.get(name)
            ok = have is not None and (not op or (value in have if op == "*=" else value == have))
        if not ok:
            return False
    return True


def _matches(node: _Node, chain: list) -> bool:
    if not _passes(node, chain[-1]):
        return False
    up = node.parent
    for tests in reversed(chain[:-1]):
        while up is not None and not _passes(up, tests):
            up = up.parent
        if up is None:
            return False
        up = up.parent
    return True


def _jobs(page: Page, base_url: str, selectors: dict[str, list[str]]) -> list[dict]:
    jobs, seen = [], set()
    for selector in selectors["job_container"]:
        for box in page.select(selector):
            mark = page.signature(box)
            if mark in seen:
                continue
            seen.add(mark)
            title = page.first_text(selectors["job_title"], box)
            if not title:
                continue
            links = (page.first(s, box) for s in selectors["job_url"])
            href = next((n.attrs["href"] for n in links if n and n.attrs.get("href")), None)
            if href and not href.startswith("http"):
                href = urljoin(base_url or "", href)
            jobs.append(
                {
                    "title": title,
                    "location": page.first_text(selectors["job_location"], box),
                    "department": page.first_text(selectors["job_department"], box),
                    "type": page.first_text(selectors["job_type"], box),
                    "url": href,
                    "metadata": {k: v for k, v in box.attrs.items() if k.startswith("data-")},
                }
            )
    return jobs


_COUNT = re.compile(X.JOB_COUNT_PATTERN)


PARTS = ("jobs", "pagination", "search", "usage")


def read_page(html: str, base_url: str, selectors: dict[str, list[str]], parts: tuple[str, ...] = PARTS) -> dict:
    """What one page yields; parts not asked for stay empty."""
    page, out = Page(html or ""), {}
    if "jobs" in parts:
        out["jobs"] = _jobs(page, base_url, selectors)
    if "pagination" in parts:
        counts = (_COUNT.search(t) for _, t in page.texts)
        out["total_jobs"] = next((int(m.group(1).replace(",", "")) for m in counts if m), None)
        box = next((n for n in (page.first(s) for s in selectors["pagination"]) if n), None)
        mark = page.first(CURRENT_PAGE, box) if box else None
        out["current_page"] = (page.text(mark) if mark else "") or "1"
        out["page_links"] = (len(page.select(PAGE_LINKS, box)) or None) if box else None
    form = page.first(SEARCH_FORM) if "search" in parts else None
    if form:
        out["search_url"] = form.attrs.get("action") or None
        out["search_method"] = form.attrs.get("method") or "GET"
        names = (n.attrs.get("name") for n in page.select(FORM_FIELDS, form))
        out["search_fields"] = [n for n in names if n]
    if "usage" in parts:
        counted = ((c, s, len(page.select(s))) for c, options in selectors.items() for s in options)
        out["usage"] = [{"category": c, "selector": s, "n_matches": n} for c, s, n in counted if n]
    return out


def parse_pages(
    pages: DataFrame,
    selectors: dict[str, list[str]] = SELECTORS,
    keep: tuple[str, ...] = ("page_id",),
    parts: tuple[str, ...] = PARTS,
) -> DataFrame:
    """Pages (html, base_url) -> jobs, pagination, search form and selector usage, in one pass.

    ``parts`` names what is wanted: the optimizer cannot prune inside the parser.
    """
    options = {**SELECTORS, **selectors}
    page_type = to_arrow_type(T.StructType.fromDDL(PAGE_TYPE))

    @F.arrow_udf(PAGE_TYPE)
    def extract(html: pa.Array, base: pa.Array) -> pa.Array:
        pairs = zip(html.to_pylist(), base.to_pylist(), strict=True)
        return pa.array([read_page(h, b, options, parts) for h, b in pairs], page_type)

    # opaque to the optimizer: a page must not be parsed again for an inferred filter
    once = extract.asNondeterministic()
    return pages.select(*keep, "base_url", once("html", "base_url").alias("p")).select(
        *keep, "base_url", "p.*"
    )


def page_jobs(parsed: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One flat row per job card, ready for the relational mapping."""
    return parsed.select(*keep, F.posexplode("jobs").alias("card_no", "j")).select(*keep, "card_no", "j.*")


def page_pagination(parsed: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    total = F.when(F.col("total_jobs").isNotNull(), X.page_count("total_jobs"))
    return parsed.select(
        *keep,
        "total_jobs",
        "current_page",
        F.coalesce(total, F.col("page_links"), F.lit(1)).cast("bigint").alias("total_pages"),
    )


def selector_matches(parsed: DataFrame) -> DataFrame:
    return parsed.select("page_id", F.explode("usage").alias("u")).select("page_id", "u.*")


def provider_cards(html: str, provider: str) -> list[dict]:
    """Cards of one page by the selectors of its provider."""
    rules = PROVIDER_SELECTORS.get(provider)
    if not rules:
        return []
    page, found = Page(html or ""), []
    for box in page.select(rules["container"]):
        title = page.first(rules["title"], box)
        place = page.first(rules["location"], box)
        if title:
            found.append(
                {
                    "title": page.text(title),
                    "location": page.text(place) if place else "",
                    "href": title.attrs.get("href"),
                }
            )
    return found


def fallback_jobs(pages: DataFrame, run_at: Column | None = None, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Last resort: cards by the provider's own selectors -> POSTING fields.

    Pages need html, base_url, provider and company_name.
    """

    card_type = to_arrow_type(T.StructType.fromDDL(CARD_TYPE)["cards"].dataType)

    @F.arrow_udf(T.StructType.fromDDL(CARD_TYPE)["cards"].dataType)
    def cards(html: pa.Array, provider: pa.Array) -> pa.Array:
        found = [provider_cards(h, p) for h, p in zip(html.to_pylist(), provider.to_pylist(), strict=True)]
        return pa.array(found, card_type)

    base = [c for c in dict.fromkeys([*keep, "base_url", "provider", "company_name"])]
    rows = pages.filter(F.col("provider").isin(*PROVIDER_SELECTORS)).select(
        *base, cards.asNondeterministic()("html", "provider").alias("cards")
    )
    rows = rows.select(*base, F.posexplode("cards").alias("card_no", "c"))
    title, href = F.trim("c.title"), F.col("c.href")
    number = X.blank_to_null(F.regexp_extract(href, JOB_ID_IN_HREF, 1))
    url = F.when(href.startswith("http"), href).otherwise(F.col("base_url"))
    return rows.filter(F.char_length(title) >= MIN_TITLE_CHARS).select(
        *keep,
        "card_no",
        F.coalesce(number, X.short_id(title, "company_name")).alias("job_id"),
        title.alias("title"),
        "company_name",
        F.trim("c.location").alias("location"),
        F.lit("ats").alias("source"),
        url.alias("source_url"),
        url.alias("apply_url"),
        F.col("provider").alias("ats_provider"),
        F.lit("ATS").alias("job_origin"),
        (run_at if run_at is not None else F.lit(None).cast("timestamp")).alias("extracted_at"),
        F.lit("html_fallback").alias("extraction_method"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Links of each page by pattern only, JVM-side: (page_id, link_no, href)."""
    hrefs = F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return pages.select("page_id", "url", F.posexplode(hrefs).alias("link_no", "href"))


def page_headings(pages: DataFrame) -> DataFrame:
    heading = X.blank_to_null(F.trim(F.regexp_extract("html", r"<h1[^>]*>([^<]*)</h1>", 1)))
    title = X.blank_to_null(F.trim(F.regexp_extract("html", r"<title[^>]*>([^<]*)</title>", 1)))
    return pages.select("page_id", heading.alias("heading"), title.alias("title"))


def page_urls(pagination: DataFrame, max_pages: int) -> DataFrame:
    """URLs of result pages 2..min(max_pages, total_pages) for rows with base_url, total_pages."""
    last = F.least(F.lit(max_pages).cast("bigint"), F.col("total_pages"))
    numbers = F.when(last >= 2, F.sequence(F.lit(2).cast("bigint"), last))
    rows = pagination.select("*", F.explode(numbers).alias("page_no"))
    return rows.withColumn("url", U.page_url("base_url", "page_no"))
