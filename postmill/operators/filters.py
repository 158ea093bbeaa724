"""Work queues, lookups and keyword search over the published table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.text import col

# ---- fixed values ----
LOW_CONFIDENCE = 0.6


def _active() -> Column:
    return F.col("job_status") == "active"


def queue(df: DataFrame, name: str, **want) -> DataFrame:
    """A named work queue. Predicates are plain column comparisons, so they reach the scan.

    sync(processing_status, sync_status) · processing(processing_status) ·
    embeddings(processing_status) · reprocess(processing_status, below) ·
    scraped() · low_confidence() · company(company_slug, ats_source)
    """
    rules = {
        "sync": lambda: (F.col("processing_status") == want.get("processing_status", "processed"))
        & (F.col("sync_status") == want.get("sync_status", "pending")),
        "processing": lambda: F.col("processing_status") == want.get("processing_status", "pending"),
        "embeddings": lambda: (F.col("processing_status") == want.get("processing_status", "processed"))
        & ~F.col("embeddings_generated"),
        "reprocess": lambda: (F.col("processing_status") == want.get("processing_status", "processed"))
        & (F.col("ai_extraction_confidence") < want.get("below", LOW_CONFIDENCE)),
        "scraped": lambda: F.col("processing_status") == "scraped",
        "low_confidence": lambda: (F.col("processing_status") == "processed")
        & (F.col("ai_extraction_confidence") < LOW_CONFIDENCE),
        "company": lambda: (F.col("company_slug") == want["company_slug"])
        & (F.col("ats_source") == want["ats_source"]),
    }
    return df.filter(_active() & rules[name]())


def next_batch(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first ``n`` queue rows by id (a top-n per task, then one small merge)."""
    return df.orderBy(order).limit(n)


def lookup(df: DataFrame, **values) -> DataFrame:
    """Equality, membership (list) or range (tuple lo, hi; None = open) per column."""
    tests = []
    for name, v in values.items():
        c = F.col(name)
        if isinstance(v, tuple):
            lo, hi = v
            tests += [c >= lo] if lo is not None else []
            tests += [c <= hi] if hi is not None else []
        elif isinstance(v, (list, set)):
            tests.append(c.isin(*v))
        else:
            tests.append(c.isNull() if v is None else c == v)
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def contains_all(array: Column | str, wanted: list[str]) -> Column:
    want = F.array(*[F.lit(w) for w in wanted])
    return F.coalesce(F.size(F.array_except(want, col(array))) == 0, F.lit(False))


def contains_any(array: Column | str, wanted: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(col(array), F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def keyword_match(keywords: str, location: str = "") -> Column:
    """Every keyword occurs in title or description, and the place in the location."""
    text = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))))
    tests = [text.contains(w) for w in keywords.lower().split()]
    if location:
        tests.append(F.coalesce(F.lower("location").contains(location.lower()), F.lit(False)))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def search(
    df: DataFrame, keywords: str = "", location: str = "", max_jobs: int | None = 25, order: str = "seq"
) -> DataFrame:
    """Keyword and location search with a global cap in ``order``."""
    hits = df.filter(keyword_match(keywords, location))
    return hits if max_jobs is None else hits.orderBy(order).limit(max_jobs)
