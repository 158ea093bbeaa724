"""Analytics over network capture logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import urls as U
from postmill.functions import variants as V
from postmill.functions.text import blank_to_null
from postmill.operators import mappings as M
from postmill.operators.joins import lookup
from postmill.operators.reconcile import first_by
from postmill.sources.captures import JSON_TYPE, scan_included

# ---- fixed values ----
MAX_HOPS = 10


def first_blocks(log: DataFrame) -> DataFrame:
    """First blocked response of each blocked crawl (only blocked rows are shuffled)."""
    blocked = log.select("crawl_id", "seq", U.block_reason("status", "url").alias("block_reason"))
    blocked = blocked.filter(F.col("block_reason").isNotNull())
    return blocked.groupBy("crawl_id").agg(F.min("seq").alias("first_block_seq"))


def before_block(log: DataFrame) -> DataFrame:
    """Everything before the first block of each crawl; partial results are kept.

    An aggregate and a join instead of a running window: a crawl that holds a third of
    the log is never sorted in one task.
    """
    latch = first_blocks(log)
    kept = lookup(log, latch, ["crawl_id"])
    open_ = F.col("first_block_seq").isNull() | (F.col("seq") < F.col("first_block_seq"))
    return kept.filter(open_).drop("first_block_seq")


def crawl_state(log: DataFrame) -> DataFrame:
    """Per crawl: requests, last request, usable responses, first block, errors.

    The reason is carried as a small number, so the aggregation works on fixed-width buffers
    and stays hash-based.
    """
    reason = U.block_reason("status", "url")
    reasons = F.array(*[F.lit(r) for r in U.BLOCK_REASONS])
    first = F.min_by(F.array_position(reasons, reason), F.when(reason.isNotNull(), F.col("seq")))
    usable = (
        reason.isNull()
        & U.is_job_api("url")
        & (F.col("status") == 200)
        & F.col("content_type").contains(JSON_TYPE)
    )
    return log.groupBy("crawl_id").agg(
        F.count("*").alias("requests_made"),
        F.max("ts").alias("last_request_time"),
        F.count_if(usable).alias("api_responses_captured"),
        F.count_if(reason.isNotNull()).alias("n_blocks"),
        (F.count_if(reason.isNotNull()) > 0).alias("is_blocked"),
        F.get(reasons, first.cast("int") - 1).alias("block_reason"),
        F.count_if(F.col("status") >= 400).alias("n_errors"),
    )


def jobs_collected(postings: DataFrame) -> DataFrame:
    """Distinct jobs per crawl, as an addition to ``crawl_state``."""
    return postings.groupBy("crawl_id").agg(F.count_distinct("job_id").alias("jobs_collected"))


def apply_url_map(captures: DataFrame) -> DataFrame:
    """Job id -> apply URL from the ``included`` objects; the last one seen wins."""
    item = F.col("item")
    rows = scan_included(captures).select(
        "seq",
        "item_pos",
        blank_to_null(F.substring_index(V.text(item, "$.entityUrn"), ":", -1)).alias("job_id"),
        M.discovered_apply_url(item).alias("apply_url"),
    )
    known = rows.filter(F.col("job_id").isNotNull() & F.col("apply_url").isNotNull())
    last = first_by(known, ["job_id"], [F.desc("seq"), F.desc("item_pos")])
    return last.select("job_id", "apply_url")


def redirect_chains(log: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """Ordered distinct URLs per crawl and start URL, start first, at most ``max_hops`` hops.

    A navigation belongs to one crawl, so the hop limit holds there. It is applied before the
    hops are collected, so each list is bounded.
    """
    start = ["crawl_id", "redirected_from"]
    hops = log.filter(F.col("redirected_from").isNotNull()).select(*start, "seq", "url")
    first = first_by(hops, start, ["seq"], max_hops)
    chain = F.sort_array(F.collect_list(F.struct("seq", "url"))).getField("url")
    return first.groupBy("crawl_id", F.col("redirected_from").alias("start_url")).agg(
        F.array_distinct(F.concat(F.array(F.first("redirected_from")), chain)).alias("chain")
    )
