"""Time the headline queries and print one JSON line.

Each query runs to completion into a no-op sink (every row and column is computed,
nothing is collected). It runs twice and the second time counts: the first one pays for
class loading and code generation. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from postmill.plans.catalog import QUERIES, Inputs  # noqa: E402
from postmill.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_provider_distribution",
    "ingest_feeds",
    "norm_discovery",
    "norm_comeet",
    "detail_overlay",
    "ats_jobs_row",
    "reject_counts",
    "dedup_first_wins",
    "duplicate_pairs",
    "duplication_report",
    "crawl_state",
    "partial_before_block",
    "redirect_chain",
    "constraint_violations",
    "quality_by_company",
    "keyword_search",
    "page_cards",
    "knn_exact",
    "knn_ivf",
    "knn_join",
    "near_duplicate_descriptions",
    "url_labels",
    "provider_origin_rollup",
    "html_fallback",
    "upsert_latest",
    "upsert_table",
    "json_sink",
    "csv_sink",
    "summary_sink",
    "stream_ingest",
    "stream_dedup",
    "stream_block_latch",
    "stream_upsert",
]
# the table a query reads most of, for rows per second
READS = {"knn_exact": "embeddings", "knn_ivf": "embeddings", "knn_join": "embeddings", "url_labels": "events", "crawl_state": "events", "partial_before_block": "events"}
READS |= {"redirect_chain": "events", "stream_block_latch": "events"}


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(Inputs(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    cold, times = {}, {}
    for name in HEADLINE:
        cold[name] = round(run(spark, sf_dir, name), 3)
        times[name] = round(run(spark, sf_dir, name), 3)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("documents", "embeddings", "events")}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": cold,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cores": cpus,
                "input_rows_per_sec": {n: round(rows[READS.get(n, "documents")] / t) for n, t in times.items() if t},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
