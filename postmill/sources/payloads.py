"""Scans of landed provider payloads.

One pass over the payload table serves every provider: the body is parsed to
VARIANT once, the posting array is picked by the row's provider and exploded.
All narrow, no shuffle. A filter on ``provider`` prunes partitions when the
landing table is partitioned by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import variants as V
from postmill.functions.text import col
from postmill.sources.providers import PROVIDERS, Provider


def posting_array(
    provider: Column | str, parsed: Column, providers: dict[str, Provider] = PROVIDERS
) -> Column:
    """The array of postings inside a parsed payload; null when the shape is wrong."""
    expr = F
    for spec in providers.values():
        tries = [V.array(parsed, path) for path in spec.list_paths]
        expr = expr.when(col(provider) == spec.name, F.coalesce(*tries))
    return expr.otherwise(F.lit(None).cast("array<variant>"))


def parse_body(df: DataFrame) -> DataFrame:
    """``body`` as VARIANT in ``parsed``, null where it is not JSON.

    It goes through a generator of one row: the optimizer copies expressions over a projection
    and under a filter, but not through a generator, so each body is parsed once.
    """
    rest = [c for c in df.columns if c != "body"]
    return df.select(*rest, F.explode(F.array(V.parse("body"))).alias("parsed"))


def scan_payloads(df: DataFrame, providers: dict[str, Provider] = PROVIDERS) -> DataFrame:
    """Payload rows -> one row per posting (``item`` VARIANT, ``item_pos``), list order kept."""
    rest = [c for c in df.columns if c != "body"]
    items = posting_array("provider", F.col("parsed"), providers)
    out = parse_body(df).select(*rest, F.posexplode(items).alias("item_pos", "item"))
    return out.filter(V.is_object(F.col("item")))


def payload_totals(df: DataFrame, providers: dict[str, Provider] = PROVIDERS) -> DataFrame:
    """Per payload: readable or not, postings on the page, total announced by the provider."""
    rest = [c for c in df.columns if c != "body"]
    parsed = parse_body(df)
    n = F.coalesce(F.size(posting_array("provider", F.col("parsed"), providers)), F.lit(0))
    return parsed.select(
        *rest,
        F.col("parsed").isNotNull().alias("readable"),
        n.cast("bigint").alias("n_items"),
        F.coalesce(V.text(F.col("parsed"), "$.totalFound").try_cast("bigint"), n.cast("bigint")).alias(
            "total_found"
        ),
    )


def scan_details(df: DataFrame) -> DataFrame:
    """Detail bodies -> ``detail`` VARIANT and whether the body was a list.

    A list-typed detail stands for its first element.
    """
    rest = [c for c in df.columns if c != "body"]
    parsed = parse_body(df)
    as_list = V.array(F.col("parsed"))
    first = F.get(as_list, F.lit(0))
    return parsed.select(
        *rest,
        F.when(as_list.isNotNull(), first).otherwise(F.col("parsed")).alias("detail"),
        as_list.isNotNull().alias("detail_is_list"),
    ).filter(V.is_object(F.col("detail")))


def read_json_folder(spark, path: str, **columns: str) -> DataFrame:
    """Landed JSON files, one payload per file, as ``body`` plus constant columns."""
    df = spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()}) if columns else df
