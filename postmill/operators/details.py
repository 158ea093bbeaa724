"""List rows enriched by detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions import variants as V
from postmill.functions.text import is_filled
from postmill.operators.joins import lookup
from postmill.operators.reconcile import first_by


def _keyed(details: DataFrame, keys: list[str]) -> DataFrame:
    """One detail row per key, so the list side is never multiplied."""
    order = "seq" if "seq" in details.columns else F.xxhash64(F.to_json("detail"))
    return first_by(details, keys, [order])


def overlay_details(items: DataFrame, details: DataFrame) -> DataFrame:
    """Comeet rule: detail fields under list fields, by key *presence*.

    A key the list carries wins even when its value is null. A list-typed detail replaces
    the row outright; an object counts only when it carries the same uid.
    """
    left = items.withColumn("uid", V.text(F.col("item"), "$.uid"))
    right = _keyed(
        details.select("company_slug", "uid", "detail", "detail_is_list"), ["company_slug", "uid"]
    )
    rows = lookup(left, right, ["company_slug", "uid"])
    own, extra = V.fields(F.col("item")), V.fields(F.col("detail"))
    only_extra = F.map_filter(extra, lambda k, _: ~F.map_contains_key(own, k))
    merged = F.to_variant_object(F.map_concat(only_extra, own))
    same = V.text(F.col("detail"), "$.uid") == F.col("uid")
    item = F.when(F.col("detail_is_list"), F.col("detail")).when(same, merged).otherwise(F.col("item"))
    return rows.withColumn("item", item).drop("detail", "detail_is_list")


def prefer_details(items: DataFrame, details: DataFrame) -> DataFrame:
    """Recruitee rule: the detail record wins whole, else the list record. Rows need a slug."""
    left = items.withColumn("slug", V.text(F.col("item"), "$.slug")).filter(is_filled("slug"))
    unwrapped = F.when(V.is_object(F.col("detail"), "$.offer"), V.node(F.col("detail"), "$.offer"))
    right = _keyed(
        details.select("company_slug", "slug", F.coalesce(unwrapped, "detail").alias("detail")),
        ["company_slug", "slug"],
    )
    rows = lookup(left, right, ["company_slug", "slug"])
    return rows.select(
        *[c for c in left.columns if c != "item"],
        F.coalesce("detail", "item").alias("item"),
        F.col("detail").isNotNull().alias("from_detail"),
    )
