"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the key -ln(u) / quality, u from a hash of its id: smaller keys come first, so
better documents are likelier to be taken. A source whose target is e whole times its size and a
rest gives every document e times, then documents in the order of their keys until their sizes
fill the rest (the one that crosses the end is taken when at least half of it fits).

The cut of each source is found by narrowing: sums over steps of the key give the step in which
the rest ends, sums over fine steps of that step's rows the fine step, and only its rows are
ordered. No task sees all keys of a source, however large it is.

Null text has size 0. Null sources are one source, the last. Rows with the same key, id and size
are taken or left together. Null ids share one key and are ordered by size. Reruns agree. An empty
table gives no rows. Columns of ``docs`` other than doc_id, text and source do not matter;
``mixed_documents`` hands them all through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.operators.joins import lookup
from postmill.session import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all sizes
MOST = 2  # times a source's size
SEED = "mix"
FIRST_ID = -(1 << 63)
STEPS = 64  # steps of a key per factor e: one holds at most 0.6 % of a source
FINE_STEPS = 64 * 4096
FEW_SOURCES = 50_000  # up to so many rows, the plan (one row per source) is broadcast


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_of(text: Column) -> Column:
    """1 for prose, less with the share of markup symbols, 0.05 at least."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * symbols / F.greatest(F.length(text), F.lit(1)))


def key_of(doc_id: Column, quality: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((number + F.lit(0.5)) / F.lit(float(1 << 52))) / quality


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, name (never null, for joins), size, key of every document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        *measures(seed),
    )


def measures(seed: str) -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [
        F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("name"),
        size_of(text).alias("size"),
        key_of(F.col("doc_id").cast("long"), quality_of(text), seed).alias("key"),
    ]


def at_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with what a staged plan says about their source."""
    if plan.count() <= FEW_SOURCES:
        return rows.join(F.broadcast(plan), "name")
    return lookup(rows, plan, ["name"], "inner")


def place() -> Column:
    return F.struct("key", F.coalesce("doc_id", F.lit(FIRST_ID)).alias("id"), "size")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """name, source_size, target: shares by weight, none above MOST times its size.

    Sources are filled in the order of the level at which they are full; the level of the first
    that is not full holds for all after it. The table has one row per source.
    """
    of = F.expr(f"array({', '.join(map(str, weights))})")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("name", "source").agg(F.sum("size").alias("source_size"))
    sources = sources.select(
        "name",
        "source",
        "source_size",
        F.get(of, (F.row_number().over(by_name) - 1) % len(weights)).cast("long").alias("weight"),
    )
    full_at = F.col("source_size") * F.lit(float(MOST)) / F.col("weight")
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = sources.withColumn("full_at", full_at).withColumns(
        {
            "level": (
                F.sum("source_size").over(everything) * F.lit(SHARE)
                - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(MOST))
            )
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        }
    )
    level = F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(everything)
    cap = F.col("source_size") * F.lit(float(MOST))
    return filled.select("name", "source_size", F.coalesce(F.least(cap, level * F.col("weight")), cap).alias("target"))


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """name, source_size, target, epochs, cut: rows up to ``cut`` are taken once more; one row per source.

    ``sizes`` is read several times: hand in a staged table.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets(sizes, weights).withColumn("epochs", whole.cast("long"))
    plan = stage(plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-plan")
    left = plan.filter("rest > 0").select("name", "rest")
    rows = sizes
    for number, steps in enumerate((STEPS, FINE_STEPS)):
        rows = rows.withColumn("step", F.floor(F.log("key") * steps))
        sums = at_source(rows, left).groupBy("name", "rest", "step").agg(F.sum("size").alias("n"))
        earlier = Window.partitionBy("name").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        ends = sums.select("name", "step", (F.col("rest") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("rest"))
        # the last step that begins before the rest is used up
        last = ends.filter("rest > 0").groupBy("name").agg(F.max_by(F.struct("step", "rest"), "step").alias("end"))
        left = stage(last.select("name", F.col("end.step").alias("end"), F.col("end.rest").alias("rest")), f"mix-{number}")
        rows = at_source(rows, left).filter("step = end").select("name", "doc_id", "size", "key")
        left = left.select("name", "rest")
    order = Window.partitionBy("name").orderBy("key", F.col("doc_id").asc_nulls_first(), "size")
    rows = at_source(rows, left).withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    taken = F.col("sum") - F.col("size") / F.lit(2.0) <= F.col("rest")
    # where no row of the last step is taken, all rows before it are
    before = F.min(F.struct("key", F.lit(FIRST_ID).alias("id"), F.lit(-1).cast("long").alias("size")))
    cut = rows.groupBy("name").agg(F.coalesce(F.max(F.when(taken, place())), before).alias("cut"))
    return stage(plan.drop("rest").join(cut, "name", "left"), "mix-cuts")


def copies() -> Column:
    """How often the mix has a row that carries its source's plan."""
    return F.col("epochs") + F.coalesce((place() <= F.col("cut")).cast("long"), F.lit(0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix has of the document), copies."""
    sizes = stage(sized(docs, seed), "mix-sizes")
    rows = at_source(sizes, mix_plan(sizes, weights)).withColumn("copies", copies())
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken; their texts are not shuffled."""
    plan = mix_plan(stage(sized(docs, seed), "mix-sizes"), weights)
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *measures(seed))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    rows = at_source(carried, plan).withColumn("copies", copies()).filter("copies > 0").select("row", times)
    return rows.select("row.*")
