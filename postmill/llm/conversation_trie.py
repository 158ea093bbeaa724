"""Trie of conversations: one node for each distinct sequence of first turns.

Prefix digests. A turn is its role and text as two 64-bit hashes; the digest of the first d turns is
the XOR of the turns' hashes, each taken together with its place, twice 64 bits. Digests stand for
the sequences (with 10^10 prefixes two different ones meet at odds of about 10^-18); texts are
never shuffled.

Count-min screening. All digests are counted in a sketch of two rows of cells. A cell never shows
less than the digests it holds, so an estimate of one proves that a single conversation has this
prefix. Only whether an estimate is one matters: cells count to two and become one bit each when
the sketch is sent to the tasks. A sketch has eight cells per prefix, MOST_CELLS a row at most
(both rows together MOST_CELLS / 4 bytes); beyond that it proves less and more rows are
shuffled, with the same result.

Local tails. A proven prefix is a node of its own with one leaf and nothing to save; it is emitted
where it lies. Only its first node asks for its parent's smallest member. All other prefixes are
grouped exactly, counts reduced before the shuffle.

Subtrees without walking levels. Every node stands at one place: its smallest member and its depth.
A subtree's sum is the sum over the members of what stands at or below its depth in each of them:
running sums from the end of every conversation, then one grouping by node.

Hot keys. Long conversations are ordered and summed in blocks of BLOCK turns (turn numbers), whose
totals are carried on. Groups of many copies are reduced by partial aggregates; the ids that end in
a node are joined in buckets of BUCKET ids and their digest is worked out bucket by bucket.

Turns are ordered by turn (null first), then role, then the text's MD5; repeated rows are turns of
their own. Null roles and texts are empty. Rows without conv_id belong to no conversation and
are left out. An empty table gives no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.llm.common import pa_schema
from postmill.operators.joins import lookup
from postmill.session import stage

BLOCK_BITS = 10
BUCKET_BITS = 12
CELLS_PER_PREFIX = 8
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 28
CHUNK = 1 << 16  # cells whose counts travel together
FLUSH = 1 << 20  # digests that a task counts before it hands counts on
NO_TURN = -(1 << 63)


SUM = (F.sum, lambda x, y: x + y)
XOR = (F.bit_xor, lambda x, y: x.bitwiseXOR(y))


def carried(rows: DataFrame, order: list[Column], values: dict[str, Column], kind=SUM, up: bool = True, peers: bool = True) -> DataFrame:
    """Running sums (or XORs) of ``values`` in the order of each conversation.

    ``rows`` have a column ``block`` that grows with the order (falls where ``up`` is false). Blocks are
    summed apart; what the blocks before come to is joined on. With ``peers``, rows of the same
    order count together.
    """
    total, both = kind
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    within = within.rangeBetween(Window.unboundedPreceding, 0) if peers else within.rowsBetween(Window.unboundedPreceding, 0)
    blocks = Window.partitionBy("conv_id").orderBy("block" if up else F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "block").agg(*[total(v).alias(n) for n, v in values.items()])
    before = totals.select("conv_id", "block", F.count("*").over(blocks).alias("earlier"), *[total(n).over(blocks).alias(f"before_{n}") for n in values])
    before = before.filter("earlier > 0").drop("earlier")
    out = rows.withColumns({n: total(v).over(within) for n, v in values.items()}).join(before, ["conv_id", "block"], "left")
    out = out.withColumns({n: both(F.col(n), F.coalesce(f"before_{n}", F.lit(0))) for n in values})
    return out.drop("block", *[f"before_{n}" for n in values])


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), t1, t2 (hashes of role and text) and n_bytes of the text, per turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)).alias("turn"),
        role.alias("role"),
        F.md5(text.cast("binary")).alias("md5"),
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    rows = rows.withColumn("block", F.shiftright("turn", BLOCK_BITS))
    placed = carried(rows, [F.col(c) for c in ("turn", "role", "md5")], {"place": F.lit(1).cast("long")}, peers=False)
    return placed.select("conv_id", (F.col("place") - 1).alias("place"), "t1", "t2", "n_bytes")


def regrouped(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: every one gets the first turns of its group's first.

    With h = crc32 of the decimal conv_id mod ``most``: the first h turns of the conversation
    ``conv_id - conv_id % group`` (all if fewer, none if absent), then its own turns after the first h.
    Gives turns (conv_id, depth from 1, t1, t2, n_bytes) and conversations (conv_id, total).
    """
    turns = stage(turns, "turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    first = (F.col("conv_id") - F.col("conv_id") % group).alias("first")
    heads = turns.filter((F.col("conv_id") % group == 0) & (F.col("place") < most - 1)).withColumnRenamed("conv_id", "first")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", h, first)
    given = heads.groupBy("first").agg(F.count("*").alias("given"))
    shared = F.least("h", F.coalesce("given", F.lit(0)))
    ids = lookup(sizes, given, ["first"]).select(
        "conv_id", "first", "h", shared.alias("shared"), (shared + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")
    )
    ids = stage(ids, "ids")
    begun = ids.select("conv_id", "first", "h").join(heads, "first").filter("place < h")
    own = lookup(turns, ids.select("conv_id", "h", "shared"), ["conv_id"], "inner").filter("place >= h")
    columns = ["t1", "t2", "n_bytes"]
    begun = begun.select("conv_id", (F.col("place") + 1).alias("depth"), *columns)
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("shared") + 1).alias("depth"), *columns)
    return begun.unionByName(own), ids.select("conv_id", "total")


def prefixes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row per conversation and depth, 0 included: digest (a, b), the parent's (pa, pb), bytes of the
    last turn, and whether the conversation ends there."""
    term = [F.xxhash64(F.lit(j), "depth", "t1", "t2") for j in (3, 4)]
    rows = turns.select("conv_id", "depth", "n_bytes", term[0].alias("x"), term[1].alias("y"))
    rows = rows.withColumn("block", F.shiftright("depth", BLOCK_BITS))
    rows = carried(rows, [F.col("depth")], {"a": F.col("x"), "b": F.col("y")}, XOR)
    rows = lookup(rows, ids, ["conv_id"], "inner").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "a",
        "b",
        F.col("a").bitwiseXOR(F.col("x")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("y")).alias("pb"),
        "n_bytes",
        (F.col("depth") == F.col("total")).alias("ends"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = ids.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("n_bytes"), (F.col("total") == 0).alias("ends"))
    return roots.unionByName(rows)


COUNTS = "part int, chunk long, once binary, more binary"
BITS = "part int, chunk long, bits binary"


def sketch(rows: DataFrame, cells: int) -> np.ndarray:
    """A bit per cell of both sketch rows: whether it counts more than one prefix."""
    spark = rows.sparkSession
    counts, bits = pa_schema(spark, COUNTS), pa_schema(spark, BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy().view(np.uint64) & np.uint64(cells - 1) for c in ("a", "b")))
            if sum(len(x[0]) for x in held) >= FLUSH:
                yield handed(held)
                held = []
        if held:
            yield handed(held)

    def handed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        out = []
        for part in (0, 1):
            cell, times = np.unique(np.concatenate([x[part] for x in held]), return_counts=True)
            chunk = cell // np.uint64(CHUNK)
            cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])) if len(cell) else []
            for at, end in zip(cuts, [*cuts[1:], len(cell)], strict=True):
                place, several = (cell[at:end] % np.uint64(CHUNK)).astype("<u2"), times[at:end] > 1
                out.append((part, int(chunk[at]), place[~several].tobytes(), place[several].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t.type) for i, t in enumerate(counts)], schema=counts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, np.zeros(CHUNK, np.uint8)

        def full() -> pa.RecordBatch:
            packed = np.packbits(held > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip((*at, packed), bits, strict=True)], schema=bits)

        for batch in batches:
            for part, chunk, once, more in zip(*[batch.column(c).to_pylist() for c in counts.names], strict=True):
                if (part, chunk) != at:
                    if at is not None:
                        yield full()
                    at, held = (part, chunk), np.zeros(CHUNK, np.uint8)
                one = np.frombuffer(once, "<u2")  # each cell once
                held[one] = np.minimum(held[one] + 1, 2)
                held[np.frombuffer(more, "<u2")] = 2
        if at is not None:
            yield full()

    pieces = rows.filter("depth > 0").select("a", "b").mapInArrow(count, COUNTS)
    pieces = pieces.repartition("part", "chunk").sortWithinPartitions("part", "chunk").mapInArrow(merge, BITS).toArrow()
    out = np.zeros((2, cells // 8), np.uint8)
    for part, chunk, packed in zip(*[pieces.column(c).to_pylist() for c in bits.names], strict=True):
        own = np.frombuffer(packed, np.uint8)[: cells // 8]
        out[part, chunk * (CHUNK // 8) : chunk * (CHUNK // 8) + len(own)] = own
    return out


ROWS = "conv_id long, depth long, a long, b long, pa long, pb long, n_bytes long, ends boolean"
SCREENED = f"{ROWS}, alone boolean, parent_alone boolean"


def screened(rows: DataFrame) -> DataFrame:
    """The staged prefixes, and whether the sketch proves that one conversation alone has them and their parents."""
    spark = rows.sparkSession
    wanted = CELLS_PER_PREFIX * rows.count()
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << wanted.bit_length()))
    sent = spark.sparkContext.broadcast(sketch(rows, cells))
    types = pa_schema(spark, SCREENED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value

        def alone(batch: pa.RecordBatch, names: tuple[str, str], depth: np.ndarray) -> np.ndarray:
            once = np.zeros(batch.num_rows, bool)
            for part, name in enumerate(names):
                cell = batch.column(name).fill_null(0).to_numpy().view(np.uint64) & np.uint64(cells - 1)
                once |= (bits[part, cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 0
            return once & (depth > 0)

        for batch in batches:
            depth = batch.column("depth").to_numpy()
            flags = [alone(batch, ("a", "b"), depth), alone(batch, ("pa", "pb"), depth - 1)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in types.names[:-2]], *map(pa.array, flags)], schema=types)

    return rows.mapInArrow(run, SCREENED)


NODE = ["depth", "a", "b"]


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, a, b and the SHA-256 of the ascending, comma-joined ids of the conversations that end there."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    buckets = ends.groupBy(*NODE, F.shiftright("conv_id", BUCKET_BITS).alias("bucket")).agg(ids.alias("ids"))
    schema = "depth long, a long, b long, ends_sha256 string"
    types = pa_schema(ends.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")], strict=True):
                if node == at:
                    digest.update(b",")
                else:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = node, sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t.type) for i, t in enumerate(types)], schema=types)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip((*at, digest.hexdigest()), types, strict=True)], schema=types)

    return buckets.repartition(*NODE).sortWithinPartitions(*NODE, "bucket").mapInArrow(run, schema)


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row per node of the conversations ``ids`` (conv_id, total) with ``turns`` (conv_id, depth, t1, t2, n_bytes).

    conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves
    (childless nodes of the subtree), saved_tokens (bytes of last turns that all members but one share, over
    the subtree), ends_sha256 (of the ids of the conversations that end there).
    """
    rows = stage(screened(stage(prefixes(turns, ids), "prefixes")), "screened")
    alone, shared = rows.filter("alone"), rows.filter("not alone")
    nodes = shared.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *[F.max(c).alias(c) for c in ("pa", "pb", "n_bytes")])
    begun = alone.filter("not parent_alone")  # the first nodes of tails
    children = nodes.select("depth", "pa", "pb").union(begun.select("depth", "pa", "pb")).filter("depth > 0")
    children = children.select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = children.groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stage(nodes, "nodes")

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    members = shared.select("conv_id", *NODE, zero.alias("leaf"), zero.alias("saved"))
    none = F.lit(None).cast("long")
    own = nodes.select("conv_id", "depth", none.alias("a"), none.alias("b"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    tails = alone.filter("ends").select("conv_id", "depth", none.alias("a"), none.alias("b"), one.alias("leaf"), zero.alias("saved"))
    placed = members.union(own).union(tails).withColumn("block", F.shiftright("depth", BLOCK_BITS))
    below = carried(placed, [F.desc("depth")], {"n_leaves": F.col("leaf"), "saved_tokens": F.col("saved")}, up=False)
    below = below.filter("a is not null").groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    digests = end_digests(shared.filter("ends").select("conv_id", *NODE))
    grouped = nodes.join(below, NODE).join(digests, NODE, "left")
    grouped = grouped.withColumn("ends_sha256", F.coalesce("ends_sha256", _digest(F.lit(""))))
    single = [
        one.alias("n_convs"),
        F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        _digest(F.when(F.col("ends"), F.col("conv_id").cast("string")).otherwise("")).alias("ends_sha256"),
    ]
    columns = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    asking = grouped.select("conv_id", "depth", "pa", "pb", *columns).union(begun.select("conv_id", "depth", "pa", "pb", *single))
    named = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    found = lookup(asking, named, ["depth", "pa", "pb"])
    # the parent of a node that only the exact grouping shows to be single may have been emitted as a tail
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    found = found.select("conv_id", "depth", parent.alias("parent_conv_id"), *columns)
    return found.union(alone.filter("parent_alone").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *single))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    turns = stage(turns_of(conversations), "turns").withColumn("depth", F.col("place") + 1).drop("place")
    return prefix_trie(turns, turns.groupBy("conv_id").agg(F.count("*").alias("total")))


def regrouped_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that begin like the first of their group (see ``regrouped``)."""
    return prefix_trie(*regrouped(turns_of(conversations)))
