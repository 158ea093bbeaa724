"""Documents whose sets of five-word shingles have a Jaccard similarity of 0.75 or more.

Parity sketches. At a level (a band of set sizes) the shingles are dealt into pieces by a hash and
each piece holds the XOR of its shingles' patterns. A shingle that only one of two sets has changes
one piece, so two sets differ in at most as many pieces as their symmetric difference has shingles;
for similar sets that is at most a seventh of the sum of their sizes. A set with more pieces in use
than that shares one of them, unchanged, with every set similar to it (pigeonhole). So documents
are joined on (level, piece, value), and the pairs are checked against a parity sketch
and then the sets themselves.

Exactness. A level holds all pairs whose larger set lies in its band; a set is dealt at its own level and, if
a larger partner may lie there, at the next. If too few pieces are in use, the set is dealt again with another seed until they
suffice (at last with a piece for each shingle), and both of a pair use the seeds up to the one
that suffices for either.

Hot groups. Equal sets are one class and only its first member of a task is dealt. A set may leave
out as many pieces as it has in use beyond what it needs: each leaves out its most frequent ones,
so a line or passage shared by very many documents joins none of them (prefix filter: in one
order of all pieces, two sets that share t pieces share one of what is left when each leaves
out t - 1). Nearly all are left out before the shuffle, in an order fitted on a sample of about
ORDER_DOCS documents (any order is exact, a good one is fast); RESERVE more are left out after it,
by the true frequencies. Pieces that the same documents keep count once. Of a piece's documents each is paired with the first (a star, not all
pairs); the links found give components, and only documents of one piece that lie in different
components after that are paired with each other. No link between components is lost.

Null text and text without words have an empty set, link with nothing and are their own component.
Rows that share a ``doc_id`` count as one document with several texts. A null ``doc_id`` gets its
set size, a null component, and links with nothing. Repeated rows are returned as often as they
come. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.llm.bpe import Cache
from postmill.llm.common import pa_schema, slices, texts_of
from postmill.llm.components import components
from postmill.operators.joins import free_name, lookup
from postmill.session import stage, unstage

WORDS = 5
RESERVE = 24  # pieces that are left out by their true frequency, at most
ORDER_DOCS = 8192  # documents of the sample that orders pieces
OFTEN = 4  # times that a piece is in the sample to count as frequent
SEEDS = 24  # dealings before each shingle gets a piece of its own
FEW_IDS = 1_000_000  # rows of a few ids that may be broadcast
SLOT = 512  # documents that are compared with one partner in one group
BEFORE = 32  # pieces before one that may show that a pair was made already

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_M = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M[0]
    x = (x ^ (x >> np.uint64(27))) * _M[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = text.encode().lower().split()  # of bytes: ASCII letters and ASCII spaces only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    if n < WORDS:
        return mix((h * _K[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = h[: n - 4] * _K[0]
    for i in range(1, WORDS):
        total += h[i : n - 4 + i] * _K[i]
    return np.unique(mix(total))


# Band ends: six steps of 4/3 apart.
ENDS = [6]
while ENDS[-1] < 1 << 40:
    ENDS.append(int(ENDS[-1] * (4 / 3) ** 6))
_ends = np.array(ENDS)


def level_of(size: int) -> int:
    return int(np.searchsorted(_ends, size))


def most_apart(size: int, level: int) -> int:
    """Shingles in which a set may differ from any similar set at a level."""
    return (size + min(ENDS[level], 4 * size // 3)) // 7


def deal(hashes: np.ndarray, level: int, seed: int) -> np.ndarray:
    """One key per piece in use: the hash of level, seed, piece and the XOR of its shingles."""
    salt = mix(np.array([level << 8 | seed], np.uint64))
    if seed == SEEDS:
        return mix(hashes ^ salt)
    pieces = ENDS[level] * 6 // 10 + 6
    spread = mix(hashes + salt)
    piece = (spread >> np.uint64(32)) * np.uint64(pieces) >> np.uint64(32)
    order = np.argsort(piece, kind="stable")
    piece = piece[order]
    starts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
    value = np.bitwise_xor.reduceat(mix(spread)[order], starts)
    return mix((value + (piece[starts] + np.uint64(1)) * _K[1]) ^ salt)


@dataclass
class Order:
    """Frequent pieces of a sample: sorted keys and how often each was there."""

    keys: np.ndarray
    times: np.ndarray

    def rarest(self, keys: np.ndarray, n: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        times = np.where(self.keys[at] == keys, self.times[at], 0) if len(self.keys) else np.zeros(len(keys))
        return keys[np.lexsort((keys, times))[:n]]


def keys_of(hashes: np.ndarray, order: Order | None = None) -> tuple[np.ndarray, int]:
    """Keys of a set, and how many of them it can still do without. Without an order: all keys."""
    size = len(hashes)
    if size < 3:  # similar only to equal sets
        return np.empty(0, np.uint64), 0
    found, reserve = [], RESERVE
    for level in sorted({level_of(size), level_of(4 * size // 3)}):
        need = most_apart(size, level) + 1
        for seed in range(SEEDS + 1):
            keys = deal(hashes, level, seed)
            if len(keys) >= need:
                spare = min(RESERVE, len(keys) - need) if seed == 0 else 0
                reserve = min(reserve, spare)
                found.append(order.rarest(keys, need + spare) if order and seed == 0 else keys)
                break
            found.append(keys)
    return np.concatenate(found), reserve


LEAST_BITS = 512  # of a parity sketch; two per shingle where that is more
ROWS = "key long, more long, doc_id long, spare int, size int, sketch binary"


def sketch_of(hashes: np.ndarray) -> bytes:
    """A bit per residue of the hashes: the parity of the shingles that have it."""
    width = max(LEAST_BITS, 1 << (2 * max(1, len(hashes)) - 1).bit_length())
    bits = np.bincount((hashes & np.uint64(width - 1)).astype(np.intp), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, at most the symmetric difference of the sets. The wider
    one is folded: the XOR of its halves is the sketch of half the width."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def fitted_order(docs: DataFrame) -> Order:
    """The pieces that are often in about ORDER_DOCS documents, chosen by a hash of their ids."""
    spark = docs.sparkSession
    types = pa_schema(spark, "key long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch):
                found = np.concatenate([keys_of(shingles(t))[0] for t in texts]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], schema=types)

    share = ORDER_DOCS / max(1, docs.count())
    some = texts_of(docs).filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    often = some.mapInArrow(run, "key long").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= OFTEN).toArrow()
    keys = often.column("key").to_numpy().astype(np.int64).view(np.uint64)
    place = np.argsort(keys)
    return Order(keys[place], often.column("n").to_numpy().astype(np.int64)[place])


def dealt(docs: DataFrame) -> DataFrame:
    """A row per text (key and ``more`` say which set it is) and per piece (size is null)."""
    order = docs.sparkSession.sparkContext.broadcast(fitted_order(docs))
    types = pa_schema(docs.sparkSession, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Cache.only("shingles")  # a reused worker holds what stages before have left
        pa.default_memory_pool().release_unused()
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part, texts in slices(batch):
                whole: list[tuple] = []
                keys, owners, spares = [np.empty(0, np.uint64)], [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    hashes = shingles(text)
                    size = len(hashes)
                    one = int(np.bitwise_xor.reduce(mix(hashes + _K[3]))) if size else xxhash.xxh64_intdigest(str(doc_id))
                    two = int(mix(hashes ^ _K[4]).sum(dtype=np.uint64)) if size else 0
                    whole.append((one, two, doc_id, size, sketch_of(hashes)))
                    if size and doc_id is not None and (one, two) not in seen:
                        seen.add((one, two))
                        own, spare = keys_of(hashes, order.value)
                        keys.append(own)
                        owners += [doc_id] * len(own)
                        spares += [spare] * len(own)
                pieces = np.concatenate(keys).view(np.int64)
                n = len(pieces)
                one, two, doc_id, size, sketch = zip(*whole, strict=True)
                signed = lambda xs: pa.array(np.array(xs, np.uint64).view(np.int64))
                arrays = [
                    [signed(one), pa.array(pieces)],
                    [signed(two), pa.array(np.zeros(n, np.int64))],
                    [pa.array(doc_id, pa.int64()), pa.array(owners, pa.int64())],
                    [pa.nulls(len(whole), pa.int32()), pa.array(spares, pa.int32())],
                    [pa.array(size, pa.int32()), pa.nulls(n, pa.int32())],
                    [pa.array(sketch, pa.binary()), pa.nulls(n, pa.binary())],
                ]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(a) for a in arrays], schema=types)

    return texts_of(docs).mapInArrow(run, ROWS)


def grouped(rows: DataFrame) -> DataFrame:
    """All rows of texts, and the rows of pieces that several documents have: with the first
    document of their group and the number of its rows."""
    group = Window.partitionBy("key", "more", "size")
    rows = rows.withColumns({"first": F.min("doc_id").over(group), "n": F.count("*").over(group)})
    return rows.filter("size is not null or n > 1").drop("more")


def rarest(pieces: DataFrame) -> DataFrame:
    """key, doc_id of the pieces that each document needs: without its ``spare`` most frequent."""
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "key"))
    kept = pieces.withColumn("place", place).filter("place > spare").select("key", "doc_id")
    return kept


def merged(pieces: DataFrame) -> DataFrame:
    """key, doc_id and first document of the pieces that several documents keep; of pieces that the
    same documents keep there is one.

    A passage makes dozens of pieces, and two documents that share it would be paired for each of
    them. The documents of a piece are told by sums of both halves of their ids' hashes.
    """
    hashed = F.xxhash64("doc_id")
    kept = pieces.groupBy("key").agg(
        F.min("doc_id").alias("first"),
        F.max("doc_id").alias("last"),
        F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned(hashed, 32)).alias("high"),
    )
    one = kept.filter("first < last").groupBy("first", "last", "low", "high").agg(F.min("key").alias("key"))
    return lookup(pieces, one.select("key", "first"), ["key"], "inner")


def near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow similar sets."""
    brief = texts.select("doc_id", "size", "sketch").dropDuplicates()

    def side(name: str) -> DataFrame:
        return brief.select(F.col("doc_id").alias(name), F.col("size").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    both = pairs.join(side("a"), "a").filter("size_a > 2").join(side("b"), "b")
    both = both.filter("100L * least(size_a, size_b) >= 75L * greatest(size_a, size_b)")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "size_a", "size_b")], strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([7 * distance(x, y) <= m + n for x, y, m, n in rows], pa.bool_()))

    return both.mapInArrow(prune, "a long, b long").distinct()


ASKS = "hub long, slot long, member boolean, doc_id long, hashes binary"


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of a staged table whose sets are similar.

    Every document's set goes once to each partner ``a`` it is compared with; the documents of
    a hot partner are spread over slots of about SLOT each, and its own set goes to all of them.
    """
    slots = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLOT).alias("slots"))
    slot = F.pmod(F.xxhash64("b"), F.col("slots"))
    members = pairs.join(slots, "a").select(F.col("b").alias("doc_id"), F.col("a").alias("hub"), slot.alias("slot"), F.lit(True).alias("member"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))
    hubs = slots.select(F.col("a").alias("doc_id"), F.col("a").alias("hub"), every.alias("slot"), F.lit(False).alias("member"))
    asks = stage(members.unionByName(hubs), "asks")
    asked = texts_of(docs).join(F.broadcast(asks) if asks.count() <= FEW_IDS else asks, "doc_id")
    types = pa_schema(docs.sparkSession, ASKS)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                last, found = None, []
                for text in texts:
                    if last is None or text != last:
                        last, own = text, shingles(text).astype("<u8").tobytes()
                    found.append(own)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in types.names[:-1]], pa.array(found, pa.binary())], schema=types)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = None, set()  # the partner at hand and its sets
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("hub", "slot", "member", "doc_id")], batch.column("hashes"), strict=True)
            found = []
            for hub, slot, member, doc_id, hashes in rows:
                if (hub, slot) != place:
                    place, own = (hub, slot), set()
                if not member:
                    own.add(hashes.as_py())
                    continue
                one = np.frombuffer(hashes.as_buffer(), "<u8")
                for other in own:
                    two = np.frombuffer(other, "<u8")
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if 100 * both >= 75 * (len(one) + len(two) - both):
                        found.append((hub, doc_id))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    dealt_sets = asked.mapInArrow(sets, ASKS).repartition("hub", "slot").sortWithinPartitions("hub", "slot", "member")
    links = stage(dealt_sets.mapInArrow(check, "a long, b long"), "links")
    unstage(asks)
    return links


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row of ``docs``."""
    groups = stage(grouped(dealt(docs)), "groups")
    texts = stage(groups.filter("size is not null"), "texts")
    rare = stage(rarest(groups.filter("size is null")), "rare")
    unstage(groups)
    pieces = stage(merged(rare), "pieces")
    unstage(rare)
    equal = texts.filter("size > 0 and doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    # one partner for each document, the first of all that share a piece with it
    one = pieces.groupBy(F.col("doc_id").alias("b")).agg(F.min("first").alias("a")).filter("a < b")
    links = verified(docs, stage(near(one.select("a", "b"), texts), "near-one")).union(equal)
    found = components(links)
    # the first of a piece with those that still lie in other components, then any two such
    for pairs in (stars, across):
        rows = spread(pieces, texts, found)
        some = stage(near(pairs(rows), texts), "near")
        unstage(rows)
        links, found = joined(docs, links, found, some)
        unstage(some)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return texts.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), component.alias("component_id")
    )


def joined(docs: DataFrame, links: DataFrame, found: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and components after further pairs were compared."""
    if pairs.isEmpty():
        return links, found
    more = verified(docs, pairs)
    if more.isEmpty():
        return links, found
    links = links.union(more)
    return links, components(links)


def spread(pieces: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """key, doc_id, component, size and 512 bits of the sketch, of the pieces whose documents lie
    in several components; ``before`` are the document's last pieces before this one, the most frequent first."""
    rows = pieces.select("key", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "doc_id"))
    several = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    rows = rows.join(several.filter("low < high").select("key", "n"), "key")
    place = Window.partitionBy("doc_id").orderBy(F.desc("n"), "key").rowsBetween(-BEFORE, -1)
    rows = rows.withColumn("before", F.collect_list("key").over(place)).drop("n")
    return stage(rows.join(brief(texts), "doc_id"), "spread")


def brief(texts: DataFrame) -> DataFrame:
    """doc_id, size, and the sketch folded to LEAST_BITS bits in longs b0, b1 ..."""
    schema = "doc_id long, size int, " + ", ".join(f"b{i} long" for i in range(LEAST_BITS // 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = np.zeros((batch.num_rows, LEAST_BITS // 64), np.uint64)
            for row, sketch in zip(folded, batch.column("sketch").to_pylist(), strict=True):
                x = np.frombuffer(sketch, np.uint64)
                row[:] = np.bitwise_xor.reduce(x.reshape(-1, LEAST_BITS // 64), axis=0)
            longs = [pa.array(folded[:, i].view(np.int64)) for i in range(LEAST_BITS // 64)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("size"), *longs], names=schema_names)

    schema_names = [f.split()[0] for f in schema.split(", ")]
    return texts.select("doc_id", "size", "sketch").dropDuplicates().mapInArrow(run, schema)


# Part of the join's condition, so that no pair is made that size or sketch rule out.
COMPARABLE = "component_a <> component_b AND 100L * least(size_a, size_b) >= 75L * greatest(size_a, size_b) AND 7 * (%s) <= size_a + size_b" % (
    " + ".join(f"bit_count(b{i}_a ^ b{i}_b)" for i in range(LEAST_BITS // 64))
)


# Pieces are in one order for all documents, so before the first piece that two documents share they have none in
# common. Where they have one, the pair is made there or earlier; further back than BEFORE pieces it may be made again.
ONCE = "NOT arrays_overlap(before_a, before_b)"


def side(rows: DataFrame, name: str) -> DataFrame:
    """Columns of ``spread`` for one document of a pair."""
    return rows.select("key", F.col("doc_id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in rows.columns if c not in ("key", "doc_id")])


def stars(rows: DataFrame) -> DataFrame:
    """Each piece's first document with those of comparable size in other components."""
    rows = rows.drop("before")
    rest = [c for c in rows.columns if c not in ("key", "doc_id")]
    first = rows.groupBy("key").agg(F.min(F.struct("doc_id", *rest)).alias("f")).select("key", "f.*")
    return side(first, "a").join(side(rows, "b"), "key").filter(COMPARABLE).select("a", "b").distinct()


def meetings(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of a piece, of comparable size and sketch and in different components; few come twice."""
    pairs = side(rows, "a").join(side(rows, "b"), "key").filter(F.expr(COMPARABLE) & F.expr("a < b") & F.expr(ONCE))
    return pairs.select("a", "b")


def across(rows: DataFrame) -> DataFrame:
    """Any two documents of a piece of comparable size and sketch in different components."""
    return meetings(rows).distinct()


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of similar texts, that of the smallest id; all its columns as they are.

    Rows are judged by their own texts: texts that share an id and resemble nothing are all kept. Of
    rows of one id that resemble each other one stays. Rows without words and rows without an id
    are all kept. Extra columns may have any names.
    """
    doc_id = F.col("doc_id").cast("long")
    times = docs.select(doc_id.alias("doc_id")).filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    shared = stage(times.filter("n > 1").select("doc_id"), "shared-ids")
    row, mark = free_name("row", docs), free_name("mark", docs)
    rows = docs.withColumn(row, doc_id)
    names = F.lit(None).cast("long")
    if not shared.isEmpty():
        # texts of a shared id get an id of their own, below all that documents have
        hashed = -1 - F.xxhash64(doc_id, F.coalesce(F.col("text").cast("string"), F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1).cast("long"))
        marked = lookup(rows, shared.select(F.col("doc_id").alias(row), F.lit(True).alias(mark)), [row])
        rows = marked.withColumn(row, F.when(F.col(mark), hashed).otherwise(F.col(row)))
        names = F.when(F.col(mark), doc_id)
    else:
        rows = rows.withColumn(mark, F.lit(None).cast("boolean"))
    own = rows.select(F.col(row).alias("row"), names.alias("doc_id")).filter("doc_id is not null").distinct()
    found = similar_documents(rows.select(F.col(row).alias("doc_id"), "text")).filter("doc_id is not null and n_shingles > 0")
    members = stage(found.select(F.col("doc_id").alias("row"), "component_id").distinct(), "members")
    # a group of one has nothing to give up
    members = members.join(members.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "component_id")
    first = members.join(stage(own, "own-ids"), "row", "left").withColumn("doc_id", F.coalesce("doc_id", "row"))
    first = stage(first.select("component_id", "row", "doc_id"), "grouped")
    kept = first.groupBy("component_id").agg(F.min(F.struct("doc_id", "row")).alias("kept")).select("component_id", F.col("kept.row").alias("kept"))
    gone = first.join(kept, "component_id").filter("row <> kept").select(F.col("row").alias(row))
    gone = stage(gone, "gone")
    far = free_name("gone", rows)
    dropped = gone.withColumn(far, F.lit(True))
    rows = rows.join(F.broadcast(dropped), row, "left") if gone.count() <= FEW_IDS else lookup(rows, dropped, [row])
    rows = rows.filter(F.col(far).isNull())
    worded = F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]")
    once = F.col(mark).isNull() | ~F.coalesce(worded, F.lit(False))
    place = free_name("place", rows)
    repeated = rows.filter(~once).withColumn(place, F.row_number().over(Window.partitionBy(row).orderBy(F.col("text"))))
    kept_rows = rows.filter(once).select(*[f"`{c}`" for c in docs.columns])
    return kept_rows if shared.isEmpty() else kept_rows.unionByName(repeated.filter(F.col(place) == 1).select(*[f"`{c}`" for c in docs.columns]))
