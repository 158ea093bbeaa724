"""Texts that are nearly the same, whatever company or board they come from: MinHash banding.

Contract: the set of a text is its distinct sequences of SHINGLE words (fewer words: all of them as
one; none: no set). Two texts are linked when the Jaccard similarity of their sets is at least FLOOR;
links make groups.

Everything is built-in expressions. Equal sets are one class from the start, so exact copies cost one
row. A class of more than SMALL shingles gets BANDS keys of ROWS minima each; the minimum under
``x XOR c`` is taken for constants c that differ in their first bits, so a shingle is hashed once.
A link at the floor is found with 1 - (1 - 0.75^4)^24 = 0.9999. Small sets get their rarest shingles
instead, which finds every link among them (prefix filter).

Disk. The hashes are larger than the texts. They are made where a text is read and only the keys and two hashes
of the whole set are kept; for rows that are in a pair they are made again. What is read no more is dropped.

Hot keys. A class meets the first class of each of its keys (a star), not every other; only
classes that share a key and still lie in different groups after that are compared with each other, sizes
first, inside a join of two plain inputs that AQE splits. Candidates are compared exactly.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from postmill.functions.text import col
from postmill.operators.components import connected
from postmill.operators.joins import lookup
from postmill.session import stage, unstage

SHINGLE = 5
FLOOR = 75  # percent
BANDS, ROWS = 24, 4
SMALL = 96  # shingles of a set whose links are found by its rarest ones: a common phrase may fill a band of it, and all texts with that phrase would meet
PREFIXED = SMALL * 100 // FLOOR  # the largest set that may be similar to a small one
KEYS = 500_000  # rows of keys that one task aggregates
PER_SET = 4  # pairs for each set that are compared in one round

_rng = random.Random(2024)
# the first bits count up, the others are random
MASKS = [((i * 2**57 + _rng.getrandbits(57)) ^ (1 << 63)) - (1 << 63) for i in range(BANDS * ROWS)]


def words_of(text: Column | str) -> Column:
    """Words between ASCII spaces, A to Z lower-cased."""
    lower = F.translate(F.coalesce(col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, r"[\x20\x09-\x0D]+"), "")


def shingle_hashes(words: Column) -> Column:
    """Sorted distinct hashes of a text's shingles."""
    n = F.size(words)
    none = F.array().cast("array<bigint>")
    every = F.transform(F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))
    return F.when(n == 0, none).otherwise(F.sort_array(F.array_distinct(every)))


def text_sets(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), one, two (hashes of the whole set), hashes."""
    # words and hashes go through generators of one row, which the optimizer does not copy
    words = rows.select(F.col(id_col).cast("bigint").alias("id"), F.explode(F.array(words_of(text_col))).alias("words"))
    sets = words.select("id", F.explode(F.array(shingle_hashes(F.col("words")))).alias("hashes"))
    whole = [F.xxhash64(F.lit(i), "hashes") for i in (1, 2)]
    return sets.select("id", F.size("hashes").alias("n"), whole[0].alias("one"), whole[1].alias("two"), "hashes")


def key_lists(sets: DataFrame) -> DataFrame:
    """id, n, one, two, small (hashes of a small set), bands (keys of another one) and times (equal rows) of sets.

    The hashes of large sets go no further than the task that reads them; of each set one row of minima is shuffled.
    """
    small = F.when(F.col("n") <= PREFIXED, F.col("hashes")).alias("small")
    each = sets.select("id", "n", "one", "two", small, F.explode_outer("hashes").alias("h"))
    minima = [F.min(F.col("h").bitwiseXOR(F.lit(m))).alias(f"m{i}") for i, m in enumerate(MASKS)]
    times = (F.count("*") / F.greatest("n", F.lit(1))).cast("int").alias("times")
    rows = each.groupBy("id", "n", "one", "two", "small").agg(times, *minima)
    bands = F.array(*[F.xxhash64(F.lit(b), *[f"m{b * ROWS + r}" for r in range(ROWS)]) for b in range(BANDS)])
    return rows.select("id", "n", "one", "two", "small", F.when(F.col("n") > SMALL, bands).alias("bands"), "times")


def first_keys(small: DataFrame) -> DataFrame:
    """(key, id, n): so many of the rarest shingles of small sets that similar sets share one of them."""
    each = small.select("id", "n", "one", F.explode("small").alias("key"))
    # any order finds all; by the hash alone a common shingle would join all texts that have it
    often = each.groupBy("key").agg(F.count("*").alias("often"))
    ordered = lookup(each, often, ["key"]).groupBy("id", "n", "one").agg(F.sort_array(F.collect_list(F.struct("often", "key"))).alias("keys"))
    needed = F.col("n") - F.ceil(F.col("n") * FLOOR / 100).cast("int") + 1
    return ordered.select(F.explode(F.slice("keys.key", 1, needed)).alias("key"), "id", "n")


def keys_of(listed: DataFrame) -> DataFrame:
    bands = listed.filter(F.col("n") > SMALL).select(F.explode("bands").alias("key"), "id", "n")
    return bands.union(first_keys(listed.filter(F.col("n") <= PREFIXED)))


def band_keys(sets: DataFrame) -> DataFrame:
    """(key, id, n) of sets: the values on which candidates are joined."""
    return keys_of(key_lists(sets))


COMPARABLE = f"100L * least(n_a, n_b) >= {FLOOR}L * greatest(n_a, n_b)"


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("key", F.col("id").alias(name), F.col("n").alias(f"n_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in rows.columns if c not in ("key", "id", "n")])


def star_pairs(keys: DataFrame) -> DataFrame:
    """Each class with the first one of its keys, where sizes allow a link."""
    first = keys.groupBy("key").agg(F.min(F.struct("id", "n")).alias("f")).select("key", "f.id", "f.n")
    pairs = lookup(_side(keys, "b"), _side(first, "a"), ["key"], "inner").filter("a < b").filter(COMPARABLE)
    return pairs.select("a", "b").distinct()


def crossing_pairs(keys: DataFrame, groups: DataFrame) -> DataFrame:
    """Any two classes that share a key, are of comparable size and lie in different groups."""
    rows = lookup(keys, groups.withColumnRenamed("node", "id"), ["id"]).withColumn("group", F.coalesce("group", "id"))
    grouped = stage(rows, "grouped-keys")
    open_keys = several_groups(grouped).select("key")
    # a pair is made at the first key that it shares: no other lies before it in both lists
    earlier = Window.partitionBy("id", "n").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    rows = grouped.join(open_keys, "key", "left_semi").withColumn("before", F.collect_list("key").over(earlier))
    opened = stage(rows, "open-keys")
    unstage(grouped)
    return crossing_rows(opened).repartition("a", "b").distinct()


def several_groups(rows: DataFrame) -> DataFrame:
    """(key, low, high) of the keys of a staged table that lie in several groups."""
    # most keys are there once: nothing is gained before the shuffle, and after it a task holds about KEYS of them
    parts = rows.count() // KEYS + 1
    dealt = rows.select("key", "group").repartition(parts, "key")
    return dealt.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low < high")


def crossing_rows(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of rows (key, id, n, group, before) that share a key."""
    meet = f"a < b AND group_a <> group_b AND {COMPARABLE} AND NOT arrays_overlap(before_a, before_b)"
    return _side(rows, "a").join(_side(rows, "b"), "key").filter(meet).select("a", "b")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    rows = pairs
    for name in ("a", "b"):
        rows = rows.join(sets.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("hashes").alias(f"set_{name}")), name)
    both = F.size(F.array_intersect("set_a", "set_b"))
    return rows.filter(100 * both >= FLOOR * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def links_among(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The staged pairs (a, b) that are links. Only the sets of rows in a pair are made again and kept meanwhile."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = stage(text_sets(texts.join(ids, "id", "left_semi"), "id", "text").select("id", "n", "hashes"), "pair-sets")
    # a pair carries a set through a shuffle; the files of what was shuffled before are dropped first
    rounds = pairs.count() // (PER_SET * max(1, sets.count())) + 1
    found = []
    for i in range(rounds):
        sets.sparkSession.sparkContext._jvm.System.gc()
        dealt = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == i)
        found.append(stage(linked(dealt, sets), "links"))
    links = reduce(DataFrame.union, found)
    unstage(sets)
    unstage(pairs)
    return links


def near_duplicate_texts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, group_id): the smallest id that links reach; itself for a text without words.

    ``id_col`` is unique and never null.
    """
    texts = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    listed = stage(key_lists(text_sets(texts, "id", "text")), "key-lists")
    members = listed.filter("n > 0").groupBy("n", "one", "two").agg(F.min("id").alias("class"))
    of_class = lookup(listed.select("id", "n", "one", "two", "times"), members, ["n", "one", "two"])
    of_class = stage(of_class.select("id", "n", F.coalesce("class", "id").alias("class"), "times"), "classes")
    classes = stage(listed.drop("two", "times").join(members.select(F.col("class").alias("id")), "id", "left_semi"), "class-lists")
    unstage(listed)
    keys = stage(keys_of(classes), "keys")
    unstage(classes)
    links = links_among(stage(star_pairs(keys), "stars"), texts)
    groups = connected(links)
    more = links_among(stage(crossing_pairs(keys, groups), "crossing"), texts)
    unstage(keys)
    if not more.isEmpty():
        groups = connected(links.union(more))
    found = lookup(of_class, groups.withColumnRenamed("node", "class"), ["class"])
    found = found.select("id", "n", F.coalesce("group", "class").alias("group_id"), F.explode(F.expr("sequence(1, times)")))
    return found.select("id", F.col("n").cast("bigint").alias("n_shingles"), "group_id")


def near_duplicate_descriptions(postings: DataFrame) -> DataFrame:
    """Postings (seq, source, description) with the group of their text, its size, and whether it has postings
    of several sources: the same job on another board or under another company."""
    found = near_duplicate_texts(postings, "seq", "description").withColumnRenamed("id", "seq")
    rows = lookup(postings.select("seq", "source"), found, ["seq"], "inner")
    sizes = rows.groupBy("group_id").agg(F.count("*").alias("group_size"), (F.min("source") < F.max("source")).alias("several_sources"))
    return lookup(rows, sizes, ["group_id"], "inner")
