"""The trie of conversations against SQL and against sequences in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from postmill.llm import conversation_trie as trie
from postmill.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF
from tests.oracle import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string, depth long, a string, block string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash", "clash") for r in rows], SCHEMA)


def ordered(rows):
    found = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            found.setdefault(conv_id, []).append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in found.items()}


def regrouped(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain(conversations):
    """Nodes by sequences of turns."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in own) or 1
        saved[node] = sum(saved[x] for x in own) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    rows = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(who), len(node), parent, len(who), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(rng, n):
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long " * 9])))
    return rows


def test_query_agrees_with_sql(spark):
    found = QUERIES["op12_conversation_trie"](spark, SF).toPandas()
    assert differences(found, connect(SF).execute(SQL["op12_conversation_trie"]).df()) is None


@pytest.mark.parametrize("cells", [1 << 16, 8])
def test_random_conversations(spark, monkeypatch, cells):
    """Also with a sketch of so few cells that it proves next to nothing."""
    monkeypatch.setattr(trie, "LEAST_CELLS", cells)
    monkeypatch.setattr(trie, "MOST_CELLS", cells)
    rows = random_rows(random.Random(cells), 80)
    table = table_of(spark, rows)
    assert got(trie.conversation_trie(table)) == plain(ordered(rows))
    assert got(trie.regrouped_trie(table)) == plain(regrouped(ordered(rows)))


def test_copies_long_conversations_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(trie, "BUCKET_BITS", 2)
    long = [(str(i % 3), f"turn {i}") for i in range(150)]
    conversations = {c: long for c in range(40)} | {c: long[: c - 20] + [("x", f"{c}")] for c in range(100, 130)} | {1000: long[:1]}
    rows = [(c, i, *turn) for c, turns in conversations.items() for i, turn in enumerate(turns)]
    random.Random(1).shuffle(rows)
    table = table_of(spark, rows)
    assert got(trie.conversation_trie(table)) == plain(conversations)
    assert got(trie.regrouped_trie(table)) == plain(regrouped(conversations))


def test_odd_rows(spark):
    rows = [(None, 0, "a", "lost"), (5, None, None, None), (5, 3, "b", "x"), (5, 3, "b", "x"), (5, 3, "a", "y"), (6, 1, "b", "w " * 60_000), (-4, 0, "q", "z")]
    table = table_of(spark, rows)
    assert got(trie.conversation_trie(table)) == plain(ordered(rows))
    assert got(trie.conversation_trie(table.limit(0))) == [] == got(trie.regrouped_trie(table.limit(0)))


def test_turnless_conversations_belong_to_the_root(spark):
    rows = [(c, 0, "user", "hello") for c in range(1, 40) if c % 5]  # their groups' first ones are absent
    want = plain(regrouped(ordered(rows)))
    assert want[0][1] == 0 and got(trie.regrouped_trie(table_of(spark, rows))) == want
    root = [r for r in want if r[1] == 0][0]
    assert root[-1] != hashlib.sha256(b"").hexdigest()


def test_only_shared_prefixes_are_grouped(spark):
    rows = [(c, t, "user", f"{c} {t}" if t else "hello") for c in range(300) for t in range(6)]
    turns = trie.turns_of(table_of(spark, rows)).withColumn("depth", F.col("place") + 1)
    ids = turns.groupBy("conv_id").agg(F.count("*").alias("total"))
    found = trie.screened(trie.prefixes(turns, ids))
    shared = found.filter("not alone").groupBy("depth").count().collect()
    assert {r["depth"]: r["count"] for r in shared if r["depth"] < 2} == {0: 300, 1: 300}
    assert sum(r["count"] for r in shared if r["depth"] > 1) < 100  # of 1,500
