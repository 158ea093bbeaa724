r"""Labels from a table of regular expressions: the first pattern by priority that is found in a text.

A theta join (every text against every pattern) is not made. Each pattern has a literal, the longest
stretch of characters that whatever it matches must contain. Of the literal one gram is indexed, that
which the fewest other patterns have; the distinct texts are joined with the index on their own
grams, and only these candidates are searched with the pattern. Patterns without such a literal have to look at
every text; they become one expression per LOOSE_STEP of them and no join.

Read as literals: plain characters and escaped punctuation. A group, a character class, an escape like ``\d``,
a dot and an anchor end a literal; a character that ``*``, ``?`` or ``{`` makes optional is no part of it. A pattern
with alternatives outside of groups, a group that begins with ``?`` (flags, look-arounds) or groups nested more than
four deep counts as one without.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import lookup
from postmill.session import stage

GRAMS = (12, 6, 3)  # sizes of indexed grams; the longest that fits is taken
LOOSE_STEP = 25
META = "\\.+*?()[]{}^$|"
_HELD = "".join(chr(0xE000 + i) for i in range(len(META)))  # stand for escaped marks meanwhile
_END = chr(0xE0FF)  # of a literal


def longest_literal(pattern: Column) -> Column:
    """The longest literal of a regular expression (the first of several), or null."""
    p = pattern
    for mark, held in zip(META, _HELD, strict=True):
        p = F.replace(p, F.lit("\\" + mark), F.lit(held))
    p = F.regexp_replace(p, r"\\([^A-Za-z0-9])", "$1")
    more = r"(?:[*+?]|\{[^}]*\})*"
    p = F.regexp_replace(p, r"\\[A-Za-z0-9]" + more, _END)
    p = F.regexp_replace(p, r"\[\^?\]?[^\]]*\]" + more, _END)
    for _ in range(4):
        p = F.regexp_replace(p, r"\((?!\?)[^()]*\)" + more, _END)
    open_ended = p.rlike(r"[|()\\\[]")
    p = F.regexp_replace(p, rf"[^{_END}](?:[*?]|\{{[^}}]*\}})[?+]?", _END)
    p = F.regexp_replace(p, r"[.^$+]", _END)
    parts = F.transform(F.split(p, _END), lambda x: F.translate(x, _HELD, META))
    best = F.element_at(F.array_sort(parts, lambda a, b: F.length(b) - F.length(a)), 1)
    return F.when(~open_ended & (F.length(best) >= GRAMS[-1]), best)


def _grams(text: Column, size: Column | int) -> Column:
    size = F.lit(size) if isinstance(size, int) else size
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def gram_index(patterns: DataFrame) -> DataFrame:
    """(gram, literal, pattern, priority, label): one gram for each pattern that has a literal."""
    rows = patterns.withColumn("literal", longest_literal(F.col("pattern"))).filter("literal is not null")
    size = F
    for n in GRAMS:
        size = size.when(F.length("literal") >= n, n)
    rows = rows.withColumn("rule", F.struct("priority", "label", "pattern", "literal"))
    grams = rows.select("rule", F.explode(_grams(F.col("literal"), size)).alias("gram"))
    grams = stage(grams, "pattern-grams")
    times = grams.groupBy("gram").agg(F.count("*").alias("times"))
    rarest = grams.join(times, "gram").groupBy("rule").agg(F.min_by("gram", F.struct("times", "gram")).alias("gram"))
    return rarest.select("gram", "rule.*")


def _loose(text: Column, rules: list) -> Column:
    """The first of a few patterns that is found, as (priority, label)."""
    tests = [F.when(text.rlike(r["pattern"]), F.struct(F.lit(r["priority"]).alias("priority"), F.lit(r["label"]).alias("label"))) for r in rules]
    return F.coalesce(*tests)


def first_labels(rows: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """Rows with ``label`` and ``priority`` of the first pattern found in column ``text``, null where none is.

    ``patterns`` has priority (bigint), label, pattern. Of equal priorities the smaller label counts. Null texts
    have no label. Texts are searched once each, however often they come.
    """
    patterns = patterns.select(F.col("priority").cast("bigint"), F.col("label").cast("string"), F.col("pattern").cast("string")).filter("pattern is not null")
    patterns = stage(patterns.distinct(), "patterns")
    index = stage(gram_index(patterns), "pattern-index")
    texts = stage(rows.select(F.col(text).alias("text")).filter("text is not null").distinct(), "texts")
    sizes = [r["n"] for r in index.select(F.length("gram").alias("n")).distinct().collect()]  # of GRAMS
    found = rows.sparkSession.createDataFrame([], "text string, priority bigint, label string")
    for n in sorted(sizes):
        own = texts.filter(F.length("text") >= n).select("text", F.explode(_grams(F.col("text"), n)).alias("gram"))
        hits = own.join(index.filter(F.length("gram") == n), "gram").filter(F.col("text").contains(F.col("literal")))
        found = found.union(hits.filter(F.rlike("text", "pattern")).select("text", "priority", "label"))
    # patterns that no literal can find: as many expressions as the table has of them
    loose = patterns.filter(longest_literal(F.col("pattern")).isNull()).orderBy("priority", "label").collect()
    for start in range(0, len(loose), LOOSE_STEP):
        hit = texts.select("text", _loose(F.col("text"), loose[start : start + LOOSE_STEP]).alias("hit")).filter("hit is not null")
        found = found.union(hit.select("text", "hit.*"))
    first = found.groupBy("text").agg(F.min(F.struct("priority", "label")).alias("first"))
    first = first.select(F.col("text").alias(text), "first.priority", "first.label")
    return lookup(rows, first, [text])
