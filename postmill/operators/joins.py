"""Many-to-one joins that survive hot keys.

AQE splits a skewed sort-merge join only when both inputs come straight from a shuffle. Here
the looked-up side is first reduced to one row per key, and that aggregate would sit between
its shuffle and the join, so a key with a third of all rows would stay in one task. The join
therefore takes one more column: it sends the reduced side through a shuffle of its own, which
lets AQE split hot keys by their real size, and it spreads the rows without a key, which match
nothing. The result is the plain join's. Spark still broadcasts a side that it finds small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PLAIN = {"string", "long", "integer", "short", "byte", "double", "float", "boolean", "timestamp", "date"}


def free_name(wanted: str, *frames: DataFrame) -> str:
    """A column name that none of the DataFrames has (names are compared without case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``left`` with ``right``, which has at most one row per key."""
    # the further join column is a function of the key, which the optimizer does not know;
    # rows without a key get a hash of the row (no random number: a task that is run again
    # sends its rows the same way)
    row = [f"`{f.name}`" for f in left.schema if f.dataType.typeName() in _PLAIN]
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    slot = F.when(no_key, F.xxhash64(*row)).otherwise(F.xxhash64(*keys))
    name = free_name("_slot", left, right)
    looked_up = right.withColumn(name, F.xxhash64(*keys))
    return left.withColumn(name, slot).join(looked_up, [*keys, name], how).drop(name)
