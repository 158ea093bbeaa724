"""A table laid out for lookups on many columns: Morton order, row-group statistics and Bloom filters.

One sort order serves one column. Here each of several columns is cut into cells of about equal row
counts, the bits of the cells are interleaved into one number, and files are ranges of it: a range or
equality on any of the columns then meets few row groups, by their minima and maxima. Columns that are
looked up by equality alone get Bloom filters. Readers need nothing but a filter on the column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000  # rows that fix the cells; they decide the layout, never a result
MOST_BITS = 6  # of a column's cell
ROW_GROUP = 32 << 20


def cell_cuts(df: DataFrame, by: list[str], cells: int, seed: int = 1) -> dict[str, list]:
    """Values that cut each column into ``cells`` parts of about equal size; at most SAMPLE rows are collected."""
    fraction = min(1.0, 2 * SAMPLE / max(1, df.count()))
    rows = df.select(*by).sample(fraction=fraction, seed=seed).limit(SAMPLE).collect()
    cuts = {}
    for i, name in enumerate(by):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts[name] = sorted({values[len(values) * k // cells] for k in range(1, cells)}) if values else []
    return cuts


def _cell(value: Column, cuts: list, first: int = 0) -> Column:
    """How many cuts are not above a value (0 for null), by halving."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    below, above = _cell(value, cuts[:middle], first), _cell(value, cuts[middle + 1 :], first + middle + 1)
    return F.when(value >= F.lit(cuts[middle]), above).otherwise(below)


def morton(cells: list[Column], bits: int) -> Column:
    """The bits of several numbers interleaved, the highest first."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            own = F.shiftright(cell.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(own, bit * len(cells) + i))
    return out


def write_clustered(
    df: DataFrame, path: str, by: list[str], blooms: dict[str, int] | None = None, files: int = 64, row_group: int = ROW_GROUP, page_rows: int = 20_000
) -> None:
    """Write rows in the Morton order of up to ten columns; ``blooms``: columns and how many values they have.

    With c columns in the order and p pages in all, a lookup on one of them meets about p^(-1/c) of the rows:
    two or three columns, and Bloom filters for the rest.
    """
    bits = min(MOST_BITS, 60 // max(1, len(by)))
    cuts = cell_cuts(df, by, 1 << bits)
    place = morton([_cell(F.col(c), cuts[c]) for c in by], bits)
    # ties of the order are spread by the columns themselves and a hash of the row, so that a hot cell has several files
    spread = F.xxhash64(*[c for c in df.columns if c in {*by, *(blooms or {})}])
    rows = df.withColumns({"_place": place, "_spread": spread}).repartitionByRange(files, "_place", *by, "_spread")
    writer = rows.sortWithinPartitions("_place", *by).drop("_place", "_spread").write
    writer = writer.option("parquet.block.size", row_group).option("parquet.page.row.count.limit", page_rows)
    for column, n in (blooms or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(n))
    # Spark's default timestamps (INT96) carry no statistics; the setting has no form as a write option
    name, conf = "spark.sql.parquet.outputTimestampType", df.sparkSession.conf
    before = conf.get(name)
    conf.set(name, "TIMESTAMP_MICROS")
    try:
        writer.parquet(path)
    finally:
        conf.set(name, before)
