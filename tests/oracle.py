"""Compare a registered query with its SQL: names, row count and values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        return _value(v.item())
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(_value(x) for x in v)
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    columns = sorted(df.columns)
    rows = [tuple(_value(v) for v in r) for r in df[columns].itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the first difference."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    a, b = rows_of(spark_df), rows_of(sql_df)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; only spark {list(set(map(repr, a)) - set(map(repr, b)))[:2]}; only sql {list(set(map(repr, b)) - set(map(repr, a)))[:2]}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            names = sorted(spark_df.columns)
            bad = {n: (p, q) for n, p, q in zip(names, x, y, strict=True) if p != q}
            return f"values {bad} in spark {repr(x)[:300]}"
    return None


def scan_metrics(df) -> dict[str, int]:
    """Metrics of the file scans of a DataFrame that was collected, summed."""
    found: dict[str, int] = {}

    def walk(node) -> None:
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            metrics = node.metrics()
            for name in ("numOutputRows", "numPartitions", "numFiles"):
                if metrics.contains(name):
                    found[name] = found.get(name, 0) + metrics.apply(name).value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found
