"""What lookups on a clustered table read."""

import pytest
from pyspark.sql import functions as F

from postmill.operators import filters as FL
from postmill.operators import layout as LO
from postmill.session import work_dir
from tests.oracle import scan_metrics

ROWS = 40_000


@pytest.fixture(scope="module")
def table(spark):
    path = work_dir(spark, "clustered")
    h = lambda k: F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(1_000_000))
    rows = spark.range(ROWS).select(
        "id",
        F.concat(F.lit("J"), h(1).cast("string")).alias("job_id"),
        (h(2) / 10).alias("salary"),
        F.when(F.col("id") % 50 > 0, F.timestamp_seconds(F.lit(1_700_000_000) + h(3))).alias("published_date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (h(4) % 500).cast("string"))).alias("company_slug"),
    )
    LO.write_clustered(rows, path, ["salary", "published_date"], {"job_id": ROWS}, files=128, page_rows=50)
    return rows, spark.read.parquet(path)


def looked_up(rows, **values):
    found = FL.lookup(rows, **values)
    return sorted(map(tuple, found.collect()), key=repr), found


@pytest.mark.parametrize(
    "values",
    [{"salary": (50_000.0, 51_000.0)}, {"published_date": ("2023-11-20 00:00:00", "2023-11-20 02:00:00")}, {"job_id": "J777"}, {"salary": (None, 500.0), "company_slug": "hot"}],
)
def test_lookups_read_a_tenth_at_most(table, values):
    rows, clustered = table
    values = {k: tuple(F.lit(x).cast("timestamp") for x in v) if k == "published_date" else v for k, v in values.items()}
    if "job_id" in values:
        values["job_id"] = rows.filter("id = 777").first().job_id
    want, _ = looked_up(rows, **values)
    got, found = looked_up(clustered, **values)
    assert got == want and want
    read = scan_metrics(found)["numOutputRows"]
    assert len(want) <= read <= ROWS / 10


def test_all_rows_are_kept(table):
    rows, clustered = table
    assert clustered.exceptAll(rows).count() == 0 and clustered.count() == ROWS


def test_empty_and_null_columns(spark):
    for rows in ([], [(None, 1), (None, 2)]):
        path = work_dir(spark, "clustered")
        df = spark.createDataFrame(rows, "a string, b int")
        LO.write_clustered(df, path, ["a"], {"b": 10}, files=4)
        assert spark.read.schema(df.schema).parquet(path).count() == len(rows)


def test_cells_are_counted_right(spark):
    cuts = [3, 5, 9]
    rows = spark.createDataFrame([(x,) for x in (None, 1, 3, 4, 5, 8, 9, 100)], "v int")
    assert [r[0] for r in rows.select(LO._cell(F.col("v"), cuts)).collect()] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert spark.range(1).select(LO.morton([F.lit(5), F.lit(3)], 3)).first()[0] == 0b011011
