import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A small table of documents with clashing extra columns; rows are (doc_id, text[, source])."""

    def make(rows):
        rows = [(*r, *[None, "s"][len(r) - 1 :])[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        names = ("key", "size", "name", "n_tokens", "component_id", "gone", "copies", "cut", "first")
        return df.withColumn("lang", F.lit("en")).withColumns({n: F.lit("clash") for n in names})

    return make
