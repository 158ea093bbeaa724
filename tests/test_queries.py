"""Every registered query against its SQL, on whole small tables."""

import pytest

from postmill.plans.catalog import QUERIES, Inputs
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, con, name):
    query = QUERIES[name]
    got = query.run(Inputs(spark, SF)).toPandas()
    assert differences(got, con.execute(query.sql).df()) is None


def test_every_query_has_its_sql():
    assert [n for n, q in QUERIES.items() if not q.sql] == []
