"""Every query against its SQL counterpart on the same tables."""

import pytest
from compare import connect, duck_rows, spark_rows

from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf, duck):
    frame = QUERIES[name](spark, sf)
    names, rows = spark_rows(frame)
    expected_names, expected = duck_rows(duck, ORACLE[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows, "a check on no rows proves nothing"
