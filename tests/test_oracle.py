"""Every named query against its SQL, on the smallest tables."""

import compare
import pytest

from opsloom.plans import oracle
from opsloom.plans.queries import queries

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, connection, name):
    assert compare.differences(queries()[name](spark, FOLDER), connection, SQL[name]) is None


def test_entry_runs(spark):
    import __spark_entry__

    frame = __spark_entry__.entry(spark)
    assert frame.columns == ["system", "severity", "event_type", "time_bucket", "count"]
    assert frame.count() > 0
