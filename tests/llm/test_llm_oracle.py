"""The queries that SQL can express against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import compare  # noqa: E402

from opsloom.llm import oracle, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    sql = oracle.oracle_sql()[name]
    assert compare.differences(queries.queries()[name](spark, FOLDER), compare.duck(FOLDER), sql) is None
