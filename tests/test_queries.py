"""Every core query over the smallest test tables, against its SQL."""

import os

import pytest

from quern.plans import data_queries, match_queries
from tests.helpers import DATA, rows, sql_rows

QUERIES = data_queries.QUERIES | match_queries.QUERIES
ORACLE = data_queries.oracle() | match_queries.oracle()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, DATA)
    got = rows(df)
    if name in ORACLE:
        names, want = sql_rows(ORACLE[name])
        assert sorted(df.columns) == names
        assert got == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
