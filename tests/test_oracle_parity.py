"""Every registered query with oracle SQL equals DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import assert_same, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert_same(df, con, E.oracle_sql()[name])


def test_every_query_has_a_builder():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Timestamp_Rounded", "Open", "High", "Low", "Close", "Volume",
                          "Score", "news_count"]
    assert df.count() > 0
