"""Every registered query against its SQL twin on the smallest data."""

from dataclasses import replace

import pytest
from compare import differences, duck
from conftest import TINY

from barlake.registry import all_queries, all_sql, forecasting

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module", autouse=True)
def fewer_trees():
    """The twins hold what doesn't depend on the number of trees; 400 of them take minutes at any size of the data. The
    learner itself is held against a plain one in test_boosting."""
    whole = forecasting.WHOLE
    forecasting.WHOLE = replace(whole, trees=replace(whole.trees, trees=30))
    yield
    forecasting.WHOLE = whole


@pytest.fixture(scope="module")
def con():
    return duck(TINY)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, TINY)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        assert df.count() > 0
