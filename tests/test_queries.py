"""Every registered query against its SQL on whole tables."""

import pytest
from oracle import compare, connect

from gradus.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert compare(con, df, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry_module(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 101
    assert set(contract.oracle_sql()) <= set(contract.queries())
