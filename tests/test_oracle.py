"""Every registered query against its SQL, on the smallest tables."""

import pytest
from check_oracle import compare, connect

from registry import registered

ALL = registered()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, sf_dir, con, name):
    run, sql = ALL[name]
    problem = compare(spark, con, run, sql, sf_dir)
    assert problem in (None, "equal, but no rows"), problem


def test_entry(spark):
    import __spark_entry__ as entry_point

    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
