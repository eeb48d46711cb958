"""Every catalog query with a SQL twin must match DuckDB on the small
driver tables (row count, column names, order-insensitive values)."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck_con

from .conftest import SF_SMALL

SQLS = E.oracle_sql()
NAMES = sorted(SQLS)


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msgs, ns, nd = compare(df, con, SQLS[name])
    assert ok, f"{name}: spark={ns} duck={nd} {msgs}"


def test_every_query_has_a_callable():
    assert set(SQLS) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["price", "priceWillDrop", "futureMinPrice", "saving"]
    assert df.count() > 0
