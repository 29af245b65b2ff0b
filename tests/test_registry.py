import duckdb
import pytest

import __spark_entry__ as E
from commerce_lake import registry
from tests.conftest import SMALL
from tools.compare import compare_one, register_tables


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_tables(c, SMALL)
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["order_date", "total_revenue"]


def test_every_query_has_oracle_or_reason():
    qs, sql = registry.queries(), registry.oracle_sql()
    assert set(qs) <= set(E.queries()) and set(sql) <= set(E.oracle_sql())
    assert set(sql) <= set(qs)
    assert set(qs) - set(sql) == set()
    assert len(qs) >= 68


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    status, detail = compare_one(spark, con, name, SMALL)
    assert status in ("ok", "rows"), detail
