"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import pytest

from conftest import SMALL
from tools.check_oracle import rows_of

import __spark_entry__ as entry
from stratum.plans.registry import load_all

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(load_all()) <= set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["tenant_id", "tenant_name", "month", "order_count", "total_revenue",
                          "avg_order_value", "unique_customers"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SMALL).toArrow()
    want = duck.sql(ORACLES[key]).to_arrow_table()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
