"""Every registered scenario equals its DuckDB oracle (sf0.001, the smoke
scale; the driver checks sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from periodload.scenarios import SCENARIOS  # noqa: E402
from check_oracle import canon  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(SCENARIOS) <= set(E.queries())
    assert set(SCENARIOS) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SCENARIOS))
def test_query_matches_oracle(spark, duck, name):
    got = canon(E.queries()[name](spark, SF).toPandas())
    exp = canon(duck.execute(E.oracle_sql()[name]).df())
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "o_orderdate_month" in df.columns
