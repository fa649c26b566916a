"""Every registered key against its DuckDB oracle on the sf0.01 driver tables."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle_harness import check
from riskspark.plans import catalog

KEYS = sorted(catalog.query_callables())
SQL = catalog.oracle_sql()


def test_every_key_has_an_oracle():
    assert set(KEYS) == set(SQL), set(KEYS) ^ set(SQL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    ok, msg = check(spark, SF01, [key], verbose=False)[key]
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["origin_country", "revenue_at_risk", "delayed_shipments"]
