"""Every registered query against its DuckDB oracle on sf0.001 (rows, column
names, order-insensitive values) – the driver's gate, run small."""

import pytest

from farebox.plans.catalog import REGISTRY
from oracle_compare import compare

WITH_ORACLE = sorted(n for n, (_f, sql) in REGISTRY.items() if sql is not None)
ROWS_ONLY = sorted(n for n, (_f, sql) in REGISTRY.items() if sql is None)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_matches_oracle(spark, sf_small, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, name, fn, sql, sf_small)
    assert r["ok"], r.get("detail")


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, sf_small, name):
    fn, _ = REGISTRY[name]
    assert fn(spark, sf_small).count() >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
