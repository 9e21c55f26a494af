"""Registered corpus queries against their DuckDB text, on sf0.001."""

import pytest

from farebox.llm.catalog import REGISTRY
from oracle_compare import compare

WITH_SQL = sorted(n for n, (_f, sql) in REGISTRY.items() if sql is not None)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_sql(spark, sf_small, name):
    fn, sql = REGISTRY[name]
    r = compare(spark, name, fn, sql, sf_small)
    assert r["ok"], r.get("detail")
