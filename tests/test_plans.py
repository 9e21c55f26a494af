"""Physical-plan checks: pushdown, pruning, broadcast of bounded lookups,
top-k without a global sort, no Python in SQL-expressible operators, no
single-partition exchange in keyed operators."""

import pytest

from farebox.plans.catalog import REGISTRY
from plan_text import plan_of

SQL_EXPRESSIBLE = [
    "hourly_revenue_outer_zones", "hourly_revenue_full_join", "monthly_revenue_zone", "exact_dedupe_fact",
    "dedupe_keep_one_a", "dedupe_keep_one_z", "daily_report", "dup_report", "tag_month", "top_tags",
    "quality_report", "tumble_zone", "session_keyed",
]


def _plan(spark, sf_small, name):
    return plan_of(REGISTRY[name][0](spark, sf_small))


def test_time_filter_and_pruning_reach_scan(spark, sf_small):
    p = _plan(spark, sf_small, "hourly_revenue_full_join")
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters") and "GreaterThanOrEqual(ts," in line]
    assert len(pushed) == 2  # both service scans
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema") and "ts:timestamp_ntz" in line]
    assert scan and all("props" not in line and "event_id" not in line for line in scan)


def test_zone_lookup_is_broadcast(spark, sf_small):
    assert "BroadcastHashJoin" in _plan(spark, sf_small, "hourly_revenue_outer_zones")


def test_top_k_plans_take_ordered(spark, sf_small):
    for name in ("top_tags", "dup_report", "zone_frequency_bottom"):
        assert "TakeOrderedAndProject" in _plan(spark, sf_small, name), name


@pytest.mark.parametrize("name", ["dedupe_keep_one_a", "dedupe_keep_one_z", "daily_report", "quality_report"])
def test_keep_one_is_a_hash_aggregate(spark, sf_small, name):
    p = _plan(spark, sf_small, name)
    assert "HashAggregate" in p and "SortAggregate" not in p and "Window" not in p and "partial_min" in p


def test_one_shuffle_for_hourly_by_service(spark, sf_small):
    p = _plan(spark, sf_small, "hourly_revenue_outer_zones")
    assert p.count("hashpartitioning(") == 1 and "SortMergeJoin" not in p


@pytest.mark.parametrize("name", SQL_EXPRESSIBLE)
def test_no_python_in_sql_operators(spark, sf_small, name):
    p = _plan(spark, sf_small, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p, (name, node)


@pytest.mark.parametrize("name", ["session_keyed", "tag_month", "daily_report", "tumble_zone"])
def test_keyed_operators_do_not_gather_to_one_partition(spark, sf_small, name):
    assert "SinglePartition" not in _plan(spark, sf_small, name)


def _plan_with(spark, sf_small, name, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        return _plan(spark, sf_small, name)
    finally:
        spark.conf.set(key, before)


def test_bucketed_table_is_read_without_an_exchange(spark, sf_small):
    p = _plan_with(spark, sf_small, "bucketed_tag_share", "spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange" not in p and "Join" in p and "SelectedBucketsCount: 16 out of 16" in p


def test_bucket_pruning_reads_the_wanted_tags_only(spark, sf_small):
    import re

    # Without a join the planner shows the scan as unbucketed, though it still skips the files of other buckets.
    p = _plan_with(spark, sf_small, "bucketed_tag_trends", "spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    (chosen,) = re.findall(r"SelectedBucketsCount: (\d+) out of 16", p)
    assert 0 < int(chosen) <= 5


def test_buckets_follow_the_size(spark, tmp_dir):
    import glob

    from farebox.operators import sinks

    df = spark.range(1000).selectExpr("id % 97 as k", "id as v")
    out = sinks.write_bucketed(df, "farebox_bucket_test", f"{tmp_dir}/b", ["k"], rows_per_bucket=100, least=2)
    assert out.count() == 1000 and len(glob.glob(f"{tmp_dir}/b/part-*.parquet")) == 10
    spark.sql("DROP TABLE farebox_bucket_test")
