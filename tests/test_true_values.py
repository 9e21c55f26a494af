"""Values that the benchmark tables do not hold: averages finer than a cent,
NaN, drifting types, sessions at random gaps, and interval bounds at the scan."""

import datetime as dt
import math
import random

from farebox.operators import normalize, sessions, tags
from farebox.operators.revenue import daily_report, global_sum
from farebox.plans import domain, trips
from plan_text import plan_of
from pyspark.sql import functions as F

DAY = dt.datetime(2024, 1, 1)


def test_averages_keep_fine_values_and_nan(spark):
    rows = [(DAY, "green", "cash", 0.004), (DAY, "green", "cash", 0.004), (DAY, "yellow", "cash", float("nan"))]
    df = spark.createDataFrame(rows, "pickup_datetime timestamp, taxi_type string, payment_type_name string, fare_amount double")
    got = {r.taxi_type: r for r in daily_report(df).collect()}
    assert got["green"].avg_fare == 0.004 and got["green"].total_fare == 0.008
    assert math.isnan(got["yellow"].avg_fare)
    clean = normalize.nan_to_null_all(df)
    assert global_sum(clean, "fare_amount", "s").collect()[0].s == 0.008


def test_tag_month_average_of_fine_values(spark):
    q = spark.createDataFrame([(1, DAY, 0.001, 3), (1, DAY, 0.002, None)], "id long, creation_date timestamp, score double, view_count long")
    t = spark.createDataFrame([(1, "a")], "question_id long, tag string")
    row = tags.tag_month(q, t).collect()[0]
    assert (row.question_count, row.avg_score, row.avg_views) == (2, 0.0015, 3.0)


def test_casts_drifting_columns(spark):
    df = spark.createDataFrame([("7", "2.5", "n/a", "2024-01-01 00:00:00", "x")], ["VendorID", "fare_amount", "extra", "pickup_datetime", "other"])
    out = normalize.apply_casts(df)
    assert dict(out.dtypes) == {"VendorID": "bigint", "fare_amount": "double", "extra": "double", "pickup_datetime": "timestamp", "other": "string"}
    assert tuple(out.collect()[0]) == (7, 2.5, None, DAY, "x")


def _chains(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1] = (out[-1][0], t, out[-1][2] + 1)
        else:
            out.append((t, t, 1))
    return out


def test_sessions_at_random_gaps(spark):
    rng = random.Random(5)
    times = {k: [rng.choice([rng.randrange(40_000), 300 * rng.randrange(120)]) for _ in range(rng.randrange(1, 150))] for k in (1, 2, None)}
    rows = [(k, DAY + dt.timedelta(seconds=t)) for k, ts in times.items() for t in ts]
    df = spark.createDataFrame(rows, "zone int, t timestamp")
    for gap, bucket in ((300, 3600), (7, 60), (5000, 3600)):
        got = sessions.sessions(df, "t", f"{gap} seconds", ["zone"], bucket_seconds=bucket).collect()
        want = {(k, DAY + dt.timedelta(seconds=a), DAY + dt.timedelta(seconds=b + gap), n) for k, ts in times.items() for a, b, n in _chains(ts, gap)}
        assert {tuple(r) for r in got} == want and len(got) == len(want)
        every = _chains([t for ts in times.values() for t in ts], gap)
        chain = sessions.sessions(df, "t", f"{gap} seconds", count_by=["zone"], bucket_seconds=bucket).collect()
        per = {}
        for r in chain:
            per[(r.session_start, r.session_end)] = per.get((r.session_start, r.session_end), 0) + r.num_trips
        assert per == {(DAY + dt.timedelta(seconds=a), DAY + dt.timedelta(seconds=b + gap)): n for a, b, n in every}


def test_sessions_order_cells_not_events(spark):
    df = spark.range(10).select(F.lit(1).alias("zone"), F.timestamp_seconds("id").alias("t"))
    plan = plan_of(sessions.sessions(df, "t", "5 minutes", ["zone"]), "simple").splitlines()
    at = {name: min(i for i, line in enumerate(plan) if f" {name}" in line) for name in ("Range", "Window")}
    between = plan[at["Window"]:at["Range"]]
    assert sum("HashAggregate" in line for line in between) >= 2 and at["Window"] < at["Range"]


def test_interval_reaches_a_landed_scan(spark, sf_small, tmp_dir):
    trips.ingested(spark, sf_small).write.parquet(f"{tmp_dir}/landed")
    landed = spark.read.parquet(f"{tmp_dir}/landed")
    staged = trips.staging_trips(landed, domain.payment_lookup(spark), "1998-01-01 00:00:00", "1998-02-01 00:00:00", lookup_rows=domain.PAYMENT_LOOKUP_SIZE)
    pushed = next(line for line in plan_of(staged).splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "GreaterThanOrEqual(lpep_pickup_datetime" in pushed


def test_coalesced_interval_takes_the_first_value(spark):
    t = [DAY + dt.timedelta(days=d) for d in range(4)]
    rows = [(t[0], t[2]), (t[2], t[0]), (None, t[2]), (None, t[0]), (None, None), (t[3], None)]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    got = normalize.coalesced_between(df, ["a", "b"], t[2], t[3]).collect()
    assert {tuple(r) for r in got} == {(t[2], t[0]), (None, t[2])}
