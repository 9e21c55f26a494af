"""Operators on hand-made rows (nulls, ties, drift, edges) that the driver's
tables do not contain."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from farebox.functions import columns as C
from farebox.operators import dedupe, joins, normalize, quality, revenue, tags, unions
from farebox.plans import domain, trips
from farebox.sources import files
from twins import keep_one_window

T0 = dt.datetime(2025, 10, 1, 0, 0, 0)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


# ----------------------------------------------------------------- dedupe
RAW_SCHEMA = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, lpep_pickup_datetime timestamp, "
    "lpep_dropoff_datetime timestamp, PULocationID long, DOLocationID long, fare_amount double, "
    "payment_type long, taxi_type string"
)


def _raw(spark):
    t1 = T0 + dt.timedelta(minutes=10)
    return spark.createDataFrame(
        [
            (T0, t1, None, None, 1, 2, 10.0, 1, "yellow"),   # same key, other payment
            (T0, t1, None, None, 1, 2, 10.0, 2, "yellow"),
            (T0, t1, None, None, 1, 2, 12.0, 7, "yellow"),   # same key without fare, unmatched code
            (None, None, T0, t1, None, 3, 5.0, 1, "green"),  # null in a key column
            (None, None, T0, t1, 4, 3, -1.0, 1, "green"),    # negative fare dropped
        ],
        RAW_SCHEMA,
    )


def test_staging_variants_split_on_fare_and_unmatched(spark):
    lk = domain.payment_lookup(spark)
    a = trips.staging_trips(_raw(spark), lk, variant="A")
    z = trips.staging_trips(_raw(spark), lk, variant="Z")
    # A: fare in key -> (10.0) and (12.0) rows survive, null location kept.
    got_a = rows(a.select("pickup_location_id", "fare_amount", "payment_type_name"))
    # The tie on the key is broken by the remaining columns: 'cash' < 'credit_card'.
    assert got_a == sorted([(1, 10.0, "cash"), (1, 12.0, None), (None, 5.0, "credit_card")], key=repr)
    # Z: no fare in key -> one survivor per (times, locations): fare 10.0 first;
    # the null-location row is dropped.
    got_z = rows(z.select("pickup_location_id", "fare_amount", "payment_type_name"))
    assert got_z == [(1, 10.0, "cash")]


def test_keep_one_equals_window_form(spark):
    df = spark.createDataFrame(
        [(1, 3, "b"), (1, 3, None), (1, 2, "z"), (2, 1, "a"), (2, 1, "a"), (None, 5, "q")],
        "k int, o int, v string",
    )
    a = dedupe.keep_one(df, ["k"], ["o"])
    b = keep_one_window(df, ["k"], ["o"])
    assert rows(a) == rows(b) == sorted([(1, 2, "z"), (2, 1, "a"), (None, 5, "q")], key=repr)


def test_exact_dedupe_with_nulls(spark):
    df = spark.createDataFrame([(1, None, "x")] * 3 + [(1, None, "y")], "a int, b string, c string")
    assert dedupe.exact(df).count() == 2


def test_duplicate_report_ties_at_cut(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "b", "a", "a", "c", "c", "d"]], "k string")
    got = dedupe.duplicate_report(df, ["k"], top=2).collect()
    assert [(r.k, r.cnt) for r in got] == [("a", 2), ("b", 2)]


def test_excess_rows_struct_key_no_collision(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), (None, "x")], "p string, q string")
    assert dedupe.excess_rows(df, {"e": ["p", "q"]}).collect()[0].e == 1


# ----------------------------------------------------------------- columns
def test_surrogate_key_null_safe(spark):
    df = spark.createDataFrame([(None, None), ("a|", "b"), ("a", "|b")], "x string, y string")
    got = [r.k for r in df.select(C.surrogate_key(["x", "y"]).alias("k")).collect()]
    import hashlib

    assert got[0] == hashlib.md5(b"|").hexdigest()
    assert got[1] == got[2]  # the separator collision of the text key (kept on purpose)


def test_payment_and_vendor_names(spark):
    df = spark.createDataFrame([(i,) for i in range(8)] + [(None,)], "p int")
    names = [r.n for r in df.select(C.payment_type_name("p").alias("n")).collect()]
    assert names == ["Unknown", "Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip",
                     "Unknown", "Unknown"]
    v = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int").select(C.vendor_name("v").alias("n"))
    assert [r.n for r in v.collect()] == ["Creative Mobile Technologies, LLC", "VeriFone Inc.",
                                          "Unknown Vendor", "Unknown Vendor"]


def test_event_time_strings(spark):
    df = spark.createDataFrame([("2025-10-01 00:10:01",), ("2025-10-01 00:10",), ("",), (None,)], "s string")
    got = [r.t for r in df.select(C.parse_event_time("s").alias("t")).collect()]
    assert got[0] == dt.datetime(2025, 10, 1, 0, 10, 1) and got[1:] == [None, None, None]


# ----------------------------------------------------------------- joins / revenue
def test_lookup_join_keeps_unmatched(spark):
    fact = spark.createDataFrame([(1,), (9,)], "payment_type long")
    lk = domain.payment_lookup(spark)
    out = joins.lookup_join(fact, lk, fact["payment_type"] == lk["payment_type_id"], "left")
    assert rows(out.select("payment_type", "payment_type_name")) == sorted([(1, "credit_card"), (9, None)], key=repr)
    from plan_text import plan_of

    assert "BroadcastHashJoin" in plan_of(out)


def test_revenue_null_semantics(spark):
    df = spark.createDataFrame(
        [(T0, "green", None, None, None, None), (T0, "green", None, None, None, None), (None, "green", 1.0, 1.0, 1.0, 1.0)],
        "pickup_datetime timestamp, service_type string, total_amount double, fare_amount double, "
        "tip_amount double, tolls_amount double",
    )
    m = revenue.monthly_revenue_service(df).collect()
    one = [r for r in m if r.revenue_month is not None][0]
    assert one.trips == 2 and one.revenue_total == 0.0  # nulls count as 0
    h = revenue.hourly_revenue(df, "pickup_datetime", "service_type", since=None).collect()
    assert [r.amount for r in h if r.hour is not None] == [None]  # plain SQL sum skips nulls


def test_by_service_equals_outer_join(spark, sf_small):
    a = trips.hourly_revenue_outer_zones(spark, sf_small)
    b = trips.hourly_revenue_full_join(spark, sf_small)
    assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(b.columns)))


# ----------------------------------------------------------------- unions / drift
def test_positional_union_refuses_other_layout(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1)], "b string, a int")
    with pytest.raises(ValueError):
        unions.union_positional(a, b)
    assert unions.union_by_name(a, b).count() == 2


def test_widest_schema():
    from pyspark.sql import types as T

    s1 = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("pc", T.IntegerType()),
                       T.StructField("d", T.DateType())])
    s2 = T.StructType([T.StructField("id", T.LongType()), T.StructField("pc", T.DoubleType()),
                       T.StructField("d", T.TimestampType()), T.StructField("x", T.StringType())])
    w = files.widest_schema([s1, s2])
    assert [f.dataType for f in w.fields] == [T.LongType(), T.DoubleType(), T.TimestampType(), T.StringType()]


def test_drifting_files_union_by_name(spark, tmp_dir):
    a = spark.createDataFrame([(1, 2)], "id int, passenger_count int")
    b = spark.createDataFrame([(2, 1.5, 0.0)], "id long, passenger_count double, ehail_fee double")
    a.write.parquet(f"{tmp_dir}/a")
    b.write.parquet(f"{tmp_dir}/b")
    out = files.read_union_by_name(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"])
    assert dict(out.dtypes) == {"id": "bigint", "passenger_count": "double", "ehail_fee": "double"}
    assert rows(out) == sorted([(1, 2.0, None), (2, 1.5, 0.0)], key=repr)
    w = files.read_widened(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"])
    assert dict(w.dtypes)["id"] == "bigint" and w.count() == 2


def test_col_or_null_and_stage(spark):
    green = spark.createDataFrame([(1, T0)], "VendorID int, lpep_pickup_datetime timestamp")
    out = normalize.stage(green, "green")
    assert out.columns == [n for n, _ in normalize.STAGED_COLUMNS]
    r = out.collect()[0]
    assert r.vendor_id == 1 and r.pickup_datetime == T0 and r.fare_amount is None


# ----------------------------------------------------------------- months
def test_month_starts_edges():
    d = dt.date
    assert files.month_starts(d(2024, 1, 15), d(2024, 3, 1), today=d(2026, 1, 1)) == [d(2024, 1, 1), d(2024, 2, 1),
                                                                                      d(2024, 3, 1)]
    assert files.month_starts(d(2025, 11, 1), d(2026, 2, 1), today=d(2025, 12, 5)) == [d(2025, 11, 1)]
    assert files.month_starts(d(2020, 12, 1), d(2021, 2, 1), max_year=2020, today=d(2026, 1, 1)) == [d(2020, 12, 1)]
    with pytest.raises(ValueError):
        files.month_starts(d(2024, 2, 1), d(2024, 1, 1))


def test_month_range_missing_and_empty(spark, tmp_dir):
    df = spark.createDataFrame([(2024, 1, 1), (2024, 3, 3)], "year int, month int, v int")
    base = f"{tmp_dir}/months"
    df.write.partitionBy("year", "month").parquet(base)
    got = files.read_month_range(spark, base, dt.date(2024, 1, 1), dt.date(2024, 3, 31), today=dt.date(2026, 1, 1))
    assert sorted(r.v for r in got.collect()) == [1, 3]
    none = files.read_month_range(spark, base, dt.date(2026, 1, 1), dt.date(2026, 3, 1), today=dt.date(2026, 1, 2))
    assert none.count() == 0 and "v" in none.columns


# ----------------------------------------------------------------- tags
def test_explode_tags_edges(spark):
    df = spark.createDataFrame([(1, "a|b"), (2, "a"), (3, ""), (4, "a||b"), (5, None)], "id long, tags string")
    got = rows(tags.explode_tags(df))
    assert got == sorted([(1, "a"), (1, "b"), (2, "a"), (3, ""), (4, "a"), (4, ""), (4, "b")], key=repr)


def test_tag_month_equals_join_then_aggregate(spark):
    q = spark.createDataFrame(
        [(1, T0, 1.0, 10.0), (1, T0, 2.0, 11.0), (2, T0, None, 3.0), (1, dt.datetime(2025, 11, 2), 5.0, 5.0)],
        "id long, creation_date timestamp, score double, view_count double",
    )
    t = tags.explode_tags(spark.createDataFrame([(1, "x|y"), (2, "x")], "id long, tags string"))
    got = {(r.month, r.tag): (r.question_count, r.avg_score, r.avg_views) for r in tags.tag_month(q, t).collect()}
    m10 = dt.date(2025, 10, 1)
    assert got[(m10, "x")] == (3, 1.5, 8.0)  # null score skipped by the average
    assert got[(m10, "y")] == (2, 1.5, 10.5)


def test_top_tags_unweighted_and_ties(spark):
    fact = spark.createDataFrame(
        [(dt.date(2025, 1, 1), "b", 10, 1.0), (dt.date(2025, 2, 1), "b", 1, 3.0), (dt.date(2025, 1, 1), "a", 11, 0.0)],
        "month date, tag string, question_count long, avg_score double",
    )
    got = [(r.tag, r.total_questions, r.avg_score) for r in tags.top_tags(fact, n=1).collect()]
    assert got == [("a", 11, 0.0)]  # tie at 11, tag breaks it
    got2 = {r.tag: r.avg_score for r in tags.top_tags(fact).collect()}
    assert got2["b"] == 2.0  # average of averages, not weighted


# ----------------------------------------------------------------- quality
def test_quality_checks(spark):
    df = spark.createDataFrame([(None, 1.0), (1, -1.0), (1, 0.0), (None, 2.0), (2, None)], "id int, fare double")
    rep = {(r.column_name, r.check_name): r.failures for r in quality.report(
        quality.column_checks(df, {"id": ["not_null"], "fare": ["non_negative", "positive"]}),
        quality.unique_check(df, ["id"]),
    ).collect()}
    assert rep == {("id", "not_null"): 2, ("fare", "non_negative"): 1, ("fare", "positive"): 2, ("id", "unique"): 1}


def test_single_pass_checks_equal_separate_checks(spark):
    df = spark.createDataFrame([(None, 1.0), (1, -1.0), (1, 0.0), (None, 2.0), (2, None), (None, None)],
                               "id int, fare double")
    rules = {"id": ["not_null"], "fare": ["non_negative", "positive", "not_null"]}
    one = quality.checks_with_unique(df, rules, ["id"]).collect()
    two = quality.report(quality.column_checks(df, rules), quality.unique_check(df, ["id"])).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_custom_check_and_exists(spark):
    empty = spark.createDataFrame([], "x int")
    r = quality.custom_check("has_rows", quality.exists_indicator(empty), 1).collect()[0]
    assert (r.actual, r.passed) == (0, False)


def test_missing_periods(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 4),)], "t timestamp")
    got = sorted(r.period for r in quality.missing_periods(df, "t").collect())
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(1, 2)], "a long, c int")
    got = {r.column_name: (r.left_type, r.right_type, r.same) for r in quality.schema_diff(a, b).collect()}
    assert got == {"a": ("int", "bigint", False), "b": ("string", None, False), "c": (None, "int", False)}


def test_defensive_projection_tolerates_text(spark):
    """ANSI mode is on: text that does not parse becomes null instead of
    failing the query (``try_cast`` in the defensive projection)."""
    raw = spark.createDataFrame(
        [("2024-01-01 00:00:00", "abc", "7", "1.5"), ("not a time", "3", "x", None)],
        "tpep_pickup_datetime string, PULocationID string, passenger_count string, fare_amount string",
    )
    out = normalize.project_present(raw, normalize.MINIMAL_TRIP, t="tpep").collect()
    assert out[0].pickup_location_id is None and out[0].passenger_count == 7 and out[0].fare_amount == 1.5
    assert out[1].pickup_datetime is None and out[1].pickup_location_id == 3 and out[1].tolls_amount is None


def test_keep_one_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 3) | st.none(),
                    st.sampled_from(["a", "b", "", None]))

    @settings(max_examples=12, deadline=None)
    @given(st.lists(row, min_size=1, max_size=12))
    def check(rows_):
        df = spark.createDataFrame(rows_, "k int, o int, v string")
        assert rows(dedupe.keep_one(df, ["k"], ["o"])) == rows(keep_one_window(df, ["k"], ["o"]))

    check()


def test_excess_rows_nested_equals_distinct(spark):
    df = spark.createDataFrame(
        [(1, 1, 1.0), (1, 1, 1.0), (1, 1, 2.0), (1, None, 2.0), (1, None, 2.0), (2, 3, None)],
        "a int, b int, c double",
    )
    nested = dedupe.excess_rows(df, {"wide": ["a", "b", "c"], "mid": ["a", "b"], "narrow": ["a"]}).collect()[0]
    flat = dedupe.excess_rows(df, {"wide": ["a", "b", "c"], "other": ["c"]}).collect()[0]  # not nested
    assert (nested.wide, nested.mid, nested.narrow) == (2, 3, 4)
    assert (flat.wide, flat.other) == (2, 3)


def test_trip_id_large_double_text(spark):
    """A distance of 1e7 is hashed as decimal text (10000000.00), not as the
    engine's float text (1.0E7)."""
    import hashlib

    df = spark.createDataFrame([(1e7,)], "trip_distance double")
    got = df.select(C.surrogate_key([F.col("trip_distance").cast("decimal(18,2)")]).alias("k")).collect()[0].k
    assert got == hashlib.md5(b"10000000.00").hexdigest()


def test_half_open_range_edges(spark):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(start,), (end,), (end - dt.timedelta(microseconds=1),), (None,)], "t timestamp")
    got = sorted(r.t for r in revenue.between_filter(df, "t", start, end).collect())
    assert got == [start, end - dt.timedelta(microseconds=1)]  # start kept, end excluded, null dropped


def test_checks_come_with_the_write(spark, tmp_dir):
    from farebox.operators import quality

    rules = {"a": ["not_null", "positive"], "b": ["non_negative"]}
    seen = spark.sparkContext.accumulator(0)

    def touch(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    df = spark.createDataFrame([(1, -1.0), (None, 2.0), (0, None), (-3, -2.0)], "a int, b double")
    counted = df.mapInPandas(touch, df.schema)
    report = quality.observed_write(counted, rules, lambda x: x.write.parquet(f"{tmp_dir}/t"), "t")
    assert sorted((r.column_name, r.check_name, r.failures, r.passed) for r in report.collect()) == [("a", "not_null", 1, False), ("a", "positive", 2, False), ("b", "non_negative", 2, False)]
    assert seen.value == 4 and spark.read.parquet(f"{tmp_dir}/t").count() == 4  # the rows were computed once
    empty = quality.observed_write(df.limit(0), rules, lambda x: x.write.parquet(f"{tmp_dir}/e"), "t")
    assert all(r.passed for r in empty.collect())


def test_seed_checks_find_bad_rows(spark, tmp_dir):
    from farebox.operators import quality
    from farebox.schemas import PAYMENT_LOOKUP_SCHEMA
    from farebox.sources import files

    files.write_csv(spark.createDataFrame([(1, "cash"), (1, "card"), (None, "x"), (3, None)], PAYMENT_LOOKUP_SCHEMA), f"{tmp_dir}/s", gzip=False)
    seed = files.load_seed(spark, f"{tmp_dir}/s", PAYMENT_LOOKUP_SCHEMA)
    report = quality.checks_with_unique(seed, {"payment_type_id": ["not_null"], "payment_type_name": ["not_null"]}, ["payment_type_id"])
    assert {(r.column_name, r.check_name): r.failures for r in report.collect()} == {("payment_type_id", "not_null"): 1, ("payment_type_name", "not_null"): 1, ("payment_type_id", "unique"): 1}


def test_model_is_loaded_once_a_task(spark):
    from farebox.operators import scoring

    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return lambda pdf: pdf["x"] + 0.5

    df = spark.range(50_000, numPartitions=2).selectExpr("cast(id as double) as x")
    out = scoring.score_partitions(df, load, ["x"], "y")
    assert out.where("y <> x + 0.5").count() == 0 and loads.value == 2


def test_keep_one_coded_equals_the_window(spark):
    rnd = random.Random(5)
    def pick(*xs):
        return rnd.choice(xs)

    data = [(pick(1, 2, None), pick(1.5, -0.5, None, 2.0), pick(None, 3, 4), pick("a", "B", "é", None), pick("x", None, "")) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, o double, p int, s string, t string")
    few = {c: dedupe.few_values(df, c) for c in ("s", "t")}
    assert sorted(few["s"]) == ["B", "a", "é"] and dedupe.few_values(df, "s", most=2) is None
    want = rows(keep_one_window(df, ["k"], ["o", "p", "s", "t"]))
    assert rows(dedupe.keep_one_coded(df, ["k"], ["o", "p", "s", "t"], few)) == want
    assert rows(dedupe.keep_one_coded(df, ["k"], ["o", "p", "s", "t"], few, most=3)) == want  # too many names: falls back
    assert rows(dedupe.keep_one_coded(df, ["k"], ["o", "p", "s", "t"], {"s": None, "t": few["t"]})) == want
    assert rows(dedupe.keep_one_coded(df.limit(0), ["k"], ["o", "p", "s", "t"], {"s": [], "t": []})) == []
    plan = dedupe.keep_one_coded(df, ["k"], ["o", "p", "s", "t"], few)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    one = dedupe.keep_one_coded(df.drop("o", "p"), ["k"], ["s", "t"], few)
    assert rows(one) == rows(keep_one_window(df.drop("o", "p"), ["k"], ["s", "t"]))
