"""Quality, scalar-function and scoring queries over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import records
from farebox.operators import dedupe, quality, revenue, scoring
from farebox.plans import domain, trips
from farebox.sources import files
from farebox.tables import load, to_ntz


def _staged_a(spark, sf_dir):
    return trips.staging_trips(trips.ingested(spark, sf_dir), domain.payment_lookup(spark), variant="A",
                               lookup_rows=domain.PAYMENT_LOOKUP_SIZE)


STAGING_RULES = {
    "pickup_datetime": ["not_null"],
    "dropoff_datetime": ["not_null"],
    "fare_amount": ["non_negative", "positive"],
    "taxi_type": ["not_null"],
    "payment_type_name": ["not_null"],
}


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1–Q4, Q11: column checks of staging (one pass) plus the uniqueness of
    the variant-Z trip key, which variant A's output does not guarantee.
    All rules run in one pass over staging (see ``checks_with_unique``)."""
    return quality.checks_with_unique(_staged_a(spark, sf_dir), STAGING_RULES, trips.KEY_Z, "staging_trips")


def custom_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5–Q7 + A17: duplicate count on staging (expected 0) and non-empty
    report between two dates inclusive (expected 1)."""
    staged = _staged_a(spark, sf_dir)
    key = ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount"]  # variant A's check
    dup = dedupe.excess_rows(staged, {"v": key})
    report = trips.daily_report(spark, sf_dir)
    in_range = report.filter(F.col("trip_date").between(F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date")))
    # Variant Z's check: its own dedupe key, bounded to the run interval.
    z_run = trips.staging_trips(trips.ingested(spark, sf_dir), domain.payment_lookup(spark), "1998-01-01 00:00:00",
                                "1999-01-01 00:00:00", variant="Z", lookup_rows=domain.PAYMENT_LOOKUP_SIZE)
    dup_z = dedupe.excess_rows(z_run, {"v": trips.KEY_Z})
    return quality.report(
        quality.custom_check("no_duplicate_trips", dup, 0),
        quality.custom_check("no_duplicate_trips_z", dup_z, 0),
        quality.custom_check("has_report_data", quality.exists_indicator(in_range), 1),
    )


def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 + J7: ship days with no line between the first and last one."""
    li = load(spark, sf_dir, "lineitem")
    return quality.missing_periods(li, "l_shipdate", "day")


def null_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_tally(trips.ingested(spark, sf_dir))


def predict_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    green, _ = trips.sources(spark, sf_dir)
    return to_ntz(scoring.score_partitions(green))


def rdd_hourly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    green, _ = trips.sources(spark, sf_dir)
    return to_ntz(scoring.keyed_revenue(green, "lpep_pickup_datetime", "PULocationID", "total_amount",
                                        trips.REPORT_SINCE))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """decode the JSON payload column."""
    ev = load(spark, sf_dir, "events")
    schema = "k INT"
    return ev.select("event_id", F.from_json("props", schema).alias("p")).select("event_id", "p.k")


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F19 + F21: rows -> ride records -> JSON message values."""
    _, yellow = trips.sources(spark, sf_dir)
    return records.encode(records.ride_record(yellow))


def epoch_ms_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 then F5: timestamp -> epoch ms -> timestamp (millisecond precision)."""
    ev = load(spark, sf_dir, "events")
    ms = F.unix_millis("ts")
    return to_ntz(ev.select("event_id", ms.alias("epoch_ms"), F.timestamp_millis(ms).alias("event_time")))


def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P17 + A2: an IN list filter and a group count."""
    ev = load(spark, sf_dir, "events")
    return ev.filter(F.col("event_type").isin("click", "purchase", "signup")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def range_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column subset of the questions in ``[1996-01-01, 2000-01-01)``
    (the range is the operator; filter and projection reach the scan)."""

    q = domain.questions(load(spark, sf_dir, "lineitem"))
    return to_ntz(files.range_extract(q, ["part_id", "creation_date", "score", "view_count"], "creation_date",
                                      "1996-01-01 00:00:00", "2000-01-01 00:00:00"))


def formatted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one readable line per ride, money with 2 decimals."""
    ev = load(spark, sf_dir, "events")
    rides = ev.select(
        F.col("ts").alias("pickup_time"),
        (F.col("user_id") % 25).alias("PULocationID"),
        ((F.col("user_id") + F.col("event_id")) % 25).alias("DOLocationID"),
        ((F.col("event_id") % 40).cast("double") * F.lit(0.25)).alias("trip_distance"),
        F.col("value").alias("total_amount"),
    )
    return records.format_line(rides)


SOURCE_RULES = {
    "l_orderkey": ["not_null"],
    "l_partkey": ["not_null"],
    "l_shipdate": ["not_null"],
    "l_quantity": ["non_negative", "positive"],
    "l_extendedprice": ["non_negative"],
}


def source_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 + Q2: checks on a source scan (lineitem as landed), including the
    uniqueness of its (order, line) key, in one pass."""
    li = load(spark, sf_dir, "lineitem")
    return quality.checks_with_unique(li, SOURCE_RULES, ["l_orderkey", "l_linenumber"], "lineitem")
