"""Windowed models over the benchmark events (batch twins of the streaming
jobs): tumbling windows and gap sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import sessions
from farebox.tables import load, to_ntz

# Session gaps: the modelled jobs use 5 minutes.  Keyed sessions on the
# benchmark use 60 minutes, so that per-zone chains are not all singletons.
GLOBAL_GAP = "5 minutes"
KEYED_GAP = "60 minutes"


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride events: pickup time, zone, amount, tip (both services)."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("event_time"),
        (F.col("user_id") % 25).cast("int").alias("PULocationID"),
        F.col("value").alias("total_amount"),
        ((F.col("event_id") % 5).cast("double") * F.lit(0.25)).alias("tip_amount"),
    )


def tumble_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4 batch twin: 1-hour windows per zone, trip count and revenue."""
    return to_ntz(sessions.tumbling(
        rides(spark, sf_dir), "event_time", "1 hour", ["PULocationID"],
        [F.count(F.lit(1)).alias("num_trips"), F.round(F.sum("total_amount"), 2).alias("total_revenue")],
    ))


def tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 batch twin: 5-minute windows per zone, trip count."""
    return to_ntz(sessions.tumbling(rides(spark, sf_dir), "event_time", "5 minutes", ["PULocationID"],
                                    [F.count(F.lit(1)).alias("num_trips")]))


def tumble_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 batch twin: 1-hour windows, no key, tip sum."""
    return to_ntz(sessions.tumbling(rides(spark, sf_dir), "event_time", "1 hour", [],
                                    [F.round(F.sum("tip_amount"), 2).alias("total_tip")]))


def session_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 batch twin: sessions per zone."""
    return to_ntz(sessions.sessions(rides(spark, sf_dir), "event_time", KEYED_GAP, keys=["PULocationID"]))


def session_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8 batch twin: one session chain over all rides, counted per zone."""
    return to_ntz(sessions.sessions(rides(spark, sf_dir), "event_time", GLOBAL_GAP, count_by=["PULocationID"]))
