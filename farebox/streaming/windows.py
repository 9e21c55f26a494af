"""Windowed stream aggregates (ST3–ST7, ST10, ST11, ST14).

All windowed jobs use a bounded-out-of-orderness watermark (5 s by default):
a window is emitted once, in append mode, when the watermark passes its end,
and rows behind the watermark are dropped by the stateful operator.  State
is keyed by (window, key) and spread over ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WATERMARK = "5 seconds"


def _flatten(df: DataFrame, wcol: str = "w") -> DataFrame:
    rest = [c for c in df.columns if c != wcol]
    return df.select(F.col(f"{wcol}.start").alias("window_start"), F.col(f"{wcol}.end").alias("window_end"), *rest)


def tumble_zone_revenue(rides: DataFrame, size: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """ST4: per zone and tumbling window: trips and revenue."""
    agg = (
        rides.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size).alias("w"), "PULocationID")
        .agg(F.count(F.lit(1)).alias("num_trips"), F.round(F.sum("total_amount"), 2).alias("total_revenue"))
    )
    return _flatten(agg)


def tumble_zone_count(trips: DataFrame, size: str = "5 minutes", delay: str = WATERMARK) -> DataFrame:
    """ST5: per zone and 5-minute window: trips."""
    agg = (
        trips.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size).alias("w"), "PULocationID")
        .agg(F.count(F.lit(1)).alias("num_trips"))
    )
    return _flatten(agg)


def tumble_total_tip(trips: DataFrame, size: str = "1 hour", delay: str = WATERMARK) -> DataFrame:
    """ST6: no key: tip sum per hourly window (start and end)."""
    agg = (
        trips.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", size).alias("w"))
        .agg(F.round(F.sum("tip_amount"), 2).alias("total_tip"))
    )
    return _flatten(agg)


def session_by_zone(trips: DataFrame, gap: str = "5 minutes", delay: str = WATERMARK) -> DataFrame:
    """ST7: gap sessions per zone (append mode only)."""
    agg = (
        trips.withWatermark("event_time", delay)
        .groupBy(F.session_window("event_time", gap).alias("w"), "PULocationID")
        .agg(F.count(F.lit(1)).alias("num_trips"))
    )
    return agg.select("PULocationID", F.col("w.start").alias("session_start"),
                      F.col("w.end").alias("session_end"), "num_trips")


def running_counters(trips: DataFrame, col: str = "trip_distance", threshold: float = 5.0) -> DataFrame:
    """ST14: running total and count over a threshold (complete mode)."""
    v = F.col(col).cast("double")
    return trips.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(v.isNotNull() & (v > F.lit(threshold))).alias("over_threshold"),
    )


def passthrough(rides: DataFrame) -> DataFrame:
    """ST9: stateless projection with the time conversion."""
    return rides.select("PULocationID", "DOLocationID", "trip_distance", "total_amount",
                        F.col("event_time").alias("pickup_datetime"))
