"""How the benchmark tables play the trip and question domains.

* ``events``   -> green and yellow raw trips (two source schemas that differ in
                 column names and types, as the two taxi services do).
* ``lineitem`` -> ingested raw trips with duplicates (asset pipeline input),
                 and question activity (month, score, views) for the tag marts.
* ``part``     -> tag lists: ``p_name`` words joined by ``|``.
* ``nation``   -> zones (``n_nationkey`` is the location id, 25 rows).

Every column is a deterministic built-in expression of the source row, so the
same mapping is written once more in DuckDB SQL (``farebox.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.columns import PAYMENT_LOOKUP_ROWS

GREEN_EVENT_TYPES = ("click", "view", "signup")
ZONES = 25
# Digits of finished money sums in the registered reports, so that two engines
# that add in different orders print the same value.  Averages are plain.
SUM_DIGITS = 2


def _is_green(c="event_type"):
    return F.col(c).isin(*GREEN_EVENT_TYPES)


def _event_trip_columns(prefix: str) -> dict:
    eid, uid, val = F.col("event_id"), F.col("user_id"), F.col("value")
    return {
        "VendorID": (uid % 3).cast("int"),
        f"{prefix}_pickup_datetime": F.col("ts"),
        f"{prefix}_dropoff_datetime": F.timestamp_add("SECOND", eid % 1800, F.col("ts")),
        "store_and_fwd_flag": F.when(eid % 10 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "RatecodeID": F.lit(1).cast("int"),
        "PULocationID": uid % ZONES,
        "DOLocationID": (uid + eid) % ZONES,
        "passenger_count": (uid % 4).cast("int"),
        "trip_distance": (eid % 40).cast("double") * F.lit(0.25),
        "fare_amount": val,
        "extra": (eid % 3).cast("double") * F.lit(0.5),
        "mta_tax": F.lit(0.5),
        "tip_amount": (eid % 5).cast("double") * F.lit(0.25),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(0.3),
        "total_amount": val,
        "payment_type": (eid % 8).cast("int"),
        "congestion_surcharge": F.when(uid % 2 == 0, F.lit(2.5)).otherwise(F.lit(0.0)),
    }


GREEN_COLUMNS = [
    "VendorID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "store_and_fwd_flag",
    "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "trip_distance",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type",
    "congestion_surcharge",
]
YELLOW_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
]


def green_raw(events: DataFrame) -> DataFrame:
    """Green-service raw trips (20 columns, ``lpep_*`` times, bigint zones)."""
    cols = _event_trip_columns("lpep")
    cols["ehail_fee"] = F.lit(None).cast("double")
    cols["trip_type"] = (F.col("event_id") % 2 + 1).cast("int")
    return events.filter(_is_green()).select(*[cols[c].alias(c) for c in GREEN_COLUMNS])


def yellow_raw(events: DataFrame) -> DataFrame:
    """Yellow-service raw trips (18 columns, ``tpep_*`` times).  Its types drift
    from green: zones are int, passenger_count is double."""
    cols = _event_trip_columns("tpep")
    cols["PULocationID"] = cols["PULocationID"].cast("int")
    cols["DOLocationID"] = cols["DOLocationID"].cast("int")
    cols["passenger_count"] = cols["passenger_count"].cast("double")
    return events.filter(~_is_green()).select(*[cols[c].alias(c) for c in YELLOW_COLUMNS])


def ingested_trips(lineitem: DataFrame) -> DataFrame:
    """Raw trips as the month-interval ingest lands them: both services in one
    frame, ``tpep_*`` set for yellow and ``lpep_*`` for green, duplicates on the
    trip key, some negative fares and payment code 7 that has no lookup row."""
    green = F.col("l_linestatus") == "O"
    pickup = F.col("l_shipdate")
    dropoff = F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate"))
    null_ts = F.lit(None).cast("timestamp")
    return lineitem.select(
        F.when(~green, pickup).otherwise(null_ts).alias("tpep_pickup_datetime"),
        F.when(~green, dropoff).otherwise(null_ts).alias("tpep_dropoff_datetime"),
        F.when(green, pickup).otherwise(null_ts).alias("lpep_pickup_datetime"),
        F.when(green, dropoff).otherwise(null_ts).alias("lpep_dropoff_datetime"),
        (F.col("l_suppkey") % 10).alias("PULocationID"),
        F.col("l_linenumber").cast("long").alias("DOLocationID"),
        (F.col("l_quantity") - F.lit(3.0)).alias("fare_amount"),
        (F.col("l_partkey") % 8).alias("payment_type"),
        F.when(green, F.lit("green")).otherwise(F.lit("yellow")).alias("taxi_type"),
    )


def staged_lines(lineitem: DataFrame) -> DataFrame:
    """Staged trips with repeats on the nine report columns: ship days as
    pickup times and few values in every other column."""
    line, band = F.col("l_linenumber"), F.floor(F.col("l_quantity") / 10)
    return lineitem.select(
        (F.col("l_suppkey") % 2 + 1).cast("long").alias("vendor_id"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.timestamp_add("HOUR", line, F.col("l_shipdate")).alias("dropoff_datetime"),
        (F.col("l_suppkey") % 4).cast("long").alias("pickup_location_id"),
        line.cast("long").alias("dropoff_location_id"),
        (line % 4).cast("long").alias("passenger_count"),
        (band * 0.125).cast("double").alias("trip_distance"),
        (band * 5).cast("decimal(18,2)").alias("total_amount"),
        (F.col("l_partkey") % 3).cast("long").alias("payment_type"),
    )


def questions(lineitem: DataFrame) -> DataFrame:
    """Question activity: one row per line; ``part_id`` points at its tag list."""
    return lineitem.select(
        F.col("l_partkey").alias("part_id"),
        F.col("l_shipdate").alias("creation_date"),
        F.col("l_quantity").alias("score"),
        F.floor("l_extendedprice").cast("double").alias("view_count"),
    )


def tagged_parts(part: DataFrame) -> DataFrame:
    """``(id, tags)`` with tags as a ``|``-separated list."""
    return part.select(
        F.col("p_partkey").alias("id"),
        F.regexp_replace(F.col("p_name"), " ", "|").alias("tags"),
    )


def zones(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("long").alias("LocationID"),
        F.col("n_name").alias("zone_name"),
        F.col("n_regionkey").alias("region_id"),
    )


PAYMENT_LOOKUP_SIZE = len(PAYMENT_LOOKUP_ROWS)


def payment_lookup(spark) -> DataFrame:

    return spark.createDataFrame(
        PAYMENT_LOOKUP_ROWS,
        T.StructType(
            [
                T.StructField("payment_type_id", T.LongType(), False),
                T.StructField("payment_type_name", T.StringType(), False),
            ]
        ),
    )
