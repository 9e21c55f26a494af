"""Record (JSON message) helpers: F19–F22, P20, S28–S29."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Message schemas of the two trip topics.
RIDE_SCHEMA = T.StructType(
    [
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tpep_pickup_datetime", T.LongType()),
    ]
)
GREEN_TRIP_SCHEMA = T.StructType(
    [
        T.StructField("lpep_pickup_datetime", T.StringType()),
        T.StructField("lpep_dropoff_datetime", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)


def ride_record(df: DataFrame, time_col: str = "tpep_pickup_datetime") -> DataFrame:
    """row -> typed ride record (time as epoch milliseconds)."""
    return df.select(
        F.col("PULocationID").cast("int").alias("PULocationID"),
        F.col("DOLocationID").cast("int").alias("DOLocationID"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.unix_millis(F.col(time_col)).alias("tpep_pickup_datetime"),
    )


def encode(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row -> one JSON text (the message value)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def decode(value: Column, schema: T.StructType, strict: bool = False) -> Column:
    """JSON text -> struct.  Tolerant (S28): a malformed record or field
    gives nulls.  Strict (S29): a malformed record fails the query."""
    opts = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE"}
    return F.from_json(value.cast("string"), schema, opts)


def decode_tolerant(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Decode, and drop records none of whose fields could be read."""
    parsed = df.select(decode(F.col(value_col), schema).alias("r")).select("r.*")
    any_field = F.lit(False)
    for f in schema.fields:
        any_field = any_field | F.col(f.name).isNotNull()
    return parsed.filter(any_field)


def format_line(df: DataFrame) -> DataFrame:
    """one readable line per ride with 2-decimal money."""
    return df.select(
        F.format_string(
            "%s: %d -> %d, %.2f mi, $%.2f",
            F.date_format(F.col("pickup_time"), "yyyy-MM-dd HH:mm:ss"),
            F.col("PULocationID"),
            F.col("DOLocationID"),
            F.col("trip_distance"),
            F.col("total_amount"),
        ).alias("line")
    )
