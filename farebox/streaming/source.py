"""Stream sources (S25–S29, ST1–ST2, ST13, K18).

Jobs take a stream of message values (a ``value`` column of JSON text), so
the transformation code does not depend on the connector:

* production: ``kafka_stream(spark, kafka_options(...))`` – needs the Kafka
  connector on the cluster classpath (it is not bundled with PySpark);
* tests and the benchmark: ``file_messages`` – a file stream over Parquet
  files whose rows are turned into the same JSON messages a producer sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions import records


def kafka_options(bootstrap: str, topic: str, starting: str = "earliest", **extra) -> dict:
    """S25 / S26 / ST13: reader options; ``starting`` is earliest or latest.
    Offsets are kept in the query checkpoint, not in a consumer group."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, options: dict) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load().select(
        F.col("value").cast("string").alias("value")
    )


def kafka_batch(spark: SparkSession, options: dict) -> DataFrame:
    """Bounded read from the start offsets to the latest ones."""
    opts = {**options, "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**opts).load().select(F.col("value").cast("string").alias("value"))


def kafka_sink_options(bootstrap: str, topic: str, checkpoint: str) -> dict:
    """Writer options for ``writeStream.format('kafka')``."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "checkpointLocation": checkpoint}


def file_stream(spark: SparkSession, glob: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A Parquet file stream.  A glob is used (a single-file path is refused
    by the file source); ``max_files`` bounds each micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(glob)


# ----------------------------------------------------------- producers
def ride_messages(events: DataFrame) -> DataFrame:
    """Events -> ``rides`` messages (epoch-ms pickup time, 5 fields)."""
    rides = events.select(
        (F.col("user_id") % 25).cast("int").alias("PULocationID"),
        ((F.col("user_id") + F.col("event_id")) % 25).cast("int").alias("DOLocationID"),
        ((F.col("event_id") % 40).cast("double") * F.lit(0.25)).alias("trip_distance"),
        F.col("value").alias("total_amount"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("tpep_pickup_datetime"),
    )
    return records.encode(rides)


def green_trip_fields(zone: Column | None = None) -> list:
    """The 8 ``green-trips`` fields computed from an events row; ``zone``
    replaces the pickup zone."""
    ts = F.col("ts").cast("timestamp")
    return [
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("lpep_pickup_datetime"),
        F.date_format(F.timestamp_add("SECOND", F.col("event_id") % 1800, ts), "yyyy-MM-dd HH:mm:ss").alias(
            "lpep_dropoff_datetime"
        ),
        (zone if zone is not None else (F.col("user_id") % 25).cast("int")).alias("PULocationID"),
        ((F.col("user_id") + F.col("event_id")) % 25).cast("int").alias("DOLocationID"),
        (F.col("user_id") % 4).cast("double").alias("passenger_count"),
        ((F.col("event_id") % 40).cast("double") * F.lit(0.25)).alias("trip_distance"),
        ((F.col("event_id") % 5).cast("double") * F.lit(0.25)).alias("tip_amount"),
        F.col("value").alias("total_amount"),
    ]


def green_trip_messages(events: DataFrame, zone: Column | None = None) -> DataFrame:
    """Events -> ``green-trips`` messages (text times, 8 fields)."""
    return records.encode(events.select(*green_trip_fields(zone)))


# ----------------------------------------------------------- consumers (ST1, ST2)
def rides_from_messages(messages: DataFrame, strict: bool = True) -> DataFrame:
    """S29 / ST1: decode ``rides``; event time from epoch milliseconds."""
    r = messages.select(records.decode(F.col("value"), records.RIDE_SCHEMA, strict=strict).alias("r")).select("r.*")
    return r.withColumn("event_time", F.timestamp_millis(F.col("tpep_pickup_datetime")))


def green_trips_from_messages(messages: DataFrame, tolerant: bool = True) -> DataFrame:
    """S28 / ST2: decode ``green-trips`` dropping unreadable records; event time
    parsed from text (a bad or empty time gives null and the row is dropped)."""
    if tolerant:
        r = records.decode_tolerant(messages, records.GREEN_TRIP_SCHEMA)
    else:
        r = messages.select(records.decode(F.col("value"), records.GREEN_TRIP_SCHEMA, strict=True).alias("r")).select(
            "r.*"
        )
    r = r.withColumn("event_time", F.try_to_timestamp(F.col("lpep_pickup_datetime"), F.lit("yyyy-MM-dd HH:mm:ss")))
    return r.filter(F.col("event_time").isNotNull())
