"""Streaming models over the benchmark events.

Each query runs a real Structured Streaming job: a file stream over the
events Parquet is turned into JSON messages (the producer side), decoded
(the consumer side), windowed with a 5 s watermark and written to a
checkpointed sink in the cluster's shared folder with an ``availableNow``
trigger.  The returned DataFrame reads the sink back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import prepare, shared_dir
from farebox.streaming import chains, sinks, source
from farebox.streaming import windows as sw
from farebox.tables import load, table_path, to_ntz


# No limit on the files of a micro-batch: cut by file order, a back-fill would
# move the watermark past rows of files that come later, and lose them.
def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    sinks.prepare_state_store(spark)
    path = table_path(sf_dir, "events")
    schema = spark.read.parquet(path).schema
    # A glob, not the file path: the file source lists a pattern.
    return source.file_stream(spark, path.replace("events.parquet", "events*.parquet"), schema)


def _run_append(spark: SparkSession, df: DataFrame, name: str, mode: str = "append", state_partitions: int | None = None) -> DataFrame:
    out = shared_dir(spark, "streams", name)
    q = sinks.start_file_sink(df, f"{out}/data", f"{out}/checkpoint", mode=mode, state_partitions=state_partitions)
    q.awaitTermination()
    return to_ntz(spark.read.parquet(f"{out}/data"))


def _rides(spark, sf_dir):
    return source.rides_from_messages(source.ride_messages(_events_stream(spark, sf_dir)))


def _green(spark, sf_dir):
    return source.green_trips_from_messages(source.green_trip_messages(_events_stream(spark, sf_dir)))


def stream_tumble_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_append(spark, sw.tumble_zone_revenue(_rides(spark, sf_dir)), "tumble_zone")


def stream_tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_append(spark, sw.tumble_zone_count(_green(spark, sf_dir)), "tumble_count")


def stream_tumble_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_append(spark, sw.tumble_total_tip(_green(spark, sf_dir)), "tumble_total")


def stream_session_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_append(spark, sw.session_by_zone(_green(spark, sf_dir), gap="60 minutes"), "session_keyed")


def stream_session_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST8: forty zones, fifteen of them in no zone table, and every eleventh
    trip without a zone."""
    zone = F.when(F.col("event_id") % 11 != 0, (F.col("user_id") % 40).cast("int"))
    messages = source.green_trip_messages(_events_stream(spark, sf_dir), zone)
    # The chain is one key: more state partitions would stand empty.
    return _run_append(spark, chains.session_global(source.green_trips_from_messages(messages)), "session_global", state_partitions=1)


def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_append(spark, sw.passthrough(_rides(spark, sf_dir)), "passthrough")


def stream_json_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 7th message is malformed JSON; unreadable records are
    dropped, the others pass with their parsed event time."""
    ev = _events_stream(spark, sf_dir)
    value = F.when(F.col("event_id") % 7 == 0, F.lit("{bad")).otherwise(
        F.to_json(F.struct(*source.green_trip_fields()))
    )
    trips = source.green_trips_from_messages(ev.select(value.alias("value")))
    return _run_append(spark, trips.select("PULocationID", "total_amount", "event_time"), "json_tolerant")


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST14: running counters in complete mode.  File sinks accept append
    only, so each complete snapshot replaces the previous one through the
    keyed upsert sink (one constant key)."""
    out = shared_dir(spark, "streams", "counters")
    agg = sw.running_counters(_green(spark, sf_dir)).withColumn("k", F.lit(0))
    sink = sinks.UpsertSink(f"{out}/table", ["k"], buckets=1)
    q = sinks.start_foreach_batch(agg, sink, f"{out}/checkpoint", mode="complete")
    q.awaitTermination()
    return sink.read(spark).drop("k")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly zone revenue kept per (window, zone) in an upsert table
    (update mode: a window row is rewritten as it changes)."""
    out = shared_dir(spark, "streams", "upsert")
    agg = sw.tumble_zone_revenue(_rides(spark, sf_dir))
    sink = sinks.UpsertSink(f"{out}/table", ["window_start", "PULocationID"], time_key="window_start", unit="day")
    q = sinks.start_foreach_batch(agg, sink, f"{out}/checkpoint", mode="update")
    q.awaitTermination()
    return to_ntz(sink.read(spark))
