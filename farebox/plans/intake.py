"""Landing and reading back in the forms a trip archive arrives in: plain CSV,
gaps, damaged files, named views, NaN columns and late rows.

Each query writes tables of the benchmark to a fresh folder of the shared
directory and reads them with one of the library's readers.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import normalize, numbering, quality, sinks
from farebox.plans import trips
from farebox.session import shared_dir
from farebox.sources import files, rest
from farebox.streaming import progress
from farebox.streaming import sinks as stream_sinks
from farebox.streaming import source
from farebox.streaming import windows as stream_windows
from farebox.tables import load, to_ntz

CUSTOMER_TEXT = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
GAP_START, GAP_END = dt.date(1996, 3, 1), dt.date(1997, 8, 15)
#: Rows before this time with an even id arrive first, all others later.
SECOND_DELIVERY = "2024-01-16 12:00:00"


def csv_without_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with no header and no schema: text columns ``_c0``, ``_c1``, ..."""
    path = shared_dir(spark, "intake", "plain")
    files.write_csv(load(spark, sf_dir, "customer").select(*CUSTOMER_TEXT), path, header=False)
    return files.read_csv(spark, path, header=False)


def csv_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with a header, every column as text."""
    path = shared_dir(spark, "intake", "named")
    files.write_csv(load(spark, sf_dir, "customer").select(*CUSTOMER_TEXT), path)
    return files.read_csv(spark, path)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a CSV whose types Spark finds; whole numbers come as int or long by
    their size and are widened to long."""
    path = shared_dir(spark, "intake", "typed")
    files.write_csv(load(spark, sf_dir, "customer"), path)
    return normalize.apply_casts(files.read_csv(spark, path, infer=True), {"c_custkey": "long", "c_nationkey": "long"})


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with found types (numbers, text, times) converted to Parquet."""
    base = shared_dir(spark, "intake", "converted")
    files.write_csv(load(spark, sf_dir, "orders"), f"{base}/csv")
    found = files.read_csv(spark, f"{base}/csv", infer=True)
    sinks.write_table(normalize.apply_casts(found, {"o_orderkey": "long", "o_custkey": "long"}), f"{base}/parquet")
    return to_ntz(files.read_parquet(spark, f"{base}/parquet"))


def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An interval over a landing in which every third month was never
    landed: the months that are there come back, the others are skipped."""
    base = shared_dir(spark, "intake", "gaps")
    pickup = F.coalesce("tpep_pickup_datetime", "lpep_pickup_datetime")
    t = trips.ingested(spark, sf_dir).withColumn("year", F.year(pickup)).withColumn("month", F.month(pickup))
    sinks.write_table(t.where("month % 3 <> 0 or month is null"), base, partition_by=["year", "month"], cluster=True)
    return to_ntz(files.read_month_range(spark, base, GAP_START, GAP_END, max_year=2100))


def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are no Parquet lie among the Parquet files of a scan;
    the readable ones are read."""
    base = shared_dir(spark, "intake", "damaged")
    orders = load(spark, sf_dir, "orders")
    orders.write.parquet(f"{base}/good")
    orders.select("o_orderpriority").write.text(f"{base}/bad")
    return to_ntz(files.read_parquet(spark, [f"{base}/good", f"{base}/bad"], orders.schema, ignore_corrupt=True))


def named_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S19 + S20 + K10: a view over a Parquet glob, used by its name in SQL."""
    base = shared_dir(spark, "intake", "view")
    load(spark, sf_dir, "orders").write.parquet(base)
    files.external_view(spark, "archived_orders", f"{base}/*.parquet")
    return spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM archived_orders GROUP BY ALL")


def nan_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: NaN made null in every floating column before the plain averages;
    the values are finer than a cent."""
    events = load(spark, sf_dir, "events")
    dirty = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("event_id") % 64 / 64)
    clean = normalize.nan_to_null_all(events.select("event_type", dirty.alias("share")))
    return clean.groupBy("event_type").agg(F.count("share").alias("n"), F.avg("share").alias("avg_share"), F.max("share").alias("max_share"))


def days_without_bulk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 + J7: days between the first and the last line of 50 pieces on which
    no such line was shipped."""
    return quality.missing_periods(load(spark, sf_dir, "lineitem").where("l_quantity >= 50"), "l_shipdate", "day")


def _two_deliveries(spark: SparkSession, sf_dir: str, out: str) -> list[Counter]:
    """A windowed count over two deliveries, the second continuing from the
    first one's checkpoint; what each run did, from its progress events."""
    stream_sinks.prepare_state_store(spark)
    rides = load(spark, sf_dir, "events").select(
        (F.col("user_id") % 25).cast("int").alias("PULocationID"),
        F.date_trunc("second", "ts").alias("event_time"),
        F.coalesce((F.col("event_id") % 2 == 0) & (F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp")), F.lit(False)).alias("first"),
    )
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    runs = []
    try:
        for delivery in (F.col("first"), ~F.col("first")):
            rides.where(delivery).drop("first").write.mode("append").parquet(f"{out}/in")
            stream = source.file_stream(spark, f"{out}/in", rides.drop("first").schema)
            checked = stream.observe("checks", F.count_if(F.col("event_time").isNull()).alias("untimed"), F.count_if(F.col("PULocationID") > 20).alias("far"))
            counts = stream_windows.tumble_zone_count(checked)
            runs.append(log.finished(stream_sinks.start_file_sink(counts, f"{out}/data", f"{out}/checkpoint")))
    finally:
        spark.streams.removeListener(log)
    return runs


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST11: a stream in two deliveries: rows of windows that the watermark has
    closed by then are dropped, the others count."""
    out = shared_dir(spark, "streams", "late")
    _two_deliveries(spark, sf_dir, out)
    return to_ntz(spark.read.parquet(f"{out}/data"))


def stream_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST11: per delivery of ``stream_late_rows`` the rows read, the late
    (window, zone) groups that were dropped, and the checks of each
    micro-batch added up."""
    runs = _two_deliveries(spark, sf_dir, shared_dir(spark, "streams", "dropped"))
    rows = [(i, r["input_rows"], r["dropped"], r["checks.untimed"], r["checks.far"]) for i, r in enumerate(runs, 1)]
    return spark.createDataFrame(rows, "delivery int, input_rows long, dropped_groups long, untimed long, far long")


#: Rows of a landed page; the last one of a month may have less.
PAGE_ROWS = 400
PAGED_BY = ["taxi_type", "year", "month"]


def _land_pages(trips_: DataFrame, starts: DataFrame, path: str, first: int, last: int | None) -> None:
    """Pages of every (service, month) as JSON lines, a folder for every run of
    pages: the rows of a month are numbered and cut into pages, none of them
    empty.  ``first`` and ``last`` choose the pages to land."""
    paged = numbering.number_rows(trips_, PAGED_BY, starts, "_number", None if last is None else last * PAGE_ROWS)
    paged = paged.withColumn("page", (F.col("_number") / PAGE_ROWS).cast("int") + 1).drop("_number").where(F.col("page") >= first)
    sinks.write_table(paged.withColumn("run", rest.run_of(F.col("page"))), path, mode="append", partition_by=[*PAGED_BY, "run"], fmt="json")


def rest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips offered in pages per service and month, ingested by a
    stream in two deliveries: first two pages of every month, then the rest,
    from the offsets of the first run's checkpoint."""
    out = shared_dir(spark, "intake", "pages")
    rest.register(spark)
    t = trips.ingested(spark, sf_dir)
    pickup = F.coalesce("tpep_pickup_datetime", "lpep_pickup_datetime")
    dropoff = F.coalesce("tpep_dropoff_datetime", "lpep_dropoff_datetime")
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n) for c, n in ((pickup, "pickup_datetime"), (dropoff, "dropoff_datetime"))]
    rows = t.where(pickup.isNotNull()).select("taxi_type", F.year(pickup).alias("year"), F.month(pickup).alias("month"), *text, "PULocationID", "DOLocationID", "fare_amount", "payment_type")
    months = [f"{r.year}-{r.month:02d}" for r in rows.select("year", "month").distinct().orderBy("year", "month").collect()]
    url = f"{out}/pages/taxi_type={{taxi}}/year={{year}}/month={{month}}/run={{run}}"
    starts = numbering.part_starts(rows, PAGED_BY)
    for first, last in ((1, 2), (3, None)):
        _land_pages(rows, starts, f"{out}/pages", first, last)
        stream = spark.readStream.format("trip_pages").option("url", url).option("fetch", "landed").option("taxi", "green,yellow").option("months", ",".join(months)).load()
        stream_sinks.start_file_sink(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").select(*rows.columns)
