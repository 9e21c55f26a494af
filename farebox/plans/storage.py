"""Sink and source round trips over data derived from the benchmark tables.

Each query writes into a fresh folder under the cluster's shared checkpoint
folder, runs the operator, and returns a DataFrame reading the result back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import numbering, quality, revenue, sinks, tags
from farebox.operators.joins import lookup_join
from farebox.plans import checks, domain, questions, trips
from farebox.schemas import GREEN_SCHEMA, INGESTED_SCHEMA, PAYMENT_LOOKUP_SCHEMA
from farebox.session import shared_dir
from farebox.sources import files, inventory
from farebox.tables import to_ntz

REPLACE_START, REPLACE_END = "1998-01-01", "1998-12-31"
LOAD_STAMP = dt.datetime(2025, 1, 1, 0, 0, 0)
SCAN_START, SCAN_END = dt.date(1996, 3, 1), dt.date(1997, 8, 15)


def _ingested_by_month(spark, sf_dir) -> DataFrame:
    t = trips.ingested(spark, sf_dir)
    pickup = F.coalesce("tpep_pickup_datetime", "lpep_pickup_datetime")
    return t.withColumn("year", F.year(pickup)).withColumn("month", F.month(pickup))


def interval_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily report (variant Z) is written by month, then
    the dates of 1998 are replaced by the variant-A report of that interval –
    twice, to show the rerun leaves the content unchanged.  Each run rewrites
    only the twelve touched months."""
    table = sinks.PartitionedTable(shared_dir(spark, "tables", "trips_report"), "trip_date", "month")
    table.overwrite(trips.daily_report(spark, sf_dir))
    staged_a = trips.staging_trips(trips.ingested(spark, sf_dir), domain.payment_lookup(spark),
                                   "1998-01-01 00:00:00", "1999-01-01 00:00:00", variant="A",
                                   lookup_rows=domain.PAYMENT_LOOKUP_SIZE)

    new = revenue.daily_report(staged_a, "1998-01-01 00:00:00", "1999-01-01 00:00:00", null_payment_label=None,
                               **trips.REPORT_DIGITS)
    for _ in range(2):
        table.replace_interval(new, REPLACE_START, REPLACE_END, granularity="date")
    return table.read(spark)


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends with a load stamp."""
    out = shared_dir(spark, "tables", "ingestion_trips")
    t = _ingested_by_month(spark, sf_dir)
    sinks.append_with_stamp(t.filter("year < 1998 or year is null").drop("year", "month"), out, LOAD_STAMP)
    sinks.append_with_stamp(t.filter("year >= 1998").drop("year", "month"), out, LOAD_STAMP)
    return to_ntz(spark.read.parquet(out))


def partitioned_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K13 + K5: the tag × month fact, one directory per month, tag-sorted files."""
    out = shared_dir(spark, "tables", "fct_questions_by_tag_month")
    sinks.write_partitioned_clustered(questions.tag_month(spark, sf_dir), out, "month", "tag")
    return spark.read.parquet(out)


def landing_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land months before 1998, then land everything again; months
    already present are skipped, so nothing is written twice."""
    out = shared_dir(spark, "landing", "trips")
    t = _ingested_by_month(spark, sf_dir)
    sinks.write_missing_partitions(t.filter("year < 1998"), out, ["year", "month"])
    sinks.write_missing_partitions(t, out, ["year", "month"])
    return to_ntz(spark.read.parquet(out))


def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + S8 + K1 + K5: green trips as gzip CSV with a header, read back with
    the declared schema, landed as Parquet by year/month."""
    base = shared_dir(spark, "landing", "green")
    green, _ = trips.sources(spark, sf_dir)
    files.write_csv(green, f"{base}/csv")
    typed = files.read_csv(spark, f"{base}/csv/*.csv.gz", GREEN_SCHEMA)
    landed = typed.withColumn("year", F.year("lpep_pickup_datetime")).withColumn(
        "month", F.month("lpep_pickup_datetime")
    )
    sinks.write_table(landed, f"{base}/pq", partition_by=["year", "month"], cluster=True)
    return to_ntz(spark.read.parquet(f"{base}/pq"))


#: Files of each drifting group.
DRIFT_FILES = 110


def _drifted_parts(spark, sf_dir):
    green, _ = trips.sources(spark, sf_dir)
    part_a = green.filter(F.col("PULocationID") < 12).select(
        *[F.col(c).cast("int").alias(c) if c in ("VendorID", "passenger_count", "PULocationID") else F.col(c)
          for c in green.columns]
    )
    part_b = green.filter("PULocationID >= 12 or PULocationID is null").select(
        *[F.col(c).cast("long").alias(c) if c in ("VendorID", "PULocationID") else
          F.col(c).cast("double").alias(c) if c == "passenger_count" else F.col(c) for c in green.columns]
    )
    return part_a, part_b


def widened_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two file groups whose id and passenger columns drift (INT32 vs
    INT64 / DOUBLE), scanned once through the widened schema."""
    base = shared_dir(spark, "landing", "drift")
    a, b = _drifted_parts(spark, sf_dir)
    a.repartition(DRIFT_FILES).write.parquet(f"{base}/a")
    b.repartition(DRIFT_FILES).write.parquet(f"{base}/b")
    return to_ntz(files.read_widened(spark, [f"{base}/a", f"{base}/b"]))


def union_by_name_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File groups with different column sets (one lacks ``ehail_fee``
    and ``trip_type``) and drifting types, unioned by name."""
    base = shared_dir(spark, "landing", "union")
    a, b = _drifted_parts(spark, sf_dir)
    a.repartition(DRIFT_FILES).write.parquet(f"{base}/a")
    b.drop("ehail_fee", "trip_type").repartition(DRIFT_FILES).write.parquet(f"{base}/b")
    return to_ntz(files.read_union_by_name(spark, [f"{base}/a", f"{base}/b"]))


def month_interval_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S13 + S14: months from March 1996 to mid-August 1997 of a year/month
    landing, read through a partition filter."""
    base = shared_dir(spark, "landing", "months")
    sinks.write_table(_ingested_by_month(spark, sf_dir), base, partition_by=["year", "month"], cluster=True)
    return to_ntz(files.read_month_range(spark, base, SCAN_START, SCAN_END, max_year=2100))


def format_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month of the raw ingest is landed – even months as gzip
    CSV, odd months as Parquet, in ``year=/month=`` folders (two partitioned
    writes, one scan each) – and read back month by month with CSV
    preferred, Parquet as the fallback."""
    base = shared_dir(spark, "landing", "fallback")
    t = _ingested_by_month(spark, sf_dir)
    even = F.coalesce(F.col("month") % 2 == 0, F.lit(False))
    files.write_csv(t.filter(even), base, partition_by=["year", "month"])
    sinks.write_table(t.filter(~even), base, mode="append", partition_by=["year", "month"])
    span = t.agg(F.min("year").alias("y0"), F.max("year").alias("y1")).collect()[0]
    months = files.month_starts(dt.date(span.y0, 1, 1), dt.date(span.y1, 12, 31), today=dt.date(9999, 1, 1))
    return to_ntz(files.read_month_fallback(spark, base, months, INGESTED_SCHEMA, prefer="csv"))


def empty_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8: a landing in which every third month was never written: the months
    between the first and the last that hold no file, from the listing."""
    base = shared_dir(spark, "landing", "holes")
    t = _ingested_by_month(spark, sf_dir).where("month % 3 <> 0")
    sinks.write_table(t, base, partition_by=["year", "month"], cluster=True)
    return inventory.empty_months(inventory.month_inventory(spark, base))


LAYOUT_ROWS = 500


def file_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: files of a landing by year, each folder written in files of 500 rows
    and one of the rest; a task writes some files of a folder, never a whole year."""
    base = shared_dir(spark, "landing", "layout")
    t = _ingested_by_month(spark, sf_dir).where("year is not null").drop("month")
    sinks.write_table(numbering.whole_files(t, ["year"], LAYOUT_ROWS), base, partition_by=["year"], max_records_per_file=LAYOUT_ROWS)
    found = inventory.layout(inventory.landed_files(spark, base))
    return found.select("folder", "file_count", (F.col("bytes") > 0).alias("has_bytes"))


def hourly_revenue_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 staged as in the modelled workload: each service's hourly report is
    materialised (lineage cut by a checkpoint) and the outer join and zone
    join run on the saved reports."""

    green, yellow = trips.sources(spark, sf_dir)
    g = sinks.materialize(revenue.hourly_revenue(green, "lpep_pickup_datetime", since=trips.REPORT_SINCE, digits=domain.SUM_DIGITS))
    y = sinks.materialize(revenue.hourly_revenue(yellow, "tpep_pickup_datetime", since=trips.REPORT_SINCE, digits=domain.SUM_DIGITS))
    return to_ntz(revenue.attach_zones(revenue.hourly_revenue_outer(g, y), trips.zones(spark, sf_dir)))


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + K4 + K14: the green report written as 20 balanced files
    (repartition), the yellow one narrowed to 4 tasks without a shuffle
    (coalesce) and sharded by record count; both read back and stacked."""

    base = shared_dir(spark, "reports", "revenue")
    green, yellow = trips.sources(spark, sf_dir)
    sinks.write_table(revenue.hourly_revenue(green, "lpep_pickup_datetime", since=trips.REPORT_SINCE, digits=domain.SUM_DIGITS),
                      f"{base}/green", files=20)
    sinks.write_table(revenue.hourly_revenue(yellow, "tpep_pickup_datetime", since=trips.REPORT_SINCE, digits=domain.SUM_DIGITS),
                      f"{base}/yellow", files=4, shuffle=False, max_records_per_file=1000)
    g, y = spark.read.parquet(f"{base}/green"), spark.read.parquet(f"{base}/yellow")
    return to_ntz(revenue.hourly_revenue_tagged(g, y))


def monthly_revenue_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + K8: the monthly service report through the connector-style
    writer (format and options from the caller; Parquet here)."""
    out = shared_dir(spark, "warehouse", "monthly_revenue")
    sinks.warehouse_write(trips.monthly_revenue_service(spark, sf_dir), "parquet", {"path": out})
    return spark.read.parquet(out)


#: Buckets of the tag table at benchmark size; larger tables get more.
TAG_BUCKETS = 16


def _bucketed_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"fct_questions_by_tag_{uuid.uuid4().hex}"
    path = shared_dir(spark, "tables", "fct_questions_by_tag")
    return sinks.write_bucketed(questions.tag_month(spark, sf_dir), name, path, ["tag"], sort=["month"], least=TAG_BUCKETS)


def bucketed_tag_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tag fact as a bucketed table, each month's count beside its
    tag's total: the aggregate and the join read the buckets as they lie."""
    fact = _bucketed_tags(spark, sf_dir)
    totals = fact.groupBy("tag").agg(F.sum("question_count").alias("tag_total"))
    return fact.join(totals, "tag").select("month", "tag", "question_count", "tag_total")


def bucketed_tag_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K13 + M12: the trend mart from the bucketed table: only the buckets of
    the wanted tags are read."""
    return tags.tag_trends(_bucketed_tags(spark, sf_dir), questions.BENCH_TREND_TAGS)


def staging_written_and_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, Q3, Q4, Q12: the column checks of staging, counted while staging is
    written."""
    path = shared_dir(spark, "tables", "staging")
    staged = trips.staging_trips(trips.ingested(spark, sf_dir), domain.payment_lookup(spark), variant="A", lookup_rows=domain.PAYMENT_LOOKUP_SIZE)
    return quality.observed_write(staged, checks.STAGING_RULES, lambda df: sinks.write_table(df, path), "staging_trips")


def seed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment lookup lands as CSV, is loaded with its types, checked
    (codes unique and present, names present) and joined to the raw trips:
    trips per payment, with the number of failed checks."""
    path = shared_dir(spark, "landing", "seed")
    files.write_csv(domain.payment_lookup(spark), path, gzip=False)
    seed = files.load_seed(spark, path, PAYMENT_LOOKUP_SCHEMA)
    rules = {"payment_type_id": ["not_null"], "payment_type_name": ["not_null"]}
    report = quality.checks_with_unique(seed, rules, ["payment_type_id"], "payment_lookup")
    failed = report.agg(F.count_if(~F.col("passed")).alias("failed_checks"))
    t = trips.ingested(spark, sf_dir).groupBy("payment_type").agg(F.count(F.lit(1)).alias("num_trips"))
    named = lookup_join(t, seed, t["payment_type"] == seed["payment_type_id"], "left").select("payment_type", "payment_type_name", "num_trips")
    return named.withColumn("failed_checks", F.lit(failed.first()[0]).cast("long"))
