"""CSV variants, seeds, literal rows, named views, NaN handling and the
Kafka option builders (no broker needed)."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from farebox.functions import columns as C
from farebox.operators import normalize, sinks
from farebox.sources import files
from farebox.streaming import source


def test_csv_variants(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, name string, amount double")
    df.write.option("header", "true").csv(f"{tmp_dir}/h")
    df.write.csv(f"{tmp_dir}/n")
    no_header = files.read_csv(spark, f"{tmp_dir}/n", header=False)
    assert no_header.columns == ["_c0", "_c1", "_c2"] and dict(no_header.dtypes)["_c0"] == "string"  # S1
    strings = files.read_csv(spark, f"{tmp_dir}/h")
    assert strings.columns == ["id", "name", "amount"] and set(dict(strings.dtypes).values()) == {"string"}  # S2
    inferred = files.read_csv(spark, f"{tmp_dir}/h", infer=True)
    assert dict(inferred.dtypes) == {"id": "int", "name": "string", "amount": "double"}  # S3
    sinks.write_table(inferred, f"{tmp_dir}/pq")  # S9: CSV -> Parquet
    assert sorted(r.id for r in files.read_parquet(spark, f"{tmp_dir}/pq", ignore_corrupt=True,
                                                   ignore_missing=True).collect()) == [1, 2]  # S15
    view = files.external_view(spark, "landed_trips", f"{tmp_dir}/pq")  # S19, S20, K10
    assert spark.sql("SELECT count(*) AS n FROM landed_trips").collect()[0].n == 2 and view.count() == 2


def test_clustered_write_follows_the_size(spark, tmp_dir):
    """Small directories are one file each, whatever the number of writing tasks."""
    from farebox.sources import inventory

    df = spark.range(0, 4000, 1, 40).select("id", (F.col("id") % 5).alias("part"))
    sinks.write_table(df, f"{tmp_dir}/clustered", partition_by=["part"], cluster=True)
    assert spark.read.parquet(f"{tmp_dir}/clustered").count() == 4000
    found = inventory.layout(inventory.landed_files(spark, f"{tmp_dir}/clustered")).collect()
    assert [r.file_count for r in found] == [1] * 5


def test_numbers_without_a_group_in_one_task(spark, monkeypatch):
    """Numbers are gapless in every group, null keys and repeated rows too, and
    the same in every run."""
    from farebox.operators import numbering

    monkeypatch.setattr(numbering, "TASK_ROWS", 100)
    df = spark.range(0, 3000, 1, 7).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.floor(F.col("id") / 4).alias("v")).repartition(5)
    starts = numbering.part_starts(df, ["k"], part_rows=60)
    assert starts.count() > 40
    got = numbering.number_rows(df, ["k"], starts, "n")
    assert got.rdd.getNumPartitions() == 30
    assert sorted((r.k or 0, r.n) for r in got.collect()) == [(k, n) for k in range(3) for n in range(1000)]
    assert sorted(map(str, got.collect())) == sorted(map(str, numbering.number_rows(df.repartition(11), ["k"], starts, "n").collect()))
    first = numbering.number_rows(df, ["k"], starts, "n", below=70)
    assert sorted(map(str, first.collect())) == sorted(map(str, got.where("n < 70").collect()))
    empty = df.where("v < 0")
    assert numbering.number_rows(empty, ["k"], numbering.part_starts(empty, ["k"]), "n").count() == 0


def test_file_layout_spreads_a_folder_over_tasks(spark, sf_small, monkeypatch):
    """Q9: whole files from several tasks, as few as one task would write."""
    from farebox.operators import numbering
    from farebox.plans import storage

    written = []
    monkeypatch.setattr(numbering, "PART_ROWS", 300, raising=False)
    monkeypatch.setattr(numbering, "TASK_ROWS", 1000, raising=False)
    monkeypatch.setattr(storage, "LAYOUT_ROWS", 50)
    listed = storage.inventory.landed_files
    monkeypatch.setattr(storage.inventory, "landed_files", lambda *a: written.append(listed(*a)) or written[-1])
    got = {r.folder: r.file_count for r in storage.file_layout(spark, sf_small).collect()}
    year = F.year(F.coalesce("tpep_pickup_datetime", "lpep_pickup_datetime"))
    want = {f"year={r.y}": -(-r["count"] // 50) for r in storage.trips.ingested(spark, sf_small).groupBy(year.alias("y")).count().collect()}
    assert got == want
    tasks = written[0].select(F.regexp_extract("path", "(year=[^/]*)/part-([0-9]*)", 1).alias("y"), F.regexp_extract("path", "/part-([0-9]*)", 1).alias("task"))
    assert min(r.n for r in tasks.groupBy("y").agg(F.countDistinct("task").alias("n")).collect()) > 1


def test_literal_rows_and_filter(spark):
    lit = files.literal_rows(spark, [(1,), (None,)], "id int")  # S21 / M20
    assert lit.count() == 2 and lit.filter(F.col("id") == 1).count() == 1
    pdf = pd.DataFrame({"id": [1, 2], "v": [0.5, 1.5]})
    assert files.literal_rows(spark, pdf, "id long, v double").count() == 2  # S22


def test_seed_with_checks(spark, tmp_dir):
    from farebox.operators import quality
    from farebox.schemas import PAYMENT_LOOKUP_SCHEMA

    path = f"{tmp_dir}/payment_lookup.csv"
    with open(path, "w") as f:
        f.write("payment_type_id,payment_type_name\n0,flex_fare\n1,credit_card\n1,dup\n,missing\n")
    seed = files.load_seed(spark, path, PAYMENT_LOOKUP_SCHEMA)
    rep = {(r.column_name, r.check_name): r.failures for r in quality.report(
        quality.column_checks(seed, {"payment_type_id": ["not_null"], "payment_type_name": ["not_null"]}),
        quality.unique_check(seed, ["payment_type_id"])).collect()}
    assert rep == {("payment_type_id", "not_null"): 1, ("payment_type_name", "not_null"): 0,
                   ("payment_type_id", "unique"): 1}


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, "y")], "v double, s string")
    got = [r.v for r in normalize.nan_to_null_all(df).collect()]
    assert got[0] is None and got[1] == 1.0
    assert df.select(C.nan_to_null("v").alias("v")).collect()[0].v is None
    assert not any(isinstance(x, float) and math.isnan(x) for x in got if x is not None)


def test_kafka_options():
    o = source.kafka_options("broker:9092", "rides")
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "rides", "startingOffsets": "earliest"}
    assert source.kafka_options("b", "t", starting="latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        source.kafka_options("b", "t", starting="group")
    assert source.kafka_sink_options("b", "t", "/ck")["checkpointLocation"] == "/ck"


def test_jdbc_and_warehouse_options():
    o = sinks.jdbc_options("jdbc:postgresql://db/ny", "yellow_taxi_data", user="u", password="p")
    assert o["batchsize"] == "100000" and o["dbtable"] == "yellow_taxi_data" and o["user"] == "u"


def test_month_fallback_prefers_and_skips(spark, tmp_dir):
    import datetime as dt

    from farebox.schemas import INGESTED_SCHEMA

    rows = lambda tag: spark.createDataFrame(
        [(None, None, None, None, 1, 2, 3.0, 1, tag)], INGESTED_SCHEMA)
    rows("csv-1").write.mode("overwrite").option("compression", "gzip").option("header", "true").csv(
        f"{tmp_dir}/2024/01")
    rows("pq-2").write.parquet(f"{tmp_dir}/2024/02")
    rows("csv-4").write.option("compression", "gzip").option("header", "true").csv(f"{tmp_dir}/2024/04")
    rows("pq-4").write.parquet(f"{tmp_dir}/2024/04b")
    import glob
    import os

    for f in glob.glob(f"{tmp_dir}/2024/04b/*.parquet"):
        os.link(f, f"{tmp_dir}/2024/04/{os.path.basename(f)}")
    months = [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
    got = sorted(r.taxi_type for r in files.read_month_fallback(spark, tmp_dir, months, INGESTED_SCHEMA).collect())
    assert got == ["csv-1", "csv-4", "pq-2"]  # March missing: skipped; April: CSV preferred
    got_pq = sorted(r.taxi_type for r in files.read_month_fallback(
        spark, tmp_dir, months, INGESTED_SCHEMA, prefer="parquet").collect())
    assert got_pq == ["csv-1", "pq-2", "pq-4"]
    assert files.read_month_fallback(spark, tmp_dir, [dt.date(2023, 1, 1)], INGESTED_SCHEMA) is None


def test_inventory_lists_folders_and_formats(spark, tmp_dir):
    from farebox.sources import inventory

    assert inventory.month_inventory(spark, f"{tmp_dir}/none").count() == 0
    one = spark.createDataFrame([(1, "x")], "a int, b string")
    for ym, n in (("year=2023/month=11", 2), ("year=2024/month=2", 1)):
        one.union(one).repartition(n).write.parquet(f"{tmp_dir}/h/{ym}")
    one.write.option("compression", "gzip").csv(f"{tmp_dir}/h/year=2024/month=2/more")  # a folder below is no month file
    one.coalesce(1).write.mode("append").option("compression", "gzip").csv(f"{tmp_dir}/h/year=2023/month=11")
    got = inventory.month_inventory(spark, f"{tmp_dir}/h")
    assert sorted((r.year, r.month, r.format, r.files) for r in got.collect()) == [(2023, 11, "csv", 1), (2023, 11, "parquet", 2), (2024, 2, "parquet", 1)]
    assert sorted(tuple(r) for r in inventory.empty_months(got).collect()) == [(2023, 12), (2024, 1)]
    assert inventory.empty_months(got.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # names and sizes only


def test_missing_partitions_come_from_folder_names(spark, tmp_dir):
    from pyspark.sql import types as T

    from farebox.sources import inventory

    df = spark.createDataFrame([("a b/c=1%", 1), (None, 2), ("x", 3)], "k string, v int")
    df.write.partitionBy("k").parquet(f"{tmp_dir}/p")
    got = inventory.partition_values(inventory.landed_files(spark, f"{tmp_dir}/p"), [T.StructField("k", T.StringType())])
    assert {r.k for r in got.collect()} == {"a b/c=1%", None, "x"}
    for _ in range(2):
        sinks.write_missing_partitions(df.union(spark.createDataFrame([("new", 4)], "k string, v int")), f"{tmp_dir}/p", ["k"])
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_dir}/p").collect()) == [1, 2, 3, 4]


def test_drifting_files_cost_a_scan_per_schema(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.readwriter import DataFrameReader

    ids = spark.range(0, 600)
    kinds = [ids.select(F.col("id").cast(t).alias("id"), *extra) for t, extra in (("int", []), ("bigint", [F.lit("x").alias("s")]), ("double", [F.lit(1).alias("s")]))]
    for i, k in enumerate(kinds):
        k.repartition(70).write.parquet(f"{tmp_dir}/in/part {i}")
    reads = []
    real = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **kw: reads.append(len(paths)) or real(self, *paths, **kw))
    out = files.read_widened(spark, [f"{tmp_dir}/in"])
    assert reads == [70, 70, 70]  # one scan a schema, no read a file
    assert dict(out.dtypes) == {"id": "double", "s": "string"}
    assert out.count() == 1800 and out.agg(F.sum("id")).first()[0] == 3 * sum(range(600))
    assert sorted((r.s, r.n) for r in out.where("s is not null").groupBy("s").agg(F.count("*").alias("n")).collect()) == [("1", 600), ("x", 600)]
    with pytest.raises(FileNotFoundError):
        files.read_widened(spark, [f"{tmp_dir}/in/none"])
