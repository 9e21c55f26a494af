"""Null key parts in anti joins, upserts, landings and the versioned table."""

from pyspark.sql import functions as F

from farebox.operators.joins import anti_join, semi_join
from farebox.operators.sinks import PartitionedTable, write_missing_partitions
from farebox.streaming import chains
from farebox.streaming.sinks import UpsertSink


def test_anti_and_semi_join_match_null_keys(spark):
    left = spark.createDataFrame([(1, None), (1, 2), (None, None), (3, 3)], "a int, b int")
    right = spark.createDataFrame([(1, None), (None, None), (None, 2)], "a int, b int")
    assert sorted(map(tuple, anti_join(left, right, ["a", "b"]).collect())) == [(1, 2), (3, 3)]
    assert {tuple(r) for r in semi_join(left, right, ["a", "b"]).collect()} == {(1, None), (None, None)}


def test_upsert_keeps_one_row_per_null_key(spark, tmp_dir):
    for name, kw in (("whole", {}), ("parts", {"time_key": "w"})):
        sink = UpsertSink(f"{tmp_dir}/{name}", ["w", "zone"], "n", **kw)
        for batch, n in enumerate((1, 2, 3)):
            df = spark.sql(f"select timestamp'2024-01-01 00:00:00' as w, cast(null as int) as zone, {n} as n union all select null, 7, {n}")
            sink(df, batch)
        assert {(r.zone, r.n) for r in sink.read(spark).collect()} == {(None, 3), (7, 3)}
        assert sink.read(spark).count() == 2


def test_null_partition_lands_once(spark, tmp_dir):
    df = spark.createDataFrame([(None, 1), (2024, 2)], "year int, v int")
    for _ in range(3):
        write_missing_partitions(df, f"{tmp_dir}/land", ["year"])
    assert spark.read.parquet(f"{tmp_dir}/land").count() == 2


def test_null_folder_is_replaced_and_kept(spark, tmp_dir):
    table = PartitionedTable(f"{tmp_dir}/t", "d")
    table.overwrite(spark.sql("select cast(null as date) as d, 9 as v union all select date'2024-01-02', 1"))
    table.replace_interval(spark.sql("select date'2024-01-03' as d, 5 as v"), "2024-01-01", "2024-01-31", granularity="date")
    assert sorted(tuple(r) for r in table.read(spark).select("v").collect()) == [(5,), (9,)]


def test_global_session_keeps_every_zone(spark, tmp_dir):
    rows = [("2024-01-01 00:00:00", 1), ("2024-01-01 00:01:00", 99), ("2024-01-01 00:02:00", None), ("2024-01-01 00:02:30", 99), ("2024-01-01 05:00:00", 1)]
    df = spark.createDataFrame(rows, "t string, PULocationID int").select(F.col("t").cast("timestamp").alias("event_time"), "PULocationID")
    df.write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in")
    q = chains.session_global(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/out")
    q.awaitTermination()
    got = {(r.PULocationID, r.num_trips) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {(1, 1), (99, 2), (None, 1)}
