"""Sessions, watermarks, late data, upsert replay, JSON tolerance, scoring,
the REST source and the key/value twin."""

import datetime as dt
import json
import os
import random

import pandas as pd
from pyspark.sql import functions as F

from farebox.functions import records
from farebox.operators import scoring, sessions, sinks
from farebox.streaming import sinks as ssinks
from farebox.streaming import chains, source
from farebox.streaming import windows as sw

T0 = dt.datetime(2025, 10, 1, 0, 0, 0)


def _brute_sessions(events, gap_s, keyed):
    """Brute force: sort, start a session when the gap exceeds ``gap_s``."""
    out = {}
    groups = {}
    for k, t in events:
        groups.setdefault(k if keyed else None, []).append((t, k))
    for g, evs in groups.items():
        evs.sort()
        start = last = None
        members = []
        for t, k in evs + [(None, None)]:
            if t is None or last is None or (t - last).total_seconds() > gap_s:
                if members:
                    end = last + dt.timedelta(seconds=gap_s)
                    for kk in set(members):
                        out[(g if keyed else kk, start, end)] = members.count(kk) if not keyed else len(members)
                start, members = t, []
            if t is not None:
                members.append(k)
                last = t
    return out


def test_session_gap_edges_keyed_vs_global(spark):
    ts = [0, 299, 599, 900]  # gaps 299, 300, 301
    ev = [(1, T0 + dt.timedelta(seconds=s)) for s in ts] + [(2, T0 + dt.timedelta(seconds=450))]
    df = spark.createDataFrame(ev, "zone int, t timestamp")
    keyed = {(r.zone, r.session_start, r.session_end): r.num_trips
             for r in sessions.sessions(df, "t", "5 minutes", keys=["zone"], bucket_seconds=600).collect()}
    assert keyed == _brute_sessions(ev, 300, True)
    assert keyed[(1, T0, T0 + dt.timedelta(seconds=599 + 300))] == 3  # 300 s apart continues
    glob = {(r.zone, r.session_start, r.session_end): r.num_trips
            for r in sessions.sessions(df, "t", "5 minutes", count_by=["zone"], bucket_seconds=600).collect()}
    assert glob == _brute_sessions(ev, 300, False)
    assert glob != {k: v for k, v in keyed.items()}


def test_sessions_random_against_brute_force(spark):
    rnd = random.Random(7)
    ev, t = [], T0
    for _ in range(400):
        t += dt.timedelta(seconds=rnd.choice([1, 30, 299, 300, 301, 900, 4000]))
        ev.append((rnd.randint(0, 3), t))
    df = spark.createDataFrame(ev, "zone int, t timestamp")
    for keyed in (True, False):
        kw = {"keys": ["zone"]} if keyed else {"count_by": ["zone"]}
        got = {(r.zone, r.session_start, r.session_end): r.num_trips
               for r in sessions.sessions(df, "t", "5 minutes", bucket_seconds=1800, **kw).collect()}
        assert got == _brute_sessions(ev, 300, keyed)


def test_batch_tumbling_boundaries(spark):
    ev = [(T0,), (T0 + dt.timedelta(minutes=4, seconds=59),), (T0 + dt.timedelta(minutes=5),)]
    df = spark.createDataFrame(ev, "t timestamp")
    got = sorted((r.window_start, r.n) for r in sessions.tumbling(df, "t", "5 minutes", [],
                                                                      [F.count(F.lit(1)).alias("n")]).collect())
    assert got == [(T0, 2), (T0 + dt.timedelta(minutes=5), 1)]


def _write_batch(spark, d, i, rows):
    df = spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), z) for s, z in rows], "event_time timestamp, PULocationID int"
    )
    df.coalesce(1).write.parquet(f"{d}/b{i}")


def test_late_data_four_batches(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    batches = [
        [(1, 1), (299, 1)],
        [(606, 2)],
        [(180, 1), (1800, 2)],  # 00:03:00 z1 is late
        [(1860, 2)],
    ]
    schema = "event_time timestamp, PULocationID int"
    # One file per trigger: write all, read with maxFilesPerTrigger=1 in order.
    for i, b in enumerate(batches):
        _write_batch(spark, src, i, b)
    import glob

    os.makedirs(f"{tmp_dir}/flat")
    for i in range(len(batches)):
        f = glob.glob(f"{src}/b{i}/*.parquet")[0]
        os.link(f, f"{tmp_dir}/flat/{i:02d}.parquet")
        os.utime(f"{tmp_dir}/flat/{i:02d}.parquet", (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/flat/*.parquet")
    q = ssinks.start_file_sink(sw.tumble_zone_count(stream), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    got = sorted((r.window_start, r.PULocationID, r.num_trips) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [(T0, 1, 3), (T0 + dt.timedelta(minutes=10), 2, 1)]


def test_upsert_sink_replay(spark, tmp_dir):
    sink = ssinks.UpsertSink(f"{tmp_dir}/t", ["k"])
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b1 = spark.createDataFrame([(1, "c")], "k int, v string")
    sink(b0, 0)
    sink(b1, 1)
    sink(b0, 0)  # replay of a committed batch: no effect
    sink(b1, 1)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(1, "c"), (2, "b")]


def test_partitioned_upsert_sink_replay(spark, tmp_dir):
    sink = ssinks.UpsertSink(f"{tmp_dir}/pt", ["w", "k"], time_key="w", unit="day")
    d1, d2 = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1)
    b0 = spark.createDataFrame([(d1, 1, "a"), (d2, 1, "b")], "w timestamp, k int, v string")
    b1 = spark.createDataFrame([(d2, 1, "c"), (d2, 2, "d")], "w timestamp, k int, v string")
    for b, i in ((b0, 0), (b1, 1), (b0, 0), (b1, 1)):
        sink(b, i)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(d1, 1, "a"), (d2, 1, "c"), (d2, 2, "d")]


def test_upsert_sink_last_wins_by_order(spark, tmp_dir):
    sink = ssinks.UpsertSink(f"{tmp_dir}/o", ["k"], order_by="ts")
    b0 = spark.createDataFrame([(1, 5, "late"), (1, 3, "early"), (2, 1, "x")], "k int, ts int, v string")
    sink(b0, 0)
    sink(spark.createDataFrame([(2, 9, "y")], "k int, ts int, v string"), 1)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(1, 5, "late"), (2, 9, "y")]


def test_interval_replace_rerun(spark, tmp_dir):
    t = sinks.PartitionedTable(f"{tmp_dir}/r", "d")
    old = spark.createDataFrame([(dt.date(2024, 1, d), "old") for d in (1, 2, 3, 4)], "d date, v string")
    t.overwrite(old)
    new = spark.createDataFrame([(dt.date(2024, 1, 2), "new"), (dt.date(2024, 1, 9), "out")], "d date, v string")
    for _ in range(2):
        t.replace_interval(new, "2024-01-02", "2024-01-03", granularity="date")
    got = sorted(tuple(r) for r in t.read(spark).collect())
    assert got == [(dt.date(2024, 1, 1), "old"), (dt.date(2024, 1, 2), "new"), (dt.date(2024, 1, 4), "old")]


def test_json_tolerant_and_strict(spark):
    msgs = spark.createDataFrame(
        [('{"PULocationID": 1, "lpep_pickup_datetime": "2025-10-01 00:10:01"}',), ("{bad",),
         ('{"PULocationID": 2, "extra": 5, "lpep_pickup_datetime": "2025-10-01 00:10:02"}',),
         ('{"total_amount": 3.0}',), (None,)],
        "value string",
    )
    got = sorted(r.PULocationID for r in source.green_trips_from_messages(msgs).collect())
    assert got == [1, 2]
    parsed = msgs.select(records.decode(F.col("value"), records.RIDE_SCHEMA).alias("r")).collect()
    assert parsed[1].r is None or all(v is None for v in parsed[1].r)


def test_ride_record_roundtrip(spark):
    df = spark.createDataFrame([(186, 79, 1.72, 17.31, dt.datetime(2024, 11, 1, 2, 55, 2))],
                               "PULocationID int, DOLocationID int, trip_distance double, total_amount double, "
                               "tpep_pickup_datetime timestamp")
    msg = records.encode(records.ride_record(df)).collect()[0].value
    assert json.loads(msg) == {"PULocationID": 186, "DOLocationID": 79, "trip_distance": 1.72,
                               "total_amount": 17.31, "tpep_pickup_datetime": 1730429702000}
    back = source.rides_from_messages(spark.createDataFrame([(msg,)], "value string")).collect()[0]
    assert back.event_time == dt.datetime(2024, 11, 1, 2, 55, 2)


def test_score_partitions_and_twin(spark, sf_small):
    from farebox.plans import trips

    green, _ = trips.sources(spark, sf_small)
    scored = scoring.score_partitions(green).limit(50).toPandas()
    pd.testing.assert_series_equal(scored["predicted_duration"], scored["trip_distance"] * 5, check_names=False)
    df = scoring.keyed_revenue(green, "lpep_pickup_datetime", "PULocationID", "total_amount", "2020-01-01", digits=None)
    got = {(r.hour.replace(tzinfo=None), r.zone): (round(r.revenue, 6), r["count"]) for r in df.collect()}
    rows = green.where("lpep_pickup_datetime >= '2020-01-01'").select("lpep_pickup_datetime", "PULocationID", "total_amount").toPandas()
    rows["hour"] = rows.lpep_pickup_datetime.dt.floor("h")
    want = rows.groupby(["hour", "PULocationID"], dropna=False).total_amount.agg(["sum", "size"])
    assert got == {(h.to_pydatetime(), z): (round(s, 6), n) for (h, z), s, n in zip(want.index, want["sum"], want["size"])}


def noted_fetch(url, taxi, year, month, page, page_size):
    """A page of the ones that lie in ``url``; every request leaves a mark."""
    with open(f"{url}/asked", "a") as f:
        f.write(f"{taxi}/{year}/{month}/{page}\n")
    return [{"PULocationID": i, "fare_amount": float(page), "pickup_datetime": f"{year}-{month:02d}-01 00:00:00"} for i in range(page_size)] if noted_head(url, taxi, year, month, page, page_size) else []


def noted_head(url, taxi, year, month, page, page_size):
    with open(f"{url}/pages") as f:
        return page <= json.load(f).get(f"{taxi}/{year}/{month}", 0)


def _pages(spark, url, reader, **options):
    from farebox.sources import rest

    rest.register(spark)
    r = reader.format("trip_pages").option("url", url).option("taxi", "green,yellow").option("months", "2025-01,2025-02,2025-03").option("page_size", "3")
    return r.option("fetch", "test_streaming:noted_fetch").option("head", "test_streaming:noted_head").options(**options).load()


def _asked(url):
    with open(f"{url}/asked") as f:
        return sorted(f.read().split())


def test_page_source_pushes_month_filters(spark, tmp_dir):
    with open(f"{tmp_dir}/pages", "w") as f:
        json.dump({"green/2025/1": 2, "green/2025/2": 1, "yellow/2025/2": 4}, f)
    df = _pages(spark, tmp_dir, spark.read)
    got = df.where("month = 2 and taxi_type in ('green', 'yellow') and year >= 2025 and PULocationID < 2").collect()
    assert sorted((r.taxi_type, r.page, r.PULocationID) for r in got) == [(t, p, i) for t, n in (("green", 1), ("yellow", 4)) for p in range(1, n + 1) for i in (0, 1)]
    # Only the two months that pass, each up to its first empty page.
    assert _asked(tmp_dir) == sorted(["green/2025/2/1", "green/2025/2/2", *[f"yellow/2025/2/{p}" for p in range(1, 6)]])
    assert df.where("month > 12").rdd.getNumPartitions() <= 1 and df.where("month > 12").count() == 0
    assert _pages(spark, tmp_dir, spark.read, months="").count() == 0


def test_page_stream_restarts_without_a_second_read(spark, tmp_dir):
    def run(pages):
        with open(f"{tmp_dir}/pages", "w") as f:
            json.dump(pages, f)
        stream = _pages(spark, tmp_dir, spark.readStream, pages_per_task="2")
        ssinks.start_file_sink(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()

    run({"green/2025/1": 3, "yellow/2025/3": 1})
    assert _asked(tmp_dir) == ["green/2025/1/1", "green/2025/1/2", "green/2025/1/3", "yellow/2025/3/1"]
    run({"green/2025/1": 8, "green/2025/2": 1, "yellow/2025/3": 1})
    run({"green/2025/1": 8, "green/2025/2": 1, "yellow/2025/3": 1})  # nothing new
    want = [f"green/2025/1/{p}" for p in range(1, 9)] + ["green/2025/2/1", "yellow/2025/3/1"]
    assert _asked(tmp_dir) == want  # every page once
    rows = spark.read.parquet(f"{tmp_dir}/out").groupBy("taxi_type", "month", "page").count().collect()
    assert sorted((r.taxi_type, r.month, r.page, r["count"]) for r in rows) == sorted((t, int(m), int(p), 3) for t, _, m, p in (x.split("/") for x in want))


def test_page_tasks_follow_the_batch(monkeypatch):
    from farebox.sources import rest

    monkeypatch.setattr(rest, "BATCH_TASKS", 4)
    reader = rest.TripPagesStreamReader({"months": "2025-01", "pages_per_task": "2"})

    def ranges(first, stop):
        return [(p.first, p.last) for p in reader.partitions({"green/2025/1": first}, {"green/2025/1": stop})]

    assert ranges(1, 4) == [(1, 2), (3, 3)] and ranges(4, 9) == [(4, 4), (5, 6), (7, 8)] and ranges(3, 3) == []
    assert ranges(3, 42) == [(3, 10), (11, 20), (21, 30), (31, 40), (41, 41)]  # 39 pages, 10 a task


def test_landed_runs_of_pages(tmp_dir):
    """A run folder holds many pages, and may grow between two requests."""
    from farebox.sources import rest

    folder, url = f"{tmp_dir}/run=0", f"{tmp_dir}/run={{run}}"
    os.makedirs(folder)

    def land(name, rows):
        with open(f"{folder}/{name}.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)

    client = rest.PageClient({"url": url, "fetch": "landed"})
    month = ("green", 2025, 1)
    assert client.next_page(month, 1) == 1
    land("a", [{"page": p, "payment_type": p, "pickup_datetime": '"page":7}'} for p in (1, 2, 2)])
    assert client.next_page(month, 1) == 3 and not client.exists(month, 7)
    assert [b.to_pylist() for b in client.rows(rest.PageRange(*month, 2))][0][0]["payment_type"] == 2
    land("b", [{"page": p} for p in range(3, rest.RUN_PAGES + 1)])
    assert client.next_page(month, 3) == rest.RUN_PAGES + 1
    got = [r for b in client.rows(rest.PageRange(*month)) for r in b.to_pylist()]
    assert [r["page"] for r in got] == [1, 2, 2, *range(3, rest.RUN_PAGES + 1)]
    assert got[0] == {"taxi_type": "green", "year": 2025, "month": 1, "page": 1, "pickup_datetime": '"page":7}', "dropoff_datetime": None,
                      "PULocationID": None, "DOLocationID": None, "fare_amount": None, "tip_amount": None, "total_amount": None, "payment_type": 1}


def test_rest_pages_keeps_repeated_rows(spark, tmp_dir):
    """Rows that repeat leave no page empty, so none ends a month early,
    and the files do not follow the number of pages."""
    from farebox.plans import intake

    line = spark.range(3).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(5.0).alias("l_quantity"), F.lit("O").alias("l_linestatus"), F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("l_shipdate"),
    )
    line.crossJoin(spark.range(4000)).drop("id").write.parquet(f"{tmp_dir}/lineitem.parquet")
    got = intake.rest_pages(spark, tmp_dir).groupBy("PULocationID").count().collect()
    assert sorted((r.PULocationID, r["count"]) for r in got) == [(0, 4000), (1, 4000), (2, 4000)]


def test_interval_replace_timestamp_granularity(spark, tmp_dir):
    t = sinks.PartitionedTable(f"{tmp_dir}/ts", "pickup_datetime", "day")
    at = [T0 - dt.timedelta(hours=1), T0, T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=2)]
    t.overwrite(spark.createDataFrame([(x, "old") for x in at], "pickup_datetime timestamp, v string"))
    new = spark.createDataFrame([(T0 + dt.timedelta(minutes=30), "new")], "pickup_datetime timestamp, v string")
    start, end = T0.isoformat(sep=" "), (T0 + dt.timedelta(hours=2)).isoformat(sep=" ")
    for _ in range(2):  # rows exactly at start are replaced, rows exactly at end are kept
        t.replace_interval(new, start, end)
    got = sorted((r.pickup_datetime, r.v) for r in t.read(spark).collect())
    assert got == [(at[0], "old"), (T0 + dt.timedelta(minutes=30), "new"), (at[3], "old")]


def test_clustered_layout_sorted_files(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2025, 1 + i % 2, 1), f"t{i % 7}", i) for i in range(200)],
                               "month date, tag string, v int")
    sinks.write_partitioned_clustered(df, f"{tmp_dir}/c", "month", "tag")
    back = spark.read.parquet(f"{tmp_dir}/c")
    assert back.count() == 200 and sorted(r.month for r in back.select("month").distinct().collect()) == [
        dt.date(2025, 1, 1), dt.date(2025, 2, 1)]
    per_file = back.select(F.input_file_name().alias("f"), "tag").collect()
    by_file = {}
    for r in per_file:
        by_file.setdefault(r.f, []).append(r.tag)
    assert all(tags == sorted(tags) for tags in by_file.values())


def test_restart_from_checkpoint_no_duplicates(spark, tmp_dir):
    schema = "event_time timestamp, PULocationID int, total_amount double"
    src = f"{tmp_dir}/src"
    os.makedirs(src)

    def add(i, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/w{i}")
        import glob

        f = glob.glob(f"{tmp_dir}/w{i}/*.parquet")[0]
        os.link(f, f"{src}/{i:02d}.parquet")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{src}/*.parquet")
        q = ssinks.start_file_sink(sw.passthrough(stream.withColumn("DOLocationID", F.lit(0))
                                                  .withColumn("trip_distance", F.lit(1.0))),
                                   f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
        q.awaitTermination()

    add(0, [(T0, 1, 1.0), (T0 + dt.timedelta(seconds=1), 2, 2.0)])
    run()
    add(1, [(T0 + dt.timedelta(seconds=2), 3, 3.0)])
    run()  # restart from the checkpoint: only the new file is processed
    run()  # nothing new: nothing written
    got = sorted(r.PULocationID for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [1, 2, 3]


def test_stream_equals_batch_on_closed_windows(spark, sf_small):
    from farebox.plans import streams, windows

    stream = {(r.window_start, r.PULocationID): (r.num_trips, r.total_revenue)
              for r in streams.stream_tumble_zone(spark, sf_small).collect()}
    batch_df = windows.tumble_zone(spark, sf_small)
    max_t = windows.rides(spark, sf_small).agg(F.max("event_time")).collect()[0][0]
    closed = {(r.window_start, r.PULocationID): (r.num_trips, r.total_revenue)
              for r in batch_df.collect()
              if r.window_end <= max_t.replace(tzinfo=None, microsecond=(max_t.microsecond // 1000) * 1000)
              - dt.timedelta(seconds=5)}
    assert stream == closed


def test_partitioned_interval_replace(spark, tmp_dir):
    t = sinks.PartitionedTable(f"{tmp_dir}/pv", "ts", unit="day")
    d = lambda day, h: dt.datetime(2024, 1, day, h)
    old = [(d(1, 23), "old"), (d(2, 1), "old"), (d(2, 23), "old"), (d(3, 5), "old"), (d(4, 1), "old")]
    t.overwrite(spark.createDataFrame(old, "ts timestamp, v string"))
    # Interval [2024-01-02 12:00, 2024-01-04 00:00): day 2 keeps 01:00, loses 23:00;
    # day 3 has no new row and is emptied; day 4 (at the end) is untouched.
    new = spark.createDataFrame([(d(2, 13), "new"), (d(5, 0), "outside")], "ts timestamp, v string")
    for _ in range(2):
        t.replace_interval(new, "2024-01-02 12:00:00", "2024-01-04 00:00:00")
    got = sorted((r.ts, r.v) for r in t.read(spark).collect())
    assert got == [(d(1, 23), "old"), (d(2, 1), "old"), (d(2, 13), "new"), (d(4, 1), "old")]
    # A date-granularity table keyed by a date column, by month.
    m = sinks.PartitionedTable(f"{tmp_dir}/pm", "day", unit="month")
    m.overwrite(spark.createDataFrame([(dt.date(2024, 1, 31), 1), (dt.date(2024, 2, 1), 2)], "day date, v int"))
    m.replace_interval(spark.createDataFrame([], "day date, v int"), "2024-02-01", "2024-02-29", granularity="date")
    assert [tuple(r) for r in m.read(spark).collect()] == [(dt.date(2024, 1, 31), 1)]


def test_sessions_of_null_keys(spark):
    ev = [(1, T0), (1, T0 + dt.timedelta(seconds=100)), (1, T0 + dt.timedelta(seconds=1000)),
          (None, T0), (None, T0 + dt.timedelta(seconds=10))]
    df = spark.createDataFrame(ev, "zone int, t timestamp")
    got = sorted(((r.zone if r.zone is not None else -1), r.num_trips)
                 for r in sessions.sessions(df, "t", "5 minutes", keys=["zone"], bucket_seconds=600).collect())
    assert got == [(-1, 2), (1, 1), (1, 2)]  # a null key is a group of its own


def test_json_wrong_field_type(spark):
    msgs = spark.createDataFrame(
        [('{"PULocationID": "x", "lpep_pickup_datetime": "2025-10-01 00:10:01", "total_amount": 2.5}',)],
        "value string")
    rows_ = source.green_trips_from_messages(msgs).collect()
    # The unreadable field does not invent a value: it is null, or the record is dropped.
    assert all(r.PULocationID is None for r in rows_)


def test_stream_sessions_equal_batch_on_closed_sessions(spark, sf_small):
    """ST7 / ST8: the streaming sessions equal the batch sessions (same event
    times: whole seconds of the green-trip text) that closed before the final
    watermark."""
    from farebox.plans import streams

    green = source.green_trips_from_messages(source.green_trip_messages(
        spark.read.parquet(f"{sf_small}/events.parquet")))
    wm = green.agg(F.max("event_time")).collect()[0][0] - dt.timedelta(seconds=5)

    def closed(df, keyed):
        return {((r.PULocationID if keyed else None), r.session_start, r.session_end, r.PULocationID, r.num_trips)
                for r in df.collect() if r.session_end <= wm.replace(tzinfo=None)}

    batch_keyed = sessions.sessions(green, "event_time", "60 minutes", keys=["PULocationID"])
    stream_keyed = streams.stream_session_keyed(spark, sf_small)
    assert closed(stream_keyed, True) == closed(batch_keyed, True)
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    zone = F.when(F.col("event_id") % 11 != 0, (F.col("user_id") % 40).cast("int"))
    green = source.green_trips_from_messages(source.green_trip_messages(ev, zone))
    batch_global = sessions.sessions(green, "event_time", "5 minutes", count_by=["PULocationID"])
    stream_global = streams.stream_session_global(spark, sf_small)
    assert closed(stream_global, False) == closed(batch_global, False)


def test_global_session_state_and_restart(spark, tmp_dir):
    """One state entry a session with one counter a zone, whatever the number
    of events; a restart goes on from it; late chains are dropped."""
    def at(s):
        return T0 + dt.timedelta(seconds=s)

    def deliver(i, rows):
        df = spark.createDataFrame([(at(s), z) for s, z in rows], "event_time timestamp, PULocationID int")
        df.coalesce(2).write.parquet(f"{tmp_dir}/in/d={i}")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in/*")
        ssinks.start_file_sink(chains.session_global(stream), f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()

    def state():
        return spark.read.format("statestore").option("stateVarName", "open").load(f"{tmp_dir}/ck").collect()

    def out():
        return {(r.session_start, r.session_end, r.PULocationID): r.num_trips for r in spark.read.parquet(f"{tmp_dir}/out").collect()}

    ssinks.prepare_state_store(spark)
    many = [(s, z) for s in range(0, 300, 3) for z in (7, 4001, None)]
    deliver(0, many)
    (entry,) = state()
    assert entry.user_map_value.zones == [7, 4001] and entry.user_map_value.counts == [100, 100] and entry.user_map_value.unknown == 100
    # 300 s behind the last event (297): the session goes on, across a restart; 1600 is another.
    deliver(1, [(597, 7), (500, 12), (1600, None)])
    assert len(out()) == 4 and out()[(at(0), at(897), 7)] == 101 and out()[(at(0), at(897), None)] == 100
    (entry,) = state()
    assert entry.user_map_value.zones == [] and entry.user_map_value.unknown == 1
    # Behind the watermark and near no open session: dropped; 1301 chains to the open one.
    deliver(2, [(900, 5), (1301, 5), (5000, 1)])
    assert {k: v for k, v in out().items() if k[0] == at(1301)} == {(at(1301), at(1900), 5): 1, (at(1301), at(1900), None): 1}
    assert not any(k[0] == at(900) for k in out())


def test_upsert_replay_after_a_lost_batch(spark, tmp_dir):
    """Killed between the state commit and the sink: the batch runs again."""
    sink = ssinks.UpsertSink(f"{tmp_dir}/t", ["w", "k"], time_key="w", unit="day")
    d = [dt.datetime(2024, 1, 1 + i) for i in range(3)]
    batches = [spark.createDataFrame(x, "w timestamp, k int, v string") for x in ([(d[0], 1, "a"), (d[1], 1, "a")], [(d[1], 1, "b"), (d[2], 1, "b")], [(d[0], 2, "c")])]
    for i in (0, 1, 2, 1, 0, 2):
        sink(batches[i], i)
    assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(d[0], 1, "a"), (d[0], 2, "c"), (d[1], 1, "b"), (d[2], 1, "b")]


def test_replace_empties_folders_and_writes_only_touched_ones(spark, tmp_dir):
    import glob
    import os

    t = sinks.PartitionedTable(f"{tmp_dir}/t", "ts", unit="day")
    at = lambda day, h: dt.datetime(2024, 1, day, h)
    t.overwrite(spark.createDataFrame([(at(i, 1), "old") for i in range(1, 8)], "ts timestamp, v string"))
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_dir}/t/fb_part=*/*.parquet")}
    for _ in range(2):
        t.replace_interval(spark.createDataFrame([(at(3, 5), "new")], "ts timestamp, v string"), "2024-01-03 00:00:00", "2024-01-06 00:00:00")
    assert sorted((r.ts.day, r.v) for r in t.read(spark).collect()) == [(1, "old"), (2, "old"), (3, "new"), (6, "old"), (7, "old")]
    same = [f for f, at in before.items() if os.path.exists(f) and os.stat(f).st_mtime_ns == at]
    assert {f.split("fb_part=2024-01-0")[1][0] for f in same} == {"1", "2", "6", "7"}
    assert not [d for d in os.listdir(f"{tmp_dir}/t") if not d.startswith(("fb_part=", "_SUCCESS", "._SUCCESS"))]


class Stopped(Exception):
    pass


def test_failure_between_state_and_sink_commit(spark, tmp_dir):
    """The stream dies inside a micro-batch, once after the state was computed
    and before the sink wrote, once after the sink wrote and before the batch
    was committed; a restart gives what an uninterrupted run gives."""
    import pytest
    from pyspark.errors import StreamingQueryException

    schema = "event_time timestamp, PULocationID int, total_amount double"

    def deliver(i):
        rows = [(T0 + dt.timedelta(minutes=20 * i + m), m % 3, float(m)) for m in range(0, 40, 2)]
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{tmp_dir}/in/d={i}")

    def run(name, before=False, after=False):
        sink = ssinks.UpsertSink(f"{tmp_dir}/{name}", ["window_start", "PULocationID"], time_key="window_start")

        def write(batch, batch_id):
            if before:
                batch.write.format("noop").mode("overwrite").save()  # commits the state of this batch
                raise Stopped
            sink(batch, batch_id)
            if after:
                raise Stopped

        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in/*")
        q = ssinks.start_foreach_batch(sw.tumble_zone_revenue(stream), write, f"{tmp_dir}/{name}-ck", mode="update")
        if before or after:
            with pytest.raises(StreamingQueryException):
                q.awaitTermination()
        else:
            q.awaitTermination()
        return sink

    for i, failure in enumerate(({}, {"before": True}, {"after": True})):
        deliver(i)
        if failure:
            run("broken", **failure)
        run("broken")
        whole = run("whole")
    got, want = (sorted(tuple(r) for r in s.read(spark).select("window_start", "PULocationID", "num_trips", "total_revenue").collect()) for s in (run("broken"), whole))
    assert got == want and sum(r[2] for r in got) == 60


def test_progress_log_counts_rows_and_checks(spark, tmp_dir):
    from farebox.streaming import progress

    spark.createDataFrame([(T0, 1), (T0, None), (None, 2)], "event_time timestamp, PULocationID int").write.parquet(f"{tmp_dir}/in")
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("event_time timestamp, PULocationID int").parquet(f"{tmp_dir}/in")
        checked = stream.observe("checks", F.count_if(F.col("event_time").isNull()).alias("untimed"))
        totals = log.finished(ssinks.start_file_sink(checked, f"{tmp_dir}/out", f"{tmp_dir}/ck"))
    finally:
        spark.streams.removeListener(log)
    assert totals["input_rows"] == 3 and totals["checks.untimed"] == 1 and totals["dropped"] == 0
