"""One key holds a third of all rows: results stay exact (checked against
the window form, a naive join or brute force) and the plans keep a partial
aggregate before every shuffle of the hot key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from farebox.operators import dedupe, sessions, tags
from plan_text import plan_of
from test_streaming import _brute_sessions
from twins import keep_one_window

T0 = dt.datetime(2025, 1, 1)


def _skewed(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 400)  # key 0: a third of the rows
        rows.append((key, T0 + dt.timedelta(seconds=rnd.randint(0, 20 * 86400)), float(rnd.randint(0, 5000)) / 100,
                     rnd.choice(["a", "b", None])))
    return rows


def test_keep_one_hot_key(spark):
    df = spark.createDataFrame(_skewed(), "k int, t timestamp, fare double, tag string")
    got = dedupe.keep_one(df, ["k"], ["t"])
    want = keep_one_window(df, ["k"], ["t"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert "partial_min" in plan_of(got)


def test_tag_month_hot_question(spark):
    q = spark.createDataFrame(_skewed(), "id int, creation_date timestamp, score double, tag string").select(
        "id", "creation_date", "score", F.col("score").alias("view_count"))
    t = tags.explode_tags(spark.createDataFrame([(i, "x|y" if i % 2 == 0 else "x") for i in range(401)],
                                                "id int, tags string"))
    got = {(r.month, r.tag): (r.question_count, round(r.avg_score, 9)) for r in tags.tag_month(q, t).collect()}
    naive = (q.join(t.withColumnRenamed("question_id", "id"), "id")
             .groupBy(F.trunc(F.to_date("creation_date"), "MM").alias("month"), "tag")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("a")))
    want = {(r.month, r.tag): (r.n, round(r.a, 9)) for r in naive.collect()}
    assert got == want


def test_sessions_hot_zone(spark):
    rows = [(k, t) for k, t, _f, _s in _skewed(1500)]
    df = spark.createDataFrame(rows, "zone int, t timestamp")
    got = {(r.zone, r.session_start, r.session_end): r.num_trips
           for r in sessions.sessions(df, "t", "30 minutes", keys=["zone"], bucket_seconds=3600).collect()}
    assert got == _brute_sessions(rows, 1800, True)
