"""Batch tumbling windows and gap sessions (the batch twins of ST4–ST8).

Sessions are computed without putting a key – or, for the global chain, the
whole table – into one task, and without ordering raw events:

1. Events are reduced to cells: one row per (key, span of one gap length) with
   first time, last time and count.  Two events of a cell are always in one
   session, so this is a hash aggregate with a map-side step.
2. Cells are ordered inside (key, time bucket) groups to find *local* session
   starts (gap to the previous cell > ``gap``); a group holds at most
   bucket / gap cells.  Each group is summarised to one row; only this summary
   is ordered per key to decide whether a bucket's first session continues the
   previous bucket's last one, and to give each bucket its offset.
3. The offsets are joined back to the cells (null-safe keys); a cell's session
   is ``offset + local ordinal - continued``, and sessions are plain
   aggregates of cells.

An event exactly ``gap`` after the previous one continues the session (the
streaming ``session_window`` does the same); the session ends at last event +
gap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 3600


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s").lower()]
    return int(n) * mult


def tumbling(
    df: DataFrame,
    time_col: str,
    size: str,
    keys: Sequence[str] = (),
    aggs: Sequence = (),
) -> DataFrame:
    """Tumbling windows (epoch-aligned) with optional keys: one aggregate."""
    out = df.groupBy(F.window(F.col(time_col), size).alias("w"), *keys).agg(*aggs)
    rest = [c for c in out.columns if c != "w"]
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def sessions(
    df: DataFrame,
    time_col: str,
    gap: str,
    keys: Sequence[str] = (),
    count_by: Sequence[str] = (),
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Gap sessions per ``keys`` (empty = one chain over all events) with the
    number of events per session and ``count_by`` group.

    Keyed (ST7): ``keys=[zone]`` -> (zone, session_start, session_end, num_trips).
    Global (ST8): ``keys=[]``, ``count_by=[zone]`` -> one row per zone present
    in each global session, with that session's bounds.

    Counts per ``count_by`` group take their session from the cell they lie
    in, by a join on (key, cell)."""
    keys, count_by = list(keys), list(count_by)
    gap_s = _seconds(gap)
    gap_us = gap_s * 1_000_000
    bucket_us = gap_us * max(1, bucket_seconds // gap_s)

    def floor_to(c: str, width: int):
        return F.col(c) - F.pmod(F.col(c), F.lit(width))

    ev = df.filter(F.col(time_col).isNotNull()).select(*keys, *count_by, F.unix_micros(time_col).alias("_t"))
    parts = ev.groupBy(*keys, *count_by, floor_to("_t", gap_us).alias("_g")).agg(
        F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    cells = parts
    if count_by:
        cells = parts.groupBy(*keys, "_g").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_n").alias("_n"))
    cells = cells.withColumn("_b", floor_to("_g", bucket_us))
    w_local = Window.partitionBy(*keys, "_b").orderBy("_g")
    before = F.lag("_hi").over(w_local)
    cells = cells.withColumn("_start", (before.isNull() | (F.col("_lo") - before > gap_us)).cast("int"))
    cells = cells.withColumn("_local", F.sum("_start").over(w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    w_chain = Window.partitionBy(*keys).orderBy("_b")
    last = F.lag("_last").over(w_chain)
    offsets = cells.groupBy(*keys, "_b").agg(
        F.min("_lo").alias("_first"), F.max("_hi").alias("_last"), F.sum("_start").alias("_starts")
    )
    offsets = offsets.withColumn("_cont", (last.isNotNull() & (F.col("_first") - last <= gap_us)).cast("int"))
    done = F.sum(F.col("_starts") - F.col("_cont")).over(w_chain.rowsBetween(Window.unboundedPreceding, -1))
    offsets = offsets.select(*keys, "_b", (F.coalesce(done, F.lit(0)) - F.col("_cont")).alias("_offset"))
    cells = _join_null_safe(cells, offsets, [*keys, "_b"]).withColumn("_session", F.col("_offset") + F.col("_local"))

    bounds = cells.groupBy(*keys, "_session").agg(
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_n").alias("num_trips")
    )
    if count_by:
        placed = _join_null_safe(parts.select(*keys, *count_by, "_g", "_n"), cells.select(*keys, "_g", "_session"), [*keys, "_g"])
        counts = placed.groupBy(*keys, "_session", *count_by).agg(F.sum("_n").alias("num_trips"))
        bounds = _join_null_safe(counts, bounds.drop("num_trips"), [*keys, "_session"])
    return bounds.select(
        *keys,
        F.timestamp_micros("_lo").alias("session_start"),
        F.timestamp_micros(F.col("_hi") + gap_us).alias("session_end"),
        *count_by,
        F.col("num_trips").cast("long").alias("num_trips"),
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``, nulls matching nulls, the keys kept once."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(other, reduce(and_, same)).drop(*[f"_r_{c}" for c in keys])
