"""Numbers 0, 1, 2, ... of the rows of a group without bringing the group into
one task.

Rows are dealt by their hash to parts of about ``PART_ROWS`` rows; the sizes of
the parts before it give every part its first number, and a window counts on
inside the part.  Equal rows are interchangeable, so the numbers do not depend
on the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.operators.sinks import materialize

#: Rows of a part and of a task, about.
PART_ROWS, TASK_ROWS = 50_000, 200_000


def _with(rows: DataFrame, small: DataFrame, cols: Sequence[str], more: str) -> DataFrame:
    """``rows`` with column ``more`` of the row of ``small`` that agrees in
    ``cols``; nulls agree."""
    named = small.select(*[F.col(c).alias(f"_at{i}") for i, c in enumerate(cols)], more)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_at{i}")) for i, c in enumerate(cols)])
    return rows.join(F.broadcast(named), same).select(*rows.columns, more)


def _dealt(rows: DataFrame, sizes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with their hash and their part (``sizes``: parts of a group)."""
    hashed = _with(rows, sizes, keys, "_parts").withColumn("_hash", F.xxhash64(*rows.columns))
    return hashed.withColumn("_part", F.pmod("_hash", "_parts")).drop("_parts")


def part_starts(rows: DataFrame, keys: Sequence[str], part_rows: int | None = None) -> DataFrame:
    """``keys, _parts, _part, _rows, _start``: parts of every group and the
    number of their first row, saved: a row per ``part_rows`` rows, or per group
    where that is more."""
    sizes = materialize(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / (part_rows or PART_ROWS)).alias("_parts")))
    held = _dealt(rows, sizes, keys).groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return materialize(_with(starts, sizes, keys, "_parts"))


def number_rows(rows: DataFrame, keys: Sequence[str], starts: DataFrame, name: str, below: int | None = None) -> DataFrame:
    """``rows`` with their number (long) in their group as ``name``; ``below``
    keeps the rows of lesser numbers only, and then only parts that have some
    are shuffled.  ``starts`` comes from ``part_starts`` of the same rows."""
    sizes = starts.select(*keys, "_parts").distinct()
    wanted = starts if below is None else starts.where(F.col("_start") < below)
    held = wanted.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    placed = _with(_dealt(rows, sizes, keys), wanted, [*keys, "_part"], "_start").repartition(max(1, -(-held // TASK_ROWS)), *keys, "_part")
    order = Window.partitionBy(*keys, "_part").orderBy("_hash", *rows.columns)
    numbered = placed.withColumn(name, F.col("_start") + F.row_number().over(order) - 1).select(*rows.columns, name)
    return numbered if below is None else numbered.where(F.col(name) < below)


def whole_files(rows: DataFrame, keys: Sequence[str], rows_per_file: int) -> DataFrame:
    """``rows`` placed so that a write partitioned by ``keys`` with at most
    ``rows_per_file`` rows a file gives a folder as few files as one task would:
    every task gets whole files of a folder, but for its last file."""
    starts = part_starts(rows, keys)
    total = starts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    run = max(1, TASK_ROWS // 10 // rows_per_file) * rows_per_file
    numbered = number_rows(rows, keys, starts, "_number").withColumn("_run", F.expr(f"_number div {run}"))
    return numbered.repartition(max(1, -(-total // TASK_ROWS)), *keys, "_run").select(*rows.columns)
