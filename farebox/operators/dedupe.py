"""Deduplication.

Keep-one dedupe is written as an aggregate, not as ``row_number() = 1``:
``min(struct(order..., rest...))`` per key picks the same survivor as the
window with that total order, but it aggregates map-side.  A key that holds a
third of all rows is reduced inside every task before the shuffle, whereas
the window form would sort all of that key's rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact(df: DataFrame) -> DataFrame:
    """Exact full-row dedupe (GROUP BY all columns)."""
    return df.distinct()


def keep_one(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the smallest by ``order`` (ascending,
    nulls first), then by every remaining column, so the survivor is defined
    even when the caller's order has ties."""
    key = list(key)
    order_rest = [c for c in order if c not in key]
    tail = [c for c in df.columns if c not in key and c not in order_rest]
    payload = order_rest + tail
    if not payload:
        return df.select(*key).distinct()
    best = df.groupBy(*key).agg(F.min(F.struct(*payload)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in payload]).select(*df.columns)


#: Distinct values of coded columns, together, up to which they get codes.
MOST_CODES = 64


def keep_one_coded(
    df: DataFrame, key: Sequence[str], order: Sequence[str], coded: Mapping[str, Sequence | None], required: Sequence[str] = (), most: int = MOST_CODES,
) -> DataFrame:
    """``keep_one`` in hash aggregates only.

    ``min`` over a struct with strings has no fixed-width buffer, so Spark
    sorts each task's rows for it.  Here the few values of the ``coded`` columns
    (all that occur but null, see ``few_values``; None or more than ``most``
    combinations fall back to ``keep_one``) become one number that sorts as they do, nulls first.  The other columns
    behind the key must have a fixed width.  Columns are settled from the last
    to the first: a group of (key, the columns before) keeps its smallest
    value, and ``min_by`` carries what was settled already, which is one row
    per value by then.  ``required`` columns hold no null."""
    key = list(key)
    order_rest = [c for c in order if c not in key]
    payload = order_rest + [c for c in df.columns if c not in key and c not in order_rest]
    # Coded columns are settled together, so they must come last.
    plain, tail = payload[: len(payload) - len(coded)], payload[len(payload) - len(coded) :]
    if set(tail) != set(coded) or None in coded.values():
        return keep_one(df, key, order)
    # Nulls first, then by bytes, as Spark orders strings.
    seen = list(product(*[[None, *sorted(coded[c], key=lambda v: v.encode() if isinstance(v, str) else v)] for c in tail]))
    if len(seen) > most:
        return keep_one(df, key, order)
    rows = F.array(*[F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(tail, r)]) for r in seen])
    level = df.select(*key, *plain, F.array_position(rows, F.struct(*[F.col(c) for c in tail])).alias("_code"))
    # A null sorts before every value, but min leaves it out: a flag goes ahead of the column.
    flags = [c for c in plain if c not in required and df.schema[c].nullable]
    level = level.select("*", *[F.col(c).isNotNull().alias(f"_has_{c}") for c in flags])
    steps = [s for c in plain for s in ([f"_has_{c}", c] if c in flags else [c])]
    level = level.groupBy(*key, *steps).agg(F.min("_code").alias("_code"))
    while steps:
        last, carried = steps.pop(), [c for c in level.columns if c not in key and c not in steps]
        carried.remove(last)
        level = level.groupBy(*key, *steps).agg(F.min(last).alias(last), *[_with_smallest(c, last, last in flags).alias(c) for c in carried])
    found = F.element_at(rows, F.col("_code").cast("int"))
    return level.select(*key, *plain, *[found[c].alias(c) for c in tail]).select(*df.columns)


def few_values(df: DataFrame, col: str, most: int = MOST_CODES) -> list | None:
    """The distinct values of a column but null, or None if they are more than
    ``most`` (one job over that column; at most ``most`` + 1 rows come back)."""
    found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
    return [r[0] for r in found] if len(found) <= most else None


def _with_smallest(c: str, last: str, nullable: bool) -> Column:
    """``c`` of the row with the smallest ``last``; where all of ``last`` is null
    there is one row, which ``min_by`` would pass over."""
    best = F.min_by(c, last)
    return F.when(F.col(f"_has_{last}"), best).otherwise(F.min(c)) if nullable else best


def duplicate_report(df: DataFrame, keys: Sequence[str], top: int = 50, min_count: int = 2) -> DataFrame:
    """Groups of ``keys`` seen at least ``min_count`` times, most repeated
    first (keys break ties), first ``top``.  Planned as a partial aggregate
    and a TakeOrderedAndProject: only ``top`` rows per task reach the driver."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") >= min_count)
    return counted.orderBy(F.col("cnt").desc(), *[F.col(k).asc_nulls_first() for k in keys]).limit(top)


def excess_rows(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """``count(*) - count(distinct key)`` for each key set.  Keys are
    compared as tuples (no separator collisions; a null part is a value of
    its own, as in GROUP BY).

    When the key sets are nested (each contains the next, as a trip key with
    and without the fare), the distinct counts come from a chain of
    group-bys: rows are grouped by the widest key (partial aggregation
    map-side), that result by the next key, and so on – no row expansion.
    Otherwise one ``count(distinct struct)`` per key set."""
    items = sorted(key_sets.items(), key=lambda kv: -len(kv[1]))
    nested = all(set(items[i + 1][1]) <= set(items[i][1]) for i in range(len(items) - 1))
    if not nested:
        total = F.count(F.lit(1))
        return df.agg(*[(total - F.count_distinct(F.struct(*keys))).alias(name) for name, keys in key_sets.items()])
    # Each level carries the row count and, per earlier level, how many of
    # its distinct keys fall in the group; one final aggregate adds them up.
    level = df.groupBy(*items[0][1]).agg(F.count(F.lit(1)).alias("_n")).withColumn("_d0", F.lit(1))
    for i, (_name, keys) in enumerate(items[1:], start=1):
        level = level.groupBy(*keys).agg(
            F.sum("_n").alias("_n"), *[F.sum(f"_d{j}").alias(f"_d{j}") for j in range(i)]
        ).withColumn(f"_d{i}", F.lit(1))
    totals = level.agg(F.sum("_n").alias("_rows"), *[F.sum(f"_d{j}").alias(f"_d{j}") for j in range(len(items))])
    index = {name: j for j, (name, _keys) in enumerate(items)}
    return totals.select(
        *[(F.col("_rows") - F.col(f"_d{index[name]}")).cast("long").alias(name) for name in key_sets]
    )
