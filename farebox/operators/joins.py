"""Joins.

Lookups are broadcast only after their size is checked: ``limit(n+1).count()``
reads at most ``n + 1`` rows of the lookup, so the check is cheap and the
broadcast side has a proven bound.  Above the bound the join is left to the
planner (sort-merge, or AQE's runtime broadcast when the real size is small).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lookups up to this many rows are broadcast (a 265-row zone table, a 7-row
# payment seed, a 25-row nation table, ...).
DEFAULT_BROADCAST_ROWS = 100_000


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    known_rows: int | None = None) -> DataFrame:
    """Broadcast hint when the frame has at most ``max_rows`` rows.
    ``known_rows`` states a size fixed by construction (a literal seed in
    code) and skips the counting job."""
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Column | str | Sequence[str],
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    known_rows: int | None = None,
) -> DataFrame:
    """Fact ⟕ lookup (J1, J4).  ``how='left'`` keeps unmatched fact rows with
    null lookup columns; ``'inner'`` drops them."""
    return fact.join(maybe_broadcast(lookup, max_broadcast_rows, known_rows), on, how)


def full_outer_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with the key columns coalesced (``on=[...]``)."""
    return left.join(right, on=list(keys), how="full")


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``.  Null key parts
    match null key parts (still an equi-join for the planner)."""
    return _null_safe(left, right, keys, "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``, nulls matching nulls."""
    return _null_safe(left, right, keys, "left_semi")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    seen = right.select(*[F.col(k).alias(f"_seen_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return left.join(seen, reduce(and_, same), how)
