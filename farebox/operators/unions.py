"""Set operations (U1–U4).  All are narrow: a union never shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_positional(*frames: DataFrame) -> DataFrame:
    """UNION ALL by position, refused unless every frame has the same
    column names in the same order (positional unions silently mix columns
    otherwise)."""
    first = frames[0]
    for other in frames[1:]:
        if other.columns != first.columns:
            raise ValueError(f"positional union of different layouts: {first.columns} vs {other.columns}")
    out = first
    for other in frames[1:]:
        out = out.union(other)
    return out


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """U2 (strict) / U3 (missing columns become null)."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=allow_missing)
    return out


def tag(df: DataFrame, column: str, value) -> DataFrame:
    """Constant column."""
    return df.withColumn(column, F.lit(value))


def union_tagged(frames: dict, column: str = "service_type", select: Sequence[str] | None = None) -> DataFrame:
    """U4: each frame gets its tag, then UNION ALL by name."""
    tagged = []
    for value, df in frames.items():
        cols = list(select) if select is not None else df.columns
        tagged.append(df.select(*cols).withColumn(column, F.lit(value)))
    return union_by_name(*tagged)
