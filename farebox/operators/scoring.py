"""Per-partition model scoring (X1, X2, M19) and the key/value revenue
rollup (A15, X4).

Scoring runs through ``mapInPandas``: Spark hands the function Arrow batches
of one partition, so a partition is never materialised whole and the model
sees vectorised pandas frames.  The model is any ``pandas.DataFrame ->
pandas.Series`` callable, loaded once a task; the default is the duration rule
of the modelled workload (``trip_distance * 5``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORING_COLUMNS = ["VendorID", "lpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance"]


class DurationModel:
    """The model of the modelled workload: predicted duration = distance × 5."""

    factor = 5

    def __call__(self, pdf: pd.DataFrame) -> pd.Series:
        return pdf["trip_distance"] * self.factor


def score_partitions(
    df: DataFrame,
    load: Callable[[], Callable[[pd.DataFrame], pd.Series]] = DurationModel,
    columns: Sequence[str] = SCORING_COLUMNS,
    output: str = "predicted_duration",
) -> DataFrame:
    """Rows -> pandas batches -> model -> rows with one more column.
    ``load`` gives the model (reads its file, builds its session); a task calls
    it once, before its first batch, and scores all its batches with it."""
    selected = df.select(*columns)
    schema = T.StructType(list(selected.schema.fields) + [T.StructField(output, T.DoubleType(), True)])

    def apply_model(batches):
        model = load()
        for pdf in batches:
            pdf[output] = model(pdf).astype("float64")
            yield pdf

    return selected.mapInPandas(apply_model, schema)


REVENUE_ROW_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.TimestampType(), True),
        T.StructField("zone", T.IntegerType(), True),
        T.StructField("revenue", T.DoubleType(), True),
        T.StructField("count", T.IntegerType(), True),
    ]
)


def keyed_revenue(df: DataFrame, time_col: str, zone_col: str, amount_col: str, since, digits=2) -> DataFrame:
    """(hour, zone) -> (Σ amount, Σ 1) with map-side combine, cast to
    the declared result schema (zone and count as int).  The DataFrame form of
    the key/value reduce: HashAggregate does the partial combine."""
    rows = df.filter(F.col(time_col) >= F.lit(since).cast("timestamp")).groupBy(
        F.date_trunc("hour", F.col(time_col)).alias("hour"), F.col(zone_col).alias("zone")
    ).agg(
        (F.round(F.sum(amount_col), digits) if digits is not None else F.sum(amount_col)).alias("revenue"),
        F.count(F.lit(1)).alias("count"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REVENUE_ROW_SCHEMA])
