"""Other formulations of operators, for equivalence tests."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def keep_one_window(df, key, order):
    """The window form of ``dedupe.keep_one`` (same survivor)."""
    rest = [c for c in df.columns if c not in key]
    order_cols = [c for c in order if c not in key] + [c for c in rest if c not in order]
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
