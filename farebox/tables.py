"""Loading the benchmark tables.

Parquet timestamps written without a zone load as ``timestamp_ntz``.
Watermarks and ``date_trunc`` want ``timestamp``; with the session pinned to
UTC the cast is exact, and Catalyst still pushes filters on the cast column
down to the scan.  Results are cast back to ``timestamp_ntz`` by
``to_ntz`` so they compare with zone-less engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def ntz_to_ltz(df: DataFrame) -> DataFrame:
    casts = [
        F.col(f.name).cast(T.TimestampType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*casts)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return ntz_to_ltz(spark.read.parquet(table_path(sf_dir, name)))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast every zoned timestamp column of a result to ``timestamp_ntz``."""
    cols: list[Column] = [
        F.col(f"`{f.name}`").cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
