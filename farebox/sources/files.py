"""File sources.

Readers always pass an explicit schema when one is known (no inference pass
over the data), read Parquet through globs or partitioned directories so
Catalyst prunes partitions and columns, and never loop over rows on the
driver.  What lies where, and with which schemas, comes from one listing and
from footers read by tasks (``farebox.sources.inventory``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.sources.inventory import MONTH_FOLDER, landed_files, read_drifting, with_months

TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


# ------------------------------------------------------------------ CSV
def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    timestamp_format: str = TS_FORMAT,
) -> DataFrame:
    """CSV (optionally gzip; ``.gz`` is unsplittable, so callers
    repartition after reading large single files).  With no schema and no
    inference every column is a string (``_c0 ...`` without a header)."""
    reader = spark.read.option("header", str(header).lower()).option("timestampFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, gzip: bool = True, mode: str = "overwrite",
              timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS", partition_by: Sequence[str] = (),
              header: bool = True) -> None:
    w = df.write.mode(mode).option("header", str(header).lower()).option("timestampFormat", timestamp_format)
    if gzip:
        w = w.option("compression", "gzip")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


# ------------------------------------------------------------------ Parquet
def read_parquet(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    ignore_corrupt: bool = False,
    ignore_missing: bool = False,
) -> DataFrame:
    """Parquet files, directories or globs."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


_RANK = {
    T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3,
    T.FloatType: 4, T.DoubleType: 5,
}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """int < long < double; date < timestamp; anything else mixed -> string."""
    if a == b:
        return a
    ra, rb = _RANK.get(type(a)), _RANK.get(type(b))
    if ra is not None and rb is not None:
        return a if ra >= rb else b
    temporal = {T.DateType, T.TimestampType, T.TimestampNTZType}
    if type(a) in temporal and type(b) in temporal:
        return T.TimestampType()
    return T.StringType()


def widest_schema(schemas: Iterable[T.StructType], overrides: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """The widest type per column over several schemas (first-seen order)."""
    fields: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    for name, dtype in (overrides or {}).items():
        if name in fields:
            fields[name] = dtype
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def read_widened(spark: SparkSession, paths: Sequence[str], overrides: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Files whose integer columns drift (INT32 in some, INT64 / DOUBLE in
    others), read as the widest type of each column."""
    return read_drifting(spark, paths, widest_schema, overrides)


def read_union_by_name(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files with different column sets (and drifting types): files
    with the same schema are read together, each group is cast to the widest
    type, then all groups are unioned by name with missing columns as null."""
    return read_drifting(spark, paths, widest_schema)


# ------------------------------------------------------------------ months
def month_starts(start: dt.date, end: dt.date, max_year: int | None = None,
                 today: dt.date | None = None) -> list[dt.date]:
    """First days of every month from month(start) to end
    inclusive; the current and future months and years past ``max_year`` are
    skipped; ``end < start`` is an error."""
    if end < start:
        raise ValueError(f"end {end} is before start {start}")
    today = today or dt.date.today()
    current = dt.date(today.year, today.month, 1)
    out, m = [], dt.date(start.year, start.month, 1)
    while m <= end:
        if m < current and (max_year is None or m.year <= max_year):
            out.append(m)
        m = dt.date(m.year + (m.month == 12), m.month % 12 + 1, 1)
    return out


def read_month_range(
    spark: SparkSession,
    base: str,
    start: dt.date,
    end: dt.date,
    schema: T.StructType | None = None,
    max_year: int | None = None,
    today: dt.date | None = None,
) -> DataFrame:
    """S13 + S14 over a ``year=/month=`` layout: the months to read become a
    partition filter, so only existing month directories in range are listed
    and read; a missing month is skipped; nothing found gives an empty frame
    with the table's schema."""
    months = month_starts(start, end, max_year, today)
    df = read_parquet(spark, base, schema)
    if not months:
        return df.limit(0)
    ym = F.col("year") * 100 + F.col("month")
    return df.filter(ym.isin(*[m.year * 100 + m.month for m in months]))


def try_read(reader) -> DataFrame | None:
    """Run a reader; None when Spark finds no file at the path (the listing
    happens when the DataFrame is created, no data is read)."""

    try:
        return reader()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def read_month_fallback(
    spark: SparkSession,
    base: str,
    months: Sequence[dt.date],
    csv_schema: T.StructType,
    prefer: str = "csv",
    pattern: str = MONTH_FOLDER,
) -> DataFrame | None:
    """Per month, the preferred format if its files exist, else the
    other, else the month is skipped.  One listing decides for all months (the
    folders are found by ``pattern``), then each format is one scan.  Returns
    None when no month has data."""
    wanted = (F.col("year") * 100 + F.col("month")).isin(*[m.year * 100 + m.month for m in months])
    found = with_months(landed_files(spark, base), pattern).where(wanted & F.col("format").isin("csv", "parquet"))
    rank = (F.col("format") != prefer).cast("int")
    best = found.groupBy("year", "month").agg(F.min_by("format", rank).alias("format"))
    chosen = found.join(best, ["year", "month", "format"], "left_semi").groupBy("format").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    paths = {r.format: list(r.paths) for r in chosen.collect()}
    frames = []
    if "csv" in paths:
        frames.append(read_csv(spark, paths["csv"], csv_schema))
    if "parquet" in paths:
        frames.append(spark.read.schema(csv_schema).parquet(*paths["parquet"]))
    return reduce(DataFrame.unionByName, frames) if frames else None


# ------------------------------------------------------------------ seeds
def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small CSV lookup with typed columns (checks: farebox.operators.quality)."""
    return read_csv(spark, path, schema)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows given in code or a pandas frame."""
    return spark.createDataFrame(rows, schema)


def range_extract(df: DataFrame, cols: Sequence[str], time_col: str, start, end) -> DataFrame:
    """Column subset of rows with ``start <= t < end`` (pushed to the scan)."""
    return df.select(*cols).filter(
        (F.col(time_col) >= F.lit(start).cast("timestamp")) & (F.col(time_col) < F.lit(end).cast("timestamp"))
    )


def external_view(spark: SparkSession, name: str, glob: str, schema: T.StructType | None = None) -> DataFrame:
    """A named view over a Parquet glob (schema from the file
    footers unless given); later code refers to it by name."""
    df = read_parquet(spark, glob, schema)
    df.createOrReplaceTempView(name)
    return spark.table(name)
