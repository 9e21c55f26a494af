"""Batch sinks and materialisation.

Replacing part of a table (K12) never reads and overwrites the same path in
one plan: the merged rows are saved by a checkpoint first, then Spark
overwrites the touched folders.  A rerun of an interval gives the same content.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators.joins import anti_join
from farebox.session import ensure_checkpoint_dir
from farebox.sources.files import try_read
from farebox.sources.inventory import landed_files, partition_values


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    files: int | None = None,
    shuffle: bool = True,
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
    cluster: bool = False,
) -> None:
    """K1–K5, K14, K22.  ``files`` with ``shuffle`` repartitions (balanced
    files, one exchange); without ``shuffle`` it coalesces (no exchange, but
    the last stage runs with ``files`` tasks).  ``cluster`` (with
    ``partition_by``) rebalances rows by the partition values, so the number of
    files follows the size: small directories are written by one task each,
    several to a task, and AQE splits a large one at its advisory size.
    ``mode`` is Spark's: overwrite, append, ignore or
    errorifexists."""
    if files:
        df = df.repartition(files) if shuffle else df.coalesce(files)
    elif partition_by and cluster:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)


def write_partitioned_clustered(df: DataFrame, path: str, partition_col: str, cluster_col: str, mode: str = "overwrite") -> None:
    """One directory per ``partition_col`` value, files sorted by
    ``cluster_col``.  The rebalance leaves the number of files to AQE: small
    partitions are written by one task, a large one is split by size."""
    placed = df.hint("rebalance", partition_col).sortWithinPartitions(partition_col, cluster_col)
    placed.write.mode(mode).partitionBy(partition_col).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, cols: Sequence[str], rows_per_bucket: int = 5_000_000, sort: Sequence[str] = (), least: int = 8) -> DataFrame:
    """A catalog table at ``path``, bucketed and sorted by ``cols``.

    Joins and aggregates on ``cols`` read it without an exchange, a filter on
    them reads the buckets of its values only.  The rows are counted once on a
    checkpoint, so the number of buckets follows the size; the exchange before
    the write has the buckets' own hash, so each bucket is one file."""
    saved = materialize(df)
    buckets = max(least, -(-saved.count() // rows_per_bucket))
    placed = saved.repartition(buckets, *cols)
    order = list(dict.fromkeys([*cols, *sort]))
    placed.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *cols).sortBy(*order).saveAsTable(table)
    return df.sparkSession.table(table)


def append_with_stamp(df: DataFrame, path: str, stamp: dt.datetime, column: str = "extracted_at",
                      partition_by: Sequence[str] = ()) -> None:
    """Append with a load-time column."""
    write_table(df.withColumn(column, F.lit(stamp).cast("timestamp")), path, mode="append", partition_by=partition_by)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint into the cluster's
    checkpoint folder (``spark.checkpoint.dir``); later stages re-read the
    saved data instead of recomputing, and a lost executor does not force a
    recomputation from the sources."""

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_missing_partitions(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Land only partitions the target does not have yet (anti join
    on the partition values), so a rerun adds nothing twice.  What is there
    comes from the listing, not from the data."""
    present = partition_values(landed_files(df.sparkSession, path), [df.schema[c] for c in cols])
    write_table(anti_join(df, present, cols), path, mode="append", partition_by=cols, cluster=True)


class PartitionedTable:
    """A Parquet table in one folder (``fb_part``) per time unit of
    a column, or per hash bucket of some columns.

    A change reads the folders it touches, saves the merged rows by a
    checkpoint, and overwrites exactly the folders those rows fall in
    (``partitionOverwriteMode=dynamic``).  The work is that of the touched
    folders.  A rerun gives the same rows; a run that dies while Spark moves the
    new folders in place is repaired by running it again."""

    PART = "fb_part"

    def __init__(self, path: str, keys: str | Sequence[str], unit: str | None = "month", buckets: int = 16):
        self.path = path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.unit = unit
        self.buckets = buckets

    def part(self) -> Column:
        """Folder of a row: first day of its time unit, or a hash bucket."""
        if self.unit is None:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return self._first_day(F.col(self.keys[0]))

    def _first_day(self, at: Column) -> Column:
        return F.trunc(F.to_date(at), "MM") if self.unit == "month" else F.to_date(at)

    def parts(self, spark: SparkSession) -> DataFrame | None:
        """The rows with their folder, or None before the first write."""
        return try_read(lambda: spark.read.parquet(self.path))

    def read(self, spark: SparkSession) -> DataFrame | None:
        rows = self.parts(spark)
        return None if rows is None else rows.drop(self.PART)

    def overwrite(self, rows: DataFrame) -> None:
        """The folders that ``rows`` fall in get these rows, others stay.  AQE
        splits a large folder over tasks and joins small ones."""
        placed = rows.withColumn(self.PART, self.part()).hint("rebalance", self.PART)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.PART).parquet(self.path)

    def replace_interval(self, new_rows: DataFrame, start, end, granularity: str = "timestamp") -> None:
        """Rows whose time lies in the interval are replaced by
        ``new_rows`` in the interval; others (a null time too) are kept.
        ``timestamp``: ``[start, end)``; ``date``: both dates included."""
        spark, key = new_rows.sparkSession, F.col(self.keys[0])
        if granularity == "date":
            low, high = F.lit(start).cast("date"), F.lit(end).cast("date")
            inside, last = key.between(low, high), high
        else:
            low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
            inside, last = (key >= low) & (key < high), high - F.expr("INTERVAL 1 MICROSECOND")
        current = self.parts(spark)
        if current is None:
            return self.overwrite(new_rows.where(inside))
        # A bound on the folder column: other folders are not listed further or read.
        touched = current.where(F.col(self.PART).between(self._first_day(low), self._first_day(last)))
        kept = touched.where(~inside | key.isNull()).drop(self.PART)
        merged = materialize(kept.unionByName(new_rows.where(inside).select(*kept.columns)))
        filled = merged.select(self.part().alias(self.PART)).distinct()
        # Dynamic overwrite leaves a folder alone that no row falls in: those are emptied one by one.
        emptied = [r[0] for r in anti_join(touched.select(self.PART).distinct(), filled, [self.PART]).collect()]
        self.overwrite(merged)
        for part in emptied:
            merged.limit(0).write.mode("overwrite").parquet(f"{self.path}/{self.PART}={part}")


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int = 100_000) -> dict:
    """Options for ``format('jdbc')`` (credentials come from the
    caller; nothing is read from the environment)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def write_jdbc(df: DataFrame, options: dict, replace: bool = False) -> None:
    """K6 (append in batches) / K7 (replace the table, keep its definition
    with ``truncate``, then append)."""
    w = df.write.format("jdbc").options(**options)
    if replace:
        w = w.option("truncate", "true").mode("overwrite")
    else:
        w = w.mode("append")
    w.save()


def read_jdbc(spark: SparkSession, options: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8) -> DataFrame:
    """A database table, read in ``partitions`` parallel ranges when a
    numeric partition column is given."""
    r = spark.read.format("jdbc").options(**options)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", partitions))
    return r.load()


def warehouse_write(df: DataFrame, fmt: str, options: dict, mode: str = "overwrite") -> None:
    """K8: a connector write whose options (project, dataset, table, staging
    bucket, write method, partition / cluster fields) come from the caller."""
    df.write.format(fmt).options(**options).mode(mode).save()
