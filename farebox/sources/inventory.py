"""What lies in a landing: files by folder and format, and their schemas.

The listing is Spark's own (the ``binaryFile`` source without its content
column), so it is a DataFrame of file names and sizes: no data file is opened,
and folders are compared with joins instead of one probe each.  Schemas are
read from the Parquet footers by tasks and reduced to one widest type a column.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How a null partition value is spelled in a folder name (a fixed value).
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

#: Year and month in a path: ``year=2024/month=5`` or ``2024/05``.
MONTH_FOLDER = r"(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/[^/]*$"


def landed_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``path, format, bytes`` of every file below ``paths`` (``glob`` on the
    file name); hidden files do not count.  Nothing there gives no rows."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        found = reader.load(paths if isinstance(paths, str) else list(paths))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, format string, bytes long")
    # The format is the extension, a compression after it left aside.
    kind = F.regexp_extract("path", r"\.([a-z]+)(?:\.(?:gz|bz2|zst|deflate))?$", 1)
    return found.select("path", kind.alias("format"), F.col("length").alias("bytes"))


def with_months(files: DataFrame, pattern: str = MONTH_FOLDER) -> DataFrame:
    """Adds ``year`` and ``month`` from the folder names; other files go."""
    parts = [F.regexp_extract("path", pattern, i).try_cast("int").alias(c) for i, c in ((1, "year"), (2, "month"))]
    return files.select("*", *parts).where("year is not null")


def month_inventory(spark: SparkSession, paths: str | Sequence[str], pattern: str = MONTH_FOLDER) -> DataFrame:
    """``year, month, format, files, bytes``: one row per month and format."""
    files = with_months(landed_files(spark, paths), pattern)
    return files.groupBy("year", "month", "format").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def empty_months(inventory: DataFrame) -> DataFrame:
    """Q8: ``year, month`` between the first and the last landed month that
    hold no file of any format."""
    at = F.make_date("year", "month", F.lit(1))
    span = inventory.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo is not null")
    grid = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m")).select(F.year("m").alias("year"), F.month("m").alias("month"))
    return grid.join(inventory.select("year", "month").distinct(), ["year", "month"], "left_anti")


def partition_values(files: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The distinct partition values that hold a file, from the folder names."""
    def value(f: T.StructField):
        text = F.url_decode(F.regexp_extract("path", f"/{f.name}=([^/]*)/", 1))
        return F.when(text != NULL_FOLDER, text).cast(f.dataType).alias(f.name)

    return files.select(*[value(f) for f in fields]).distinct()


def layout(files: DataFrame) -> DataFrame:
    """Q9: files, bytes and mean size in MB of each folder."""
    mb = 1024.0 * 1024.0
    folder = F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("folder")
    return files.groupBy(folder).agg(F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("bytes"), F.round(F.avg("bytes") / F.lit(mb), 3).alias("mean_mb"))


# ------------------------------------------------------------------ schemas
def _footer_schema(uri: str) -> T.StructType:
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    local = uri.startswith("file:")
    store, path = (fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f:
        found = pq.read_schema(f)
    written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    return T.StructType.fromJson(json.loads(written)) if written else from_arrow_schema(found.remove_metadata())


def footers(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """``path, schema`` (JSON) of every Parquet file, read by tasks."""

    def read(batches):
        for batch in batches:
            paths = batch.column(0)
            schemas = [_footer_schema(p).json() for p in paths.to_pylist()]
            yield pa.RecordBatch.from_arrays([paths, pa.array(schemas, pa.string())], names=["path", "schema"])

    names = files.select("path")
    return (names.repartition(tasks) if tasks else names).mapInArrow(read, "path string, schema string")


def schema_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files) of every schema that occurs among the Parquet files
    below ``paths``, in the order of their first file.  One job; the driver
    gets each distinct schema once, and the file names."""
    files = landed_files(spark, paths, "*.parquet")
    found = footers(files, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = found.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return [(T.StructType.fromJson(json.loads(g.schema)), list(g.paths)) for g in sorted(groups, key=lambda g: g.paths[0])]


def read_drifting(spark: SparkSession, paths: str | Sequence[str], widest, overrides: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """Files whose columns and types drift, as one table: a scan per
    schema that occurs (however many files have it), cast to the widest type a
    column has anywhere (``widest`` reduces the schemas), missing columns
    null.  No file gives an error, as an empty path does."""
    groups = schema_groups(spark, paths)
    if not groups:
        raise FileNotFoundError(f"no Parquet file below {paths}")
    target = widest([s for s, _ in groups], overrides)
    out = None
    for schema, names in groups:
        mine = {f.name for f in schema.fields}
        cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in mine else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
        part = spark.read.schema(schema).parquet(*names).select(*cols)
        out = part if out is None else out.unionAll(part)
    return out
