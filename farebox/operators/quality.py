"""Declarative data checks (Q1–Q13).

All column checks of one table are folded into a single aggregate pass
(``count_if`` per rule); a uniqueness rule needs one grouped pass per key.
Results are DataFrames – one row per rule – so a caller can store, join or
assert them; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.joins import anti_join

CHECKS = ("not_null", "non_negative", "positive")


def _violation(check: str, c: Column) -> Column:
    if check == "not_null":
        return c.isNull()
    if check == "non_negative":
        return c < 0
    if check == "positive":
        return c <= 0
    raise ValueError(f"unknown check {check}")


def column_checks(df: DataFrame, rules: Mapping[str, Sequence[str]], table: str = "") -> DataFrame:
    """Q1, Q3, Q4: one scan; rows ``(table_name, column_name, check_name,
    failures, passed)``.  A null value does not fail ``non_negative`` or
    ``positive`` (it is the ``not_null`` rule's business)."""
    aggs, names = [], []
    for col, checks in rules.items():
        for check in checks:
            alias = f"{col}__{check}"
            aggs.append(F.count_if(_violation(check, F.col(col))).alias(alias))
            names.append((col, check, alias))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{k}', `{a}`" for c, k, a in names)
    long = wide.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, check_name, failures)")
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "check_name",
        F.col("failures").cast("long").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def rule_metrics(rules: Mapping[str, Sequence[str]]) -> list[Column]:
    """A count of violations per rule, named ``column__check``."""
    return [F.count_if(_violation(check, F.col(col))).alias(f"{col}__{check}") for col, checks in rules.items() for check in checks]


def rule_rows(spark: SparkSession, counts: Mapping[str, int], rules: Mapping[str, Sequence[str]], table: str = "") -> DataFrame:
    """The report rows of counts by ``column__check`` (one row per rule)."""
    rows = [(table, col, check, int(counts.get(f"{col}__{check}") or 0)) for col, checks in rules.items() for check in checks]
    out = spark.createDataFrame(rows, "table_name string, column_name string, check_name string, failures long")
    return out.withColumn("passed", F.col("failures") == 0)


def observed_write(df: DataFrame, rules: Mapping[str, Sequence[str]], write, table: str = "") -> DataFrame:
    """Q1, Q3, Q4, Q12 as a by-product of a write: ``write(frame)`` runs one
    action over the rows, and the violations are counted as they pass – no
    second scan and no recomputation of ``df``.  Returns the report rows."""
    seen = Observation()
    write(df.observe(seen, *rule_metrics(rules)))
    return rule_rows(df.sparkSession, seen.get, rules, table)


def unique_check(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """Q2 / Q11: number of key values (non-null) held by more than one row.
    Rows with a null in any key column are not counted as duplicates."""
    cols = list(cols)
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    dup_keys = (
        df.filter(not_null).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    )
    return dup_keys.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(cols)).alias("column_name"),
        F.lit("unique").alias("check_name"),
        F.col("failures").cast("long").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def checks_with_unique(df: DataFrame, rules: Mapping[str, Sequence[str]], unique_cols: Sequence[str],
                       table: str = "") -> DataFrame:
    """Column rules and one uniqueness rule in a single pass: rows are grouped
    by the unique key (partial aggregation map-side) carrying per-rule
    violation counts, and one more aggregate over the groups adds them up and
    counts keys held by more than one row.  Same rows as
    ``report(column_checks(...), unique_check(...))`` without a second scan."""
    unique_cols = list(unique_cols)
    names = [(col, check, f"{col}__{check}") for col, checks in rules.items() for check in checks]
    grouped = df.groupBy(*unique_cols).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(_violation(check, F.col(col))).alias(alias) for col, check, alias in names],
    )
    key_present = F.lit(True)
    for c in unique_cols:
        key_present = key_present & F.col(c).isNotNull()
    wide = grouped.agg(
        *[F.sum(alias).alias(alias) for _c, _k, alias in names],
        F.count_if(key_present & (F.col("_n") > 1)).alias("_dup_keys"),
    )
    parts = [f"'{c}', '{k}', `{a}`" for c, k, a in names]
    parts.append(f"'{','.join(unique_cols)}', 'unique', `_dup_keys`")
    long = wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) AS (column_name, check_name, failures)")
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "check_name",
        F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures"),
        (F.coalesce(F.col("failures"), F.lit(0)) == 0).alias("passed"),
    )


def report(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


OPERATORS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def custom_check(name: str, scalar: DataFrame, expected, operator: str = "=") -> DataFrame:
    """Q5: a one-row, one-column query compared with an expected value."""
    value_col = scalar.columns[0]
    actual = F.col(value_col).cast("long")
    return scalar.select(
        F.lit(name).alias("check_name"),
        actual.alias("actual"),
        F.lit(expected).cast("long").alias("expected"),
        F.coalesce(OPERATORS[operator](actual, F.lit(expected)), F.lit(False)).alias("passed"),
    )


def exists_indicator(df: DataFrame, name: str = "ok") -> DataFrame:
    """1 if the frame has a row, else 0.  ``limit(1)`` stops the scan at
    the first row."""
    return df.limit(1).agg(F.when(F.count(F.lit(1)) > 0, F.lit(1)).otherwise(F.lit(0)).alias(name))


def null_tally(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, the number of null values (one pass, long format)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_count)").select(
        "column_name", F.col("null_count").cast("long").alias("null_count")
    )


def missing_periods(df: DataFrame, time_col: str, unit: str = "day") -> DataFrame:
    """Q8 + J7: periods between the first and last period of the data that hold
    no row.  The expected grid has one row per period (bounded by the time
    span, not by the data) and is anti-joined with the present periods."""
    step = {"day": "1 day", "month": "1 month", "year": "1 year"}[unit]
    trunc = {"day": "DD", "month": "MM", "year": "YEAR"}[unit]
    period = F.trunc(F.to_date(F.col(time_col)), trunc) if unit != "day" else F.to_date(F.col(time_col))
    present = df.select(period.alias("period")).filter(F.col("period").isNotNull()).distinct()
    bounds = present.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    grid = bounds.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias("period"))
    return anti_join(grid, present, ["period"])


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Q13: column-by-column comparison of two schemas (full outer join on the
    name); tiny frames built from the schemas, not from the data."""
    spark = left.sparkSession
    st = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("type", T.StringType())])
    l_df = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in left.schema], st)
    r_df = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in right.schema], st)
    return (
        l_df.withColumnRenamed("type", "left_type")
        .join(r_df.withColumnRenamed("type", "right_type"), "column_name", "full")
        .withColumn("same", F.coalesce(F.col("left_type") == F.col("right_type"), F.lit(False)))
        .orderBy("column_name")
    )


def schema_ddl(df: DataFrame) -> str:
    """Q13: the schema as DDL text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
