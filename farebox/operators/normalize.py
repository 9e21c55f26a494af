"""Bringing differently named and typed trip sources to one canonical schema
(P5–P9, P20, F10, F12).  Every helper builds one ``select`` – no
``withColumn`` loops, so the plan stays a single projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



# Canonical staged trip (20 columns, this order).
STAGED_COLUMNS: list[tuple[str, T.DataType]] = [
    ("vendor_id", T.LongType()),
    ("rate_code_id", T.LongType()),
    ("pickup_location_id", T.LongType()),
    ("dropoff_location_id", T.LongType()),
    ("pickup_datetime", T.TimestampType()),
    ("dropoff_datetime", T.TimestampType()),
    ("store_and_fwd_flag", T.StringType()),
    ("passenger_count", T.LongType()),
    ("trip_distance", T.DoubleType()),
    ("trip_type", T.LongType()),
    ("fare_amount", T.DecimalType(18, 2)),
    ("extra", T.DecimalType(18, 2)),
    ("mta_tax", T.DecimalType(18, 2)),
    ("tip_amount", T.DecimalType(18, 2)),
    ("tolls_amount", T.DecimalType(18, 2)),
    ("ehail_fee", T.DecimalType(18, 2)),
    ("improvement_surcharge", T.DecimalType(18, 2)),
    ("total_amount", T.DecimalType(18, 2)),
    ("payment_type", T.LongType()),
    ("congestion_surcharge", T.DecimalType(18, 2)),
]

# Source column -> canonical column: shared ones, and two times per service.
SHARED_RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}


def _renames(prefix: str) -> dict[str, str]:
    return {**SHARED_RENAMES, **{f"{prefix}_{t}": t for t in ("pickup_datetime", "dropoff_datetime")}}


GREEN_RENAMES, YELLOW_RENAMES = _renames("lpep"), _renames("tpep")
# Constants for columns a service lacks (yellow has no trip_type / ehail_fee).
YELLOW_DEFAULTS = {"trip_type": 1, "ehail_fee": 0}

# The type each drifting column is cast to where it exists.
DRIFT_CASTS = {
    "VendorID": "long",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "RatecodeID": "long",
    "PULocationID": "long",
    "DOLocationID": "long",
    "passenger_count": "long",
    "trip_distance": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
    "payment_type": "long",
    "trip_type": "long",
    "congestion_surcharge": "double",
}


def rename_time_columns(df: DataFrame, service: str) -> DataFrame:
    """``lpep_*`` / ``tpep_*`` -> ``pickup_datetime`` / ``dropoff_datetime``."""
    prefix = "lpep" if service == "green" else "tpep"
    return df.withColumnsRenamed(
        {f"{prefix}_pickup_datetime": "pickup_datetime", f"{prefix}_dropoff_datetime": "dropoff_datetime"}
    )


def apply_casts(df: DataFrame, casts: Mapping[str, str] = DRIFT_CASTS) -> DataFrame:
    """Cast each listed column that the frame has; others, and columns of
    the wanted type already, pass through.  Text that is no value gives null."""
    have = dict(df.dtypes)
    wanted = {c: t for c, t in casts.items() if c in have and have[c] != t.replace("long", "bigint")}
    return df.select(*[F.col(c).try_cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns])


def common_columns(left: DataFrame, right: DataFrame, keep_left_order: bool = False) -> list[str]:
    """P5: columns both frames have; sorted, or in the left frame's order."""
    right_cols = set(right.columns)
    if keep_left_order:
        return [c for c in left.columns if c in right_cols]
    return sorted(set(left.columns) & right_cols)


def column_diff(left: DataFrame, right: DataFrame) -> list[str]:
    return sorted(set(left.columns) - set(right.columns))


def stage(df: DataFrame, service: str, renames: Mapping[str, str] | None = None,
          defaults: Mapping[str, object] | None = None) -> DataFrame:
    """One source schema -> the canonical 20-column staged trip, with
    explicit casts (money to decimal(18,2)); absent columns become the given
    constant or a typed null."""
    renames = renames or (GREEN_RENAMES if service == "green" else YELLOW_RENAMES)
    defaults = defaults if defaults is not None else ({} if service == "green" else YELLOW_DEFAULTS)
    source_of = {dst: src for src, dst in renames.items()}
    cols = []
    for name, dtype in STAGED_COLUMNS:
        src = source_of.get(name, name)
        if src in df.columns:
            cols.append(F.col(src).cast(dtype).alias(name))
        elif name in defaults:
            cols.append(F.lit(defaults[name]).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


#: Output name, type and source name of the minimal trip projection; ``{t}``
#: is the service's time prefix.
MINIMAL_TRIP = (
    ("pickup_datetime", "timestamp", "{t}_pickup_datetime"),
    ("dropoff_datetime", "timestamp", "{t}_dropoff_datetime"),
    ("pickup_location_id", "int", "PULocationID"),
    ("dropoff_location_id", "int", "DOLocationID"),
    ("passenger_count", "int", "passenger_count"),
    *((money, "double", money) for money in ("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount")),
)
TIME_PREFIX = {"green": "lpep"}


def project_present(df: DataFrame, spec, **names) -> DataFrame:
    """One column per (output, type, source) of ``spec``: the parsed source
    where the frame has it (unparsable text gives null), else a typed null."""
    have = set(df.columns)
    source = [(out, kind, src.format(**names)) for out, kind, src in spec]
    return df.select(*[(F.col(src).try_cast(kind) if src in have else F.lit(None).cast(kind)).alias(out) for out, kind, src in source])


def minimal_trips(df: DataFrame, service: str) -> DataFrame:
    """P7 / M14 input: the rows with a pickup time, any other column optional."""
    trips = project_present(df, MINIMAL_TRIP, t=TIME_PREFIX.get(service, "tpep"))
    return trips.where("pickup_datetime is not null").select("*", F.lit(service).alias("service_type"))


def coalesce_sources(df: DataFrame, alternatives: Mapping[str, Sequence[str]]) -> DataFrame:
    """``out = coalesce(alt1, alt2, ...)`` for each output column; columns
    missing from the frame are skipped (one source may lack one of them)."""
    present = set(df.columns)
    out = []
    for name, alts in alternatives.items():
        have = [F.col(a) for a in alts if a in present]
        if not have:
            raise ValueError(f"none of {list(alts)} present for {name!r}; columns: {sorted(present)}")
        out.append((F.coalesce(*have) if len(have) > 1 else have[0]).alias(name))
    return df.select(*out)


def coalesced_between(df: DataFrame, alternatives: Sequence[str], start=None, end=None) -> DataFrame:
    """P12 over ``coalesce(alternatives)``: rows with the first value that is
    not null in ``[start, end)``.  Written on the plain columns (``a in range``,
    or ``a`` null and ``b in range``, ...), so that it reaches a scan."""
    if start is None and end is None:
        return df
    keep, earlier = F.lit(False), F.lit(True)
    for name in (a for a in alternatives if a in df.columns):
        inside = earlier
        if start is not None:
            inside = inside & (F.col(name) >= F.lit(start).cast("timestamp"))
        if end is not None:
            inside = inside & (F.col(name) < F.lit(end).cast("timestamp"))
        keep, earlier = keep | inside, earlier & F.col(name).isNull()
    return df.where(keep)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """P20: NaN -> null in every floating column."""
    return df.select(
        *[
            F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def strip_zone(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """zoned timestamps -> zone-less (``timestamp_ntz``)."""
    wanted = set(cols)
    return df.select(
        *[F.col(c).cast(T.TimestampNTZType()).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )
