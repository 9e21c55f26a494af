"""Column -> Column helpers.  All are built-in expressions (codegen, no Python
per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the modelled workloads' outputs.
# Payment code -> name used by the trip fact (codes outside 1..6 -> 'Unknown').
PAYMENT_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_NAME_DEFAULT = "Unknown"
# Vendor id -> name (anything else -> 'Unknown Vendor').
VENDOR_NAMES = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
}
VENDOR_NAME_DEFAULT = "Unknown Vendor"
# Payment lookup seed of the asset pipeline (payment_type_id, payment_type_name).
PAYMENT_LOOKUP_ROWS = [
    (0, "flex_fare"),
    (1, "credit_card"),
    (2, "cash"),
    (3, "no_charge"),
    (4, "dispute"),
    (5, "unknown"),
    (6, "voided_trip"),
]
# Separator of concatenated keys and of tag lists.
KEY_SEPARATOR = "|"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(c, mapping: dict, default) -> Column:
    """Searched CASE: ``when c = k then v ... else default``."""
    c = _col(c)
    expr = None
    for key, value in mapping.items():
        expr = F.when(c == key, F.lit(value)) if expr is None else expr.when(c == key, F.lit(value))
    return expr.otherwise(F.lit(default))


def payment_type_name(c="payment_type") -> Column:
    return case_map(c, PAYMENT_NAMES, PAYMENT_NAME_DEFAULT)


def vendor_name(c="vendor_id") -> Column:
    return case_map(c, VENDOR_NAMES, VENDOR_NAME_DEFAULT)


def col_or_null(columns: Sequence[str], name: str, dtype) -> Column:
    """The column cast to ``dtype`` if the frame has it, else a typed null."""
    if name in set(columns):
        return F.col(name).cast(dtype)
    return F.lit(None).cast(dtype)


def null_safe_text(c) -> Column:
    """``coalesce(cast(c as string), '')``: Spark's plain text of the value
    (doubles of 1e7 and more print with an exponent)."""
    return F.coalesce(_col(c).cast(T.StringType()), F.lit(""))


def concat_key(cols: Sequence, sep: str = KEY_SEPARATOR) -> Column:
    """Null-safe concatenation with a separator (a null part becomes '')."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(null_safe_text(c))
    return F.concat(*parts)


def surrogate_key(cols: Sequence) -> Column:
    """md5 of the null-safe ``|``-joined text of the columns."""
    return F.md5(concat_key(cols))


def money(c) -> Column:
    return _col(c).cast(T.DecimalType(18, 2))


def month_start(c) -> Column:
    """First day of the month of a timestamp or date, as DATE."""
    return F.trunc(F.to_date(_col(c)), "month")


def hours_between(start, end) -> Column:
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(3600.0)


def epoch_ms_to_ts(c) -> Column:
    return F.timestamp_millis(_col(c).cast("long"))


def ts_to_epoch_ms(c) -> Column:
    return F.unix_millis(_col(c))


def parse_event_time(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """String -> timestamp; a malformed or empty string gives null."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def money_text(c, prefix: str = "$") -> Column:
    """Formatted text with 2 decimals, e.g. ``$17.31``."""
    return F.format_string(prefix + "%.2f", _col(c))
