"""Helpers shared by the corpus operators.

Texts travel as binary columns.  A row of a table is identified by its integer
id *and* a 64-bit hash of its text, so that repeated ids with different texts
stay apart and true repeats (same id, same text) behave as one document.  A
null id is ordered after every other id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import ensure_checkpoint_dir, prepare

#: Internal id of rows whose id is null: after every real id.
NULL_ID = (1 << 63) - 1

#: Bytes of text that one vectorised pass handles at a time.
CHUNK_BYTES = 1 << 21

#: White space of the word definition, a fixed value: 0x20 and 0x09-0x0D.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def ready(spark: SparkSession) -> SparkSession:
    """Session options the operators rely on: UTC, AQE, small Arrow batches
    (bounded memory per Python worker) and a checkpoint folder."""
    prepare(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def row_key(id_col: str, text_col: str) -> list[Column]:
    """(``_id``, ``_th``, both long): identity of a document row.  All rows
    without an id share one, so their texts alone keep them apart."""
    return [
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("binary")).alias("_th"),
    ]


def smallest_by(df: DataFrame, but: list[str]) -> Column:
    """A row's columns that have an order, ``but`` some: chooses one of several
    rows that agree in those."""
    unordered = ("map<", "variant")
    return F.struct(F.lit(0).alias("_0"), *[F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in but and not any(x in f.dataType.simpleString() for x in unordered)])


def keyed_texts(df: DataFrame, id_col: str, text_col: str, carry: list[str] = ()) -> DataFrame:
    """``_id, _th, _text`` (binary; null text reads as empty) and the carried
    columns as binary."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    more = [F.col(f"`{c}`").cast("string").cast("binary").alias(f"_carry{i}") for i, c in enumerate(carry)]
    return df.select(*row_key(id_col, text_col), text.alias("_text"), *more)


#: Group tables up to this many rows and bytes of key text are broadcast.
SMALL_ROWS, SMALL_BYTES = 100_000, 32 << 20
#: Parts of every group when the group table is larger.
GROUP_PARTS = 64


def is_small(groups: DataFrame, keys: list[str]) -> bool:
    """Whether a table with one row per group may be broadcast, by its measured
    rows and key bytes (one job; checkpoint the table first)."""
    text = F.octet_length(F.concat_ws("", *[F.col(k).cast("string") for k in keys]))
    rows, size = groups.agg(F.count("*"), F.coalesce(F.sum(text), F.lit(0))).first()
    return rows <= SMALL_ROWS and size <= SMALL_BYTES


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], small: bool, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their group (``keys`` not null, one row
    each in ``groups``), without bringing a group's rows into one task: a
    ``small`` table is broadcast, a larger one is repeated for each part that
    the rows of a group are dealt to."""
    if small:
        return rows.join(F.broadcast(groups), keys, how)
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(GROUP_PARTS)).cast("int")
    each = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1))))
    return rows.withColumn("_part", part).join(each, [*keys, "_part"], how).drop("_part")


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Total bytes of a text column (one narrow aggregate)."""
    row = df.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("binary")).cast("long"))).first()
    return int(row[0] or 0)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow binary column without nulls (no copy)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _valid, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


# ------------------------------------------------------------- rolling hashes
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur-style) over an unsigned array."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


class Roller:
    """Polynomial hashes of byte ranges, modulo 2**64, from one prefix sum."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self, seed: int = 11):
        self.table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.size = 0

    def twin(self, seed: int) -> Roller:
        """Another hash of the same text, which shares the powers."""
        other = Roller(seed)
        if self.size:
            other.size, other.up, other.down = self.size, self.up, self.down
        return other

    def _grow(self, n: int) -> None:
        if n <= self.size:
            return
        n = max(n, CHUNK_BYTES + 1)
        base, inverse = np.uint64(self.BASE), np.uint64(pow(self.BASE, -1, 1 << 64))
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        self.up = np.multiply.accumulate(steps)
        steps[1:] = inverse
        self.down = np.multiply.accumulate(steps)
        self.size = n

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.up[:n], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], equal for equal contents."""
        return mix((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in log(width) passes."""
    if len(a) < width:
        return a[:0]
    span = 1
    while span * 2 <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    if span < width:
        a = np.minimum(a[: len(a) - (width - span)], a[width - span :])
    return a


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values: the position of its smallest
    value (leftmost on ties), which depends on the window's content alone."""
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    packed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    return (sliding_min(packed, width) & low).astype(np.int64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of the rows in ``data``."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    space = _IS_SPACE[data]
    first = np.empty(n, dtype=bool)
    first[0] = True
    first[1:] = space[:-1]
    edges = offsets[1:-1]
    first[edges[edges < n]] = True
    start = np.flatnonzero(first & ~space)
    last = np.empty(n, dtype=bool)
    last[-1] = True
    last[:-1] = space[1:]
    inner = edges[(edges > 0) & (edges <= n)] - 1
    last[inner] = True
    end = np.flatnonzero(last & ~space) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def first_by(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, is_first): rows sorted by the keys (first key first) and, in
    that order, whether a row begins a new value of the first key."""
    order = np.lexsort(keys[::-1])
    lead = keys[0][order]
    new = np.empty(len(order), dtype=bool)
    if len(order):
        new[0] = True
        new[1:] = lead[1:] != lead[:-1]
    return order, new


def worker_cache(name: str, make):
    """An object kept by the Python worker between tasks."""
    import sys
    import types

    holder = sys.modules.setdefault("_farebox_worker_cache", types.ModuleType("_farebox_worker_cache"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)
