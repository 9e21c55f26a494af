"""Packed exchange: many small records for one bucket travel as one
compressed row, and documents travel to their spans in packed groups."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import NULL_ID, flat, mix


def dump(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays (any 1-d dtype) as one compressed blob."""
    head, body = [struct.pack("<i", len(arrays))], []
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        head.append(struct.pack("<2sq", a.dtype.str[1:].encode(), len(raw)))
        body.append(raw)
    return zstandard.ZstdCompressor(level=level).compress(b"".join(head + body))


def load(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<i", raw)
    at, out = 4 + 10 * n, []
    for k in range(n):
        kind, size = struct.unpack_from("<2sq", raw, 4 + 10 * k)
        out.append(np.frombuffer(raw, dtype="<" + kind.decode(), count=size // int(kind[1:]), offset=at))
        at += size
    return out


def slices(data, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bytes of the ranges [start, end) of ``data``, one after the other."""
    view = memoryview(data)
    return np.frombuffer(b"".join([view[a:b] for a, b in zip(start.tolist(), end.tolist())]), dtype=np.uint8)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def bucket_count(total_bytes: int, bucket_bytes: int) -> int:
    """Buckets so that each holds about ``bucket_bytes`` of text."""
    return max(8, -(-total_bytes // bucket_bytes))


def spread(blobs: DataFrame, buckets: int) -> DataFrame:
    """Rows of one bucket to one place, before a grouped map."""
    return blobs.repartition(min(buckets, 4 * int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "bucket")


def split_by(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, positions) of every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    if not len(order):
        return []
    return [(int(bucket[g[0]]), g) for g in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)]


def row_bucket(doc: np.ndarray, th: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a document row by its identity."""
    key = mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + th.astype(np.int64).view(np.uint64))
    return (key % np.uint64(buckets)).astype(np.int32)


#: Columns of a packed exchange.
BLOBS = "bucket int, blob binary"


def batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "blob"])


def blob_table(rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([batch(rows)])


def concat(blobs: list[bytes]) -> list[np.ndarray]:
    got = [load(b) for b in blobs]
    return [np.concatenate([g[i] for g in got]) for i in range(len(got[0]))]


def pack_documents(source: DataFrame, buckets: int, flush_bytes: int) -> DataFrame:
    """``_id, _th, _text`` rows as blobs (ids, hashes, lengths, bytes) by the
    bucket of the row, compressed together.  Further columns (binary) ride
    along, each as null flags, lengths and bytes."""

    def flush(held):
        columns = list(zip(*held))
        held.clear()  # the pieces are freed column by column
        ids, ths, lens, data, *more = [np.concatenate(columns.pop(0)) for _ in range(len(columns))]
        at = offsets_of(lens)
        ats = [offsets_of(x) for x in more[1::3]]
        out = []
        for bucket, g in split_by(row_bucket(ids, ths, buckets)):
            rest = [x for k, a in enumerate(ats) for x in (more[3 * k][g], more[3 * k + 1][g], slices(more[3 * k + 2], a[g], a[g + 1]))]
            out.append((bucket, dump(ids[g], ths[g], lens[g], slices(data, at[g], at[g + 1]), *rest, level=3)))
        return batch(out)

    def pack(batches):
        held, size = [], 0
        for b in batches:
            ids, ths = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = flat(b.column(2))
            row = [ids, ths, np.diff(offsets), np.array(data)]
            for column in b.columns[3:]:
                text, at = flat(column.fill_null(b""))
                row += [column.is_null().to_numpy(zero_copy_only=False), np.diff(at), np.array(text)]
            held.append(row)
            size += len(data)
            if size >= flush_bytes:
                yield flush(held)
                size = 0
        if held:
            yield flush(held)

    return spread(source.mapInArrow(pack, BLOBS), buckets)


def cut_documents(docs: DataFrame, spans: DataFrame, buckets: int, cut, schema: str, carry: list[str]) -> DataFrame:
    """Rows ``cut(id, text, spans)`` of every packed document with the (start,
    len) spans that were sent to its bucket (blobs of doc, th, start, len),
    and the carried columns as strings."""
    fields = [tuple(f.split()) for f in schema.split(", ")] + [(c, "string") for c in carry]
    names = [f for f, _ in fields]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema([(f, {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[t]) for f, t in fields])
        blobs = left.column("blob").to_pylist()
        if not blobs:
            return kinds.empty_table()
        mine: dict[tuple, list] = {}
        found = right.column("blob").to_pylist()
        if found:
            doc, th, pos, n = (x.tolist() for x in concat(found))
            for i, t, p, m in zip(doc, th, pos, n):
                mine.setdefault((i, t), []).append((p, m))
        tables = []
        for blob in blobs:
            ids, ths, lens, text, *more = load(blob)
            at, view = offsets_of(lens), memoryview(text)
            rows = [cut(i, bytes(view[at[j] : at[j + 1]]), mine.get((i, t))) for j, (i, t) in enumerate(zip(ids.tolist(), ths.tolist()))]
            cols = [list(c) for c in zip(*rows)]
            for k in range(len(carry)):
                null, size, text = more[3 * k : 3 * k + 3]
                a = offsets_of(size)
                cols.append([None if x else bytes(text[a[j] : a[j + 1]]).decode() for j, x in enumerate(null)])
            tables.append(pa.table([pa.array(c, k) for c, k in zip(cols, kinds.types)], names=names))
        return pa.concat_tables(tables)

    out = docs.groupBy("bucket").cogroup(spread(spans, buckets).groupBy("bucket")).applyInArrow(run, ", ".join(f"`{f}` {t}" for f, t in fields))
    return out.withColumn("id", F.when(F.col("id") != NULL_ID, F.col("id")))


def merge_spans(spans: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs [a, b) of the union of (start, len) spans."""
    if not spans:
        return []
    cells = np.array(spans, dtype=np.int64)
    cells[:, 1] += cells[:, 0]
    cells = cells[np.argsort(cells[:, 0], kind="stable")]
    top = np.maximum.accumulate(cells[:, 1])
    new = np.concatenate(([True], cells[1:, 0] > top[:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(cells) - 1]))
    return [(int(a), int(min(b, length))) for a, b in zip(cells[first, 0], top[last])]
