"""Alignment of two tokenizers' tokens over the same bytes.

Texts are cut into units before a space that stands between two other
characters: no token of either vocabulary reaches over such a place, so a unit
is tokenised alone, and equal units of a task are tokenised once.  Everything
after the tokenizers runs on Arrow: id lists are flattened with their parent
indices, token lengths are summed up per unit, an Acero hash join on (unit,
byte end) finds the tokens that end together, and ``Table.group_by`` counts the
id pairs.  Spark adds the partial counts; a second pass over the links, which
the first one wrote to the shared folder, looks the counts up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import flat, join_groups, ready, row_chunks, worker_cache
from farebox.session import shared_dir

#: The mark of a space in pieces, and the alphabet of byte-level entries (every
#: byte as one printable character): fixed values of the two vocabularies.
PIECE_SPACE = "▁"
PRINTABLE = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))


def byte_alphabet() -> dict[str, int]:
    """Character of a byte-level entry -> byte: printable bytes stand for
    themselves, the others for the characters from U+0100 on, in order."""
    own = [b for r in PRINTABLE for b in r]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A tokenizers file with a byte-level vocabulary; special tokens are plain text."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        code = byte_alphabet()
        size = max(self.model.get_vocab(with_added_tokens=True).values()) + 1
        names = [self.model.id_to_token(i) or "" for i in range(size)]
        self.bytes = pa.array([bytes(code[c] for c in t) if all(c in code for c in t) else t.encode() for t in names], pa.large_binary())
        self.safe = True

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        return (e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False))


class Pieces:
    """A sentencepiece model, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = pa.array([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(PIECE_SPACE, " ").encode() for i, p in enumerate(names)], pa.large_binary())
        #: Whether no piece holds a space after another character, so that texts may be cut there.
        self.safe = not any(PIECE_SPACE in p.lstrip(PIECE_SPACE) for p in names)

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        return iter(self.model.encode([t[1:] for t in texts], num_threads=1))


#: Bytes after which a cut may stand before a space (all but a space), and those
#: that may follow it: no white space of any alphabet begins with them.
_BEFORE = np.arange(256) != 0x20
_AFTER = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xF4)):
    _AFTER[_lo : _hi + 1] = True


def cut_units(data: np.ndarray, offsets: np.ndarray, safe: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all units and the end of the data, first unit of each row):
    rows are not empty and each begins with a space."""
    first = np.zeros(len(data), dtype=bool)
    if safe and len(data) > 2:
        first[1:-1] = (data[1:-1] == 0x20) & _BEFORE[data[:-2]] & _AFTER[data[2:]]
    first[offsets[:-1]] = True
    start = np.flatnonzero(first)
    return np.append(start, len(data)), np.searchsorted(start, offsets)


def _lists(rows: Iterator[list[int]]) -> pa.LargeListArray:
    held = list(rows)
    at = np.zeros(len(held) + 1, np.int64)
    np.cumsum([len(r) for r in held], out=at[1:])
    return pa.LargeListArray.from_arrays(pa.array(at), pa.array(np.fromiter(chain.from_iterable(held), np.int64, at[-1])))


def _joined(values: pa.Array, offsets: pa.Array, mark) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, values), pa.scalar(mark, values.type))


def token_ends(ids: pa.LargeListArray, lengths: pa.Array) -> pa.Table:
    """``unit, end, at, id``: every token with its unit and the byte where it
    ends there, by a running sum of lengths less the sum before the unit."""
    token, unit = pc.list_flatten(ids), pc.list_parent_indices(ids)
    run = pc.cumulative_sum(pc.take(lengths, token))
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), run]), pc.take(ids.offsets, unit))
    return pa.table({"unit": unit, "end": pc.subtract(run, before), "at": pa.array(np.arange(len(token))), "id": token})


def align_units(units: pa.Array, a: ByteLevel, b: Pieces) -> pa.Table:
    """One row per unit (distinct bytes): ``unit, ok, n_a, n_b, n_groups,
    n_links, groups`` (as text) and ``links`` (codes a * |B| + b).  A unit
    whose tokens' bytes are not its own has none."""
    texts = [u.decode("utf-8", "replace") for u in units.to_pylist()]
    lists = [_lists(t.encode(texts)) for t in (a, b)]
    spelled = [_joined(pc.take(t.bytes, pc.list_flatten(x)), x.offsets, b"") for t, x in zip((a, b), lists)]
    ok = pc.and_(pc.equal(spelled[0], units), pc.equal(spelled[1], units))
    if not pc.all(ok).as_py():
        none = pa.scalar([], lists[0].type)
        lists = [pc.if_else(ok, x, none) for x in lists]
    ends = [token_ends(x, pc.cast(pc.binary_length(t.bytes), pa.int64())) for t, x in zip((a, b), lists)]
    right = ends[1].rename_columns(["unit", "end", "b_at", "b"])
    links = ends[0].rename_columns(["unit", "end", "a_at", "a"]).join(right, keys=["unit", "end"], join_type="inner", use_threads=False)
    links = links.sort_by([("a_at", "ascending"), ("b_at", "ascending")]).combine_chunks()
    # A group ends behind every token that another one ends with.
    shut = [x[np.flatnonzero(np.diff(x, prepend=-1))] + 1 for x in (links.column(c).to_numpy() for c in ("a_at", "b_at"))]
    edge = [pa.array(np.concatenate(([0], s))) for s in shut]
    parts = [_joined(e.column("id").combine_chunks().cast(pa.large_string()), x, ",") for e, x in zip(ends, edge)]
    group_at = np.searchsorted(shut[0], lists[0].offsets.to_numpy(), side="right")
    groups = _joined(pc.binary_join_element_wise(parts[0], parts[1], pa.scalar("|", pa.large_string())), pa.array(group_at.astype(np.int64)), ";")
    code = pc.add(pc.multiply(links.column("a"), len(b.bytes)), links.column("b"))
    code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
    link_at = np.searchsorted(links.column("unit").to_numpy(), np.arange(len(units) + 1)).astype(np.int64)
    return pa.table({
        "unit": units, "ok": ok, "n_a": np.diff(lists[0].offsets.to_numpy()), "n_b": np.diff(lists[1].offsets.to_numpy()), "n_groups": np.diff(group_at),
        "n_links": np.diff(link_at), "groups": groups, "links": pa.LargeListArray.from_arrays(pa.array(link_at), code),
    })


class _Known:
    """The units a task has aligned so far, forgotten beyond ``limit`` bytes."""

    def __init__(self, a: ByteLevel, b: Pieces, limit: int):
        self.a, self.b, self.limit, self.table = a, b, limit, None

    def look_up(self, units: pa.Array) -> pa.Table:
        if self.table is None or self.table.nbytes > self.limit:
            self.table = align_units(units, self.a, self.b)
            return self.table
        new = units.filter(pc.invert(pc.is_in(units, value_set=self.table.column("unit"))))
        if len(new):
            self.table = pa.concat_tables([self.table, align_units(new, self.a, self.b)]).combine_chunks()
        return self.table.take(pc.index_in(units, value_set=self.table.column("unit")))


def _add_up(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])


_DOCUMENTS = "id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pair long, n long"
_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_SCHEMA = pa.schema([(f, _KINDS[t]) for f, t in (c.split() for c in _DOCUMENTS.split(", "))])


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _first_pass(path_a: str, path_b: str, block_bytes: int, known_bytes: int, pair_rows: int):
    def align_rows(ids: pa.Array, texts: pa.Array, known: _Known, row: int, safe: bool):
        n = len(ids)
        data, offsets = flat(pc.binary_join_element_wise(*(pa.scalar(x, texts.type) if isinstance(x, bytes) else x for x in (b" ", texts, b""))))
        start, unit_at = cut_units(data, offsets, safe)
        spans = pa.Array.from_buffers(pa.large_binary(), len(start) - 1, [None, pa.py_buffer(start.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = spans.dictionary_encode()
        table, which = known.look_up(coded.dictionary), coded.indices
        bad = np.add.reduceat(~table.column("ok").to_numpy()[which.to_numpy()], unit_at[:-1]) > 0
        use = np.repeat(~bad, np.diff(unit_at))
        if bad.any():
            which = which.filter(pa.array(use))
            unit_at = np.concatenate(([0], np.cumsum(np.where(bad, 0, np.diff(unit_at)))))
        one = which.to_numpy()
        sums = {}
        for c in ("n_a", "n_b", "n_groups", "n_links"):
            total = np.concatenate(([0], np.cumsum(table.column(c).to_numpy()[one])))
            sums[c] = total[unit_at[1:]] - total[unit_at[:-1]]
        at = pa.array(unit_at.astype(np.int64))
        text = _joined(pc.take(table.column("groups").combine_chunks(), which), at, ";")
        body, cut = flat(text.cast(pa.large_binary()))
        view = memoryview(np.ascontiguousarray(body))
        digest = ["" if bad[i] else hashlib.sha256(view[cut[i] : cut[i + 1]]).hexdigest() for i in range(n)]
        lists = pc.take(table.column("links").combine_chunks(), which)
        codes = pc.list_flatten(lists).to_numpy().astype("<i8")
        ends = np.concatenate(([0], np.cumsum(sums["n_links"])))
        press = zstandard.ZstdCompressor(level=1)
        packed = [press.compress(codes[ends[i] : ends[i + 1]].tobytes()) for i in range(n)]
        counts = np.bincount(one, minlength=len(table))
        links = table.column("links").combine_chunks()
        weight = pa.array(counts[pc.list_parent_indices(links).to_numpy()])
        pairs = pa.table({"pair": pc.list_flatten(links), "n": weight}).filter(pc.greater(weight, 0))
        rows = np.arange(row, row + n)
        return _batch({"id": ids, "row": rows, **sums, "groups_sha256": digest, "links": packed}), _add_up([pairs])

    def run(batches):
        a, b = (worker_cache(f"{kind.__name__} {path}", lambda: kind(path)) for kind, path in ((ByteLevel, path_a), (Pieces, path_b)))
        known, row, tables = _Known(a, b, known_bytes), TaskContext.get().partitionId() << 40, []
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            there = pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0)
            gone = ids.filter(pc.invert(there))
            if len(gone):
                zero = np.zeros(len(gone), np.int64)
                yield _batch({"id": gone, "row": np.arange(row, row + len(gone)), **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), zero), "groups_sha256": [""] * len(gone), "links": [None] * len(gone)})
                row += len(gone)
            ids, texts = ids.filter(there), texts.filter(there)
            for lo, hi in row_chunks(flat(texts)[1], block_bytes):
                out, pairs = align_rows(ids.slice(lo, hi - lo), texts.slice(lo, hi - lo), known, row, a.safe and b.safe)
                row += hi - lo
                yield out
                tables.append(pairs)
                if sum(t.num_rows for t in tables) > pair_rows:
                    tables = [_add_up(tables)]
                    if tables[0].num_rows > pair_rows // 2:
                        yield _batch({c: tables[0].column(c).combine_chunks() for c in ("pair", "n")})
                        tables = []
        if tables:
            last = _add_up(tables)
            yield _batch({c: last.column(c).combine_chunks() for c in ("pair", "n")})

    return run


def _codes(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i8") if blob else np.zeros(0, np.int64)


def align(
    df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = 4 << 20, known_bytes: int = 96 << 20, pair_rows: int = 1_000_000, broadcast_pairs: int = 4_000_000,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs) of byte-level vocabulary A and piece vocabulary B.

    Documents: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``, one row per row of ``df`` (repeated rows and null ids
    included).  Both tokenizers see a space and the text; links are the A and B
    tokens that end at the same byte, groups the tokens between two such ends;
    a link's count is how often its id pair is linked in the whole table, a
    best link has the highest count of its B id (ties count).  Pairs: ``a, b,
    n, best``.  Null and empty texts, and texts that the tokens do not spell
    byte by byte (such as one with U+2581), have no tokens: zeros and an empty
    digest.  An empty table gives no rows; other columns are ignored.  A unit
    without a space between other characters is tokenised whole, however long.

    Pair counts are broadcast up to ``broadcast_pairs`` of them (16 bytes
    each); beyond that the links are joined with them by key."""
    spark = ready(df.sparkSession).sparkContext
    source = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    path = shared_dir(df.sparkSession, "alignment")
    source.mapInArrow(_first_pass(path_a, path_b, block_bytes, known_bytes, pair_rows), _DOCUMENTS).write.option("compression", "zstd").parquet(path)
    held = df.sparkSession.read.parquet(path)
    docs = held.where(F.col("pair").isNull()).drop("pair", "n")
    size = len(Pieces(path_b).bytes)
    counts = held.where(F.col("pair").isNotNull()).groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % size)
    # One row per B id: bounded by the vocabulary.
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    pairs = counts.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best")).checkpoint()
    table = pairs.select(F.expr(f"pair div {size}").cast("int").alias("a"), (F.col("pair") % size).cast("int").alias("b"), "n", "best")
    if pairs.count() <= broadcast_pairs:
        known = pairs.toArrow()
        order = np.argsort(known.column("pair").to_numpy())
        sent = spark.broadcast(tuple(known.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
        out = docs.mapInArrow(_second_pass(sent), "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
        return out, table
    return _joined_counts(docs, pairs), table


def _second_pass(sent):
    def run(batches):
        pair, n, best = sent.value
        for batch in batches:
            blobs = batch.column("links").to_pylist()
            lists = [_codes(x) for x in blobs]
            at = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
            n_best, total = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            if at[-1]:
                place = np.searchsorted(pair, np.concatenate(lists))
                n_best, total = (np.concatenate(([0], np.cumsum(x[place], dtype=np.int64)))[at] for x in (best, n))
            keep = [batch.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
            names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(np.diff(n_best)), pa.array(np.diff(total)), batch.column("groups_sha256")], names=names)

    return run


def _joined_counts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same figures by joins: distinct pairs of every document with their
    number, dealt to parts so that a frequent pair is not in one task."""

    def spread(batches):
        for batch in batches:
            for row, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pair, times = np.unique(_codes(blob), return_counts=True)
                if len(pair):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), row)), pa.array(pair), pa.array(times)], names=["row", "pair", "times"])

    links = docs.select("row", "links").mapInArrow(spread, "row long, pair long, times long")
    found = join_groups(links, pairs, ["pair"], small=False)
    sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    out = docs.drop("links").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    return out.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
