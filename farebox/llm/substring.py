"""Repeated word passages by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its minimiser is
the m-word run with the smallest hash inside it; consecutive windows sharing
one minimiser travel as one packed string (a super-k-mer) to the bucket of
the minimiser, so equal windows always meet.  There the windows are sorted and
each run of equal ones, compared word for word, yields the smallest document
they start in; the windows of every later document are spans to remove.

Before the exchange each task keeps, of equal super-k-mers, only those of the
smallest document it has seen and decides the others at once: a passage in a
third of all documents reaches its bucket at most once per task and flush.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farebox.llm import packed
from farebox.llm.common import Roller, first_by, flat, keyed_texts, mix, ready, row_chunks, text_bytes, window_anchors, words

_ODD = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def run_hash(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (in the whole array)."""
    if len(word_hash) < n:
        return word_hash[:0]
    out = np.zeros(len(word_hash) - n + 1, dtype=np.uint64)
    for j in range(n):
        out = out * _ODD[0] + word_hash[j : len(word_hash) - n + 1 + j] * _ODD[1 + j % 7]
    return mix(out)


def super_kmers(data, offsets, window: int, m: int, roller: Roller):
    """(row, first word of the row, windows, byte start, byte end, minimiser
    hash) of every super-k-mer of the rows."""
    start, end, row = words(data, offsets)
    z = np.zeros(0, np.int64)
    if len(start) < window:
        return z, z, z, z, z, z.astype(np.uint64)
    hashes = roller.ranges(roller.prefix(data), start, end)
    small = run_hash(hashes, m)
    anchor = window_anchors(small, window - m + 1)
    ok = row[: len(row) - window + 1] == row[window - 1 :]
    at = np.flatnonzero(ok)
    if not len(at):
        return z, z, z, z, z, z.astype(np.uint64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[at[1:]] != anchor[at[:-1]])
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    first_word = np.searchsorted(row, np.arange(len(offsets) - 1))
    return row[first], first - first_word[row[first]], count, start[first], end[first + count + window - 2], small[anchor[first]]


def hashed_words(data, offsets, roller: Roller):
    """(start, end, row, hash) of all words, a few megabytes at a time."""
    parts = []
    for lo, hi in row_chunks(offsets):
        base = offsets[lo]
        piece = data[base : offsets[hi]]
        start, end, row = words(piece, offsets[lo : hi + 1] - base)
        parts.append((start + base, end + base, row + lo, roller.ranges(roller.prefix(piece), start, end)))
    return [np.concatenate(x) for x in zip(*parts)]


class _Sender:
    """Collects the super-k-mers of a task and flushes them by bucket."""

    def __init__(self, window: int, m: int, buckets: int):
        self.window, self.m, self.buckets = window, m, buckets
        self.roller = Roller()
        self.parts, self.size = [], 0

    def add(self, ids, ths, data, offsets):
        row, first, count, a, b, h = super_kmers(data, offsets, self.window, self.m, self.roller)
        if not len(row):
            return
        prefix = self.roller.prefix(data)
        content = self.roller.ranges(prefix, a, b)
        text = packed.slices(data, a, b)
        self.parts.append((ids[row], ths[row], first.astype(np.int32), count.astype(np.int32), (b - a).astype(np.int32), (h % np.uint64(self.buckets)).astype(np.int32), content, text))
        self.size += len(text) + 40 * len(row)

    def flush(self):
        if not self.parts:
            return
        doc, th, first, count, size, bucket, content = (np.concatenate([p[k] for p in self.parts]) for k in range(7))
        text = np.concatenate([p[7] for p in self.parts])
        self.parts, self.size = [], 0  # the parts are freed before the blobs are made
        at = packed.offsets_of(size)
        # Equal strings: those of later documents are decided here.
        order, new = first_by(content, doc, th, first)
        lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        same = size[order] == size[lead]
        later = same & (doc[order] > doc[lead])
        repeat = same & (order != lead)
        if later.any() or repeat.any():  # confirm on the bytes themselves
            view = memoryview(text)
            for k in np.flatnonzero(repeat).tolist():
                i, j = order[k], lead[k]
                if view[at[i] : at[i + 1]] != view[at[j] : at[j + 1]]:
                    later[k] = False
        gone = np.zeros(len(doc), dtype=bool)
        gone[order[later]] = True
        out = []
        for b, group in packed.split_by(bucket):
            keep, drop = group[~gone[group]], group[gone[group]]
            blob = packed.dump(
                doc[keep], th[keep], first[keep], count[keep], size[keep], packed.slices(text, at[keep], at[keep + 1]),
                doc[drop], th[drop], first[drop], count[drop], level=3,
            )
            out.append((b, blob))
        yield packed.batch(out)


def _decide(blobs: list[bytes], window: int):
    """Spans (doc, th, first word, words) to remove in one bucket."""
    got = [packed.load(b) for b in blobs]
    doc, th, first, count, size = (np.concatenate([g[k] for g in got]) for k in range(5))
    spans = [tuple(np.concatenate([g[6 + k] for g in got]) for k in range(4))]
    if len(doc):
        data = np.concatenate([g[5] for g in got])
        offsets = packed.offsets_of(size)
        start, end, row, hashes = hashed_words(data, offsets, Roller())
        win = run_hash(hashes, window)
        at = np.flatnonzero(row[: len(row) - window + 1] == row[window - 1 :])
        owner = row[at]
        order, new = first_by(win[at], doc[owner])
        lead_pos = np.flatnonzero(new)
        size_of = np.diff(np.append(lead_pos, len(order)))
        low = np.repeat(doc[owner[order[lead_pos]]], size_of) if len(lead_pos) else doc[:0]
        many = np.repeat(size_of > 1, size_of)
        if many.any():  # equal hashes: compare the words themselves
            view = memoryview(data)
            lead = np.repeat(order[lead_pos], size_of)
            a, b = start[at], end[at + window - 1]
            suspects = np.flatnonzero(many & (order != lead) & (doc[owner[order]] > low))
            broken = set()
            for k in suspects.tolist():
                i, j = order[k], lead[k]
                x, y = view[a[i] : b[i]], view[a[j] : b[j]]
                if x != y and bytes(x).split() != bytes(y).split():
                    broken.add(int(np.searchsorted(lead_pos, k, side="right")) - 1)
            for g in broken:  # a hash collision: smallest document per word sequence
                span = range(lead_pos[g], lead_pos[g] + size_of[g])
                best: dict[tuple, int] = {}
                for k in span:
                    key = tuple(bytes(view[a[order[k]] : b[order[k]]]).split())
                    best[key] = min(best.get(key, int(doc[owner[order[k]]])), int(doc[owner[order[k]]]))
                for k in span:
                    low[k] = best[tuple(bytes(view[a[order[k]] : b[order[k]]]).split())]
        gone = np.zeros(len(at), dtype=bool)
        gone[order] = doc[owner[order]] > low
        hit = np.flatnonzero(gone)
        if len(hit):
            new = np.ones(len(hit), dtype=bool)
            new[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
            begin = hit[new]
            runs = np.diff(np.append(np.flatnonzero(new), len(hit)))
            own = owner[begin]
            head = np.searchsorted(owner, np.arange(len(doc)))
            spans.append((doc[own], th[own], (first[own] + begin - head[own]).astype(np.int32), runs.astype(np.int32)))
    doc, th, first, count = (np.concatenate([s[k] for s in spans]) for k in range(4))
    return doc, th, first, count + (window - 1)


def substring_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, minimiser_words: int = 3, bucket_bytes: int = 4 << 20, flush_bytes: int = 8 << 20,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: ``id, n_words, n_removed, kept`` (binary: the
    untouched text unless something was removed, else the kept runs of words
    joined by one space), ``kept_sha256`` (of the kept words, so joined) and
    the ``carry`` columns as strings.

    Every word covered by a ``window``-word string that also starts in a
    document with a smaller id goes.  Null text reads as empty; null ids count
    as larger than all others; rows that share an id never remove each other's
    words.  Texts shorter than a window stay whole.  Other columns are ignored;
    an empty table gives no rows."""
    ready(df.sparkSession)
    texts = keyed_texts(df, id_col, text_col)
    buckets = packed.bucket_count(text_bytes(texts, "_text"), bucket_bytes)

    def send(batches):
        sender = _Sender(window, minimiser_words, buckets)
        for b in batches:
            ids, ths = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = flat(b.column(2))
            for lo, hi in row_chunks(offsets):
                sender.add(ids[lo:hi], ths[lo:hi], data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                if sender.size >= flush_bytes:
                    yield from sender.flush()
        yield from sender.flush()

    def decide(tab: pa.Table) -> pa.Table:
        doc, th, first, n = _decide(tab.column("blob").to_pylist(), window)
        return packed.blob_table([(b, packed.dump(doc[g], th[g], first[g], n[g])) for b, g in packed.split_by(packed.row_bucket(doc, th, buckets))])

    carry = carry or []
    docs = packed.pack_documents(keyed_texts(df, id_col, text_col, carry), buckets, flush_bytes)
    spans = packed.spread(texts.mapInArrow(send, packed.BLOBS), buckets).groupBy("bucket").applyInArrow(decide, packed.BLOBS)
    return packed.cut_documents(docs, spans, buckets, _cut, "id long, n_words long, n_removed long, kept binary, kept_sha256 string", carry)


def _cut(doc: int, text: bytes, spans: list | None) -> tuple:
    if not spans:
        w = text.split()
        return doc, len(w), 0, text, hashlib.sha256(b" ".join(w)).hexdigest()
    start, end, _ = words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    gone = packed.merge_spans(spans, len(start))
    kept, at = [], 0
    for a, z in [*gone, (len(start), len(start))]:
        if a > at:
            kept.append(text[start[at] : end[a - 1]])
        at = z
    out = b" ".join(kept)
    return doc, len(start), sum(z - a for a, z in gone), out, hashlib.sha256(b" ".join(out.split())).hexdigest()
