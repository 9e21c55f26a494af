"""Repeated byte strings by suffix arrays.

A byte goes if a ``window``-byte string covers it that also starts earlier
(in a document with a smaller id, or before in the same document).

Suffixes that can share ``window`` bytes are brought together first: every
window contains an anchor (the ``k``-byte run of smallest hash), which depends
on its bytes alone, and consecutive windows with one anchor form a fragment.
Pass one exchanges only anchor hashes and positions; anchors that occur once
cannot lie in a repeated window and end there.  Pass two fetches the text of the
remaining fragments and sends each to the shard of its anchor.  In a shard
equal fragments collapse, and over the different ones that share an anchor a
suffix array is built by linear grouping (``suffix_array``), the anchor being
one symbol; neighbours in the array that agree over a whole window are the
repeats.

Before both exchanges a task decides equal fragments among its own rows, so
a passage of a third of all documents leaves a task once.  An anchor
with more than ``hot`` different fragments is dealt out by the hash of each
whole window instead (two 64-bit hashes), so that it needs no single shard.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farebox.llm import packed
from farebox.llm.common import Roller, flat, keyed_texts, mix, ready, row_chunks, text_bytes, window_anchors


# --------------------------------------------------------------- suffix array
def suffix_array(symbols: list[int]) -> list[int]:
    """Suffix array in linear grouping: first all suffixes are grouped by
    their Lyndon prefix, handling groups from the greatest down and moving the
    previous-smaller suffixes of a handled group up, by how many of its members
    they precede; then the order inside the groups follows from the array
    itself, read left to right.  ``symbols`` must end with its unique minimum."""
    n = len(symbols)
    members: list[set] = []
    group = [0] * n
    for s, at in _by_symbol(symbols):
        for i in at:
            group[i] = len(members)
        members.append(set(at))
    below = list(range(-1, len(members) - 1))  # linked list of groups, ascending
    above = list(range(1, len(members) + 1))
    above[-1] = -1
    previous = [-1] * n
    left = list(range(n))  # nearest position at or before that is not handled yet
    now = len(members) - 1
    while now >= 0:
        mine = members[now]
        if len(mine) == 1:
            (i,) = mine
            x = left[i] = i - 1
            while x >= 0:
                y = left[x]
                if y == x:
                    break
                if y >= 0:
                    left[x] = left[y]
                x = y
            previous[i] = x
            if x >= 0:
                g = group[x]
                rest = members[g]
                if len(rest) > 1:
                    rest.discard(x)
                    _raise_above(members, below, above, group, g, {x})
        else:
            for i in mine:
                left[i] = i - 1
            counts: dict[int, int] = {}
            for i in mine:
                x = i - 1
                while x >= 0:
                    y = left[x]
                    if y == x:
                        break
                    if y >= 0:
                        left[x] = left[y]
                    x = y
                previous[i] = x
                if x >= 0:
                    counts[x] = counts.get(x, 0) + 1
            split: dict[int, dict[int, set]] = {}
            for x, c in counts.items():
                g = group[x]
                if len(members[g]) > 1:
                    by_count = split.get(g)
                    if by_count is None:
                        split[g] = {c: {x}}
                    elif c in by_count:
                        by_count[c].add(x)
                    else:
                        by_count[c] = {x}
            for g, by_count in split.items():
                order = sorted(by_count)
                if sum(map(len, by_count.values())) == len(members[g]):
                    order = order[1:]  # the least stays where it is
                for c in reversed(order):
                    members[g] -= by_count[c]
                    _raise_above(members, below, above, group, g, by_count[c])
        now = below[now]
    return _emit(members, above, group, previous, n)


def _by_symbol(symbols):
    at: dict[int, list[int]] = {}
    for i, s in enumerate(symbols):
        at.setdefault(s, []).append(i)
    return sorted(at.items())


def _raise_above(members, below, above, group, g, moved):
    """A new group right above ``g``."""
    new = len(members)
    members.append(moved)
    nxt = above[g]
    below.append(g)
    above.append(nxt)
    above[g] = new
    if nxt >= 0:
        below[nxt] = new
    for x in moved:
        group[x] = new


def _emit(members, above, group, previous, n):
    start = [0] * len(members)
    at, g = 0, 0
    while g >= 0:
        start[g] = at
        at += len(members[g])
        g = above[g]
    placed = bytearray(n)
    order = [0] * n
    order[0] = n - 1
    placed[n - 1] = 1
    for k in range(n):
        x = order[k] - 1
        while x >= 0 and not placed[x]:
            g = group[x]
            order[start[g]] = x
            start[g] += 1
            placed[x] = 1
            x = previous[x]
    return order


# ------------------------------------------------------------------ fragments
def fragments(data, offsets, window: int, k: int, roller: Roller):
    """(start, windows, anchor offset, anchor hash) of every fragment."""
    n = len(data)
    z = np.zeros(0, np.int64)
    if n < window:
        return z, z, z, z.astype(np.uint64)
    prefix = roller.prefix(data)
    grams = mix((prefix[k:] - prefix[: n - k + 1]) * roller.down[: n - k + 1])
    anchor = window_anchors(grams, window - k + 1)
    lo, hi = offsets[:-1], offsets[1:] - (window - 1)
    has = hi > lo
    edge = np.zeros(n + 1, dtype=np.int8)
    np.add.at(edge, lo[has], 1)
    np.add.at(edge, hi[has], -1)
    at = np.flatnonzero(np.cumsum(edge, dtype=np.int8)[: n - window + 1])
    if not len(at):
        return z, z, z, z.astype(np.uint64)
    near = anchor[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (near[1:] != near[:-1])
    # A window that starts a row begins a fragment even right after another row's.
    new |= np.isin(at, lo[has])
    begin = np.flatnonzero(new)
    first = at[begin]
    return first, np.diff(np.append(begin, len(at))), near[begin] - first, grams[near[begin]]


def decide_equal(content, doc, th, pos, same) -> np.ndarray:
    """Which records repeat an earlier one of equal content: those of a
    larger document than the class's smallest, or later ones of the same row.
    ``same(i, j)`` confirms that two records are equal."""
    order = np.lexsort((pos, th, doc, content))
    c, d, t = content[order], doc[order], th[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = c[1:] != c[:-1]
    lead = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    gone = np.zeros(len(order), dtype=bool)
    low = d[lead][which]
    row = new.copy()
    row[1:] |= (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    p = pos[order]
    again = p > p[np.flatnonzero(row)][np.cumsum(row) - 1]  # a repeated row has records at one position
    maybe = np.flatnonzero((d > low) | again)
    leader = order[lead][which]
    for x in maybe.tolist():
        gone[x] = same(order[x], leader[x])
    out = np.zeros(len(order), dtype=bool)
    out[order] = gone
    return out


def _confirm(data, start, end):
    view = memoryview(np.ascontiguousarray(data))
    return lambda i, j: view[start[i] : end[i]] == view[start[j] : end[j]]


class _Anchors:
    """Pass one, map side."""

    def __init__(self, window, k, buckets, flush_bytes):
        self.window, self.k, self.buckets, self.flush_bytes = window, k, buckets, flush_bytes
        self.roller, self.parts, self.size = Roller(), [], 0
        self.small = np.uint8 if window < 256 else np.int32  # of counts within a window

    def add(self, ids, ths, data, offsets):
        first, count, aoff, h = fragments(data, offsets, self.window, self.k, self.roller)
        prefix = self.roller.prefix(data)
        end = first + count + self.window - 1
        content = self.roller.ranges(prefix, first, end)
        row = np.searchsorted(offsets, first, side="right") - 1
        self.parts.append((ids[row], ths[row], first - offsets[row], count.astype(self.small), aoff.astype(self.small), h, content, first + self.size, end + self.size, data))
        self.size += len(data)

    def flush(self):
        if not self.parts:
            return
        columns = list(zip(*self.parts))
        self.parts, self.size = [], 0  # the pieces are freed column by column
        doc, th, pos, count, aoff, h, content, a, b, data = [np.concatenate(columns.pop(0)) for _ in range(len(columns))]
        gone = decide_equal(content, doc, th, pos, _confirm(data, a, b))
        pos = pos.astype(np.int32)
        rows = []
        for bucket, g in packed.split_by((h % np.uint64(self.buckets)).astype(np.int32)):
            keep, drop = g[~gone[g]], g[gone[g]]
            rows.append((bucket, packed.dump(doc[keep], th[keep], pos[keep], count[keep], aoff[keep], h[keep], doc[drop], th[drop], pos[drop], count[drop])))
        if rows:
            yield packed.batch(rows)


def _repeated(blobs, buckets: int, hot: int):
    """Pass one, bucket side: records whose anchor occurs again, by the bucket
    of their document, with the spans that were already decided."""
    doc, th, pos, count, aoff, h, *gone = packed.concat(blobs)
    _, which, often = np.unique(h, return_inverse=True, return_counts=True)
    many = often[which] if len(h) else np.zeros(0, np.int64)
    keep = np.flatnonzero(many > 1)
    flag = (many > hot).astype(np.uint8)
    live = dict(packed.split_by(packed.row_bucket(doc[keep], th[keep], buckets)))
    done = dict(packed.split_by(packed.row_bucket(gone[0], gone[1], buckets)))
    empty = np.zeros(0, np.int64)
    rows = []
    for bucket in sorted(live.keys() | done.keys()):
        g, d = keep[live.get(bucket, empty)], done.get(bucket, empty)
        rows.append((bucket, packed.dump(doc[g], th[g], pos[g], count[g], aoff[g], flag[g], *(x[d] for x in gone))))
    return rows


def _fetch(docs, blobs, window: int, k: int, buckets: int):
    """Pass two, document side: fragments with their text, by anchor."""
    if not blobs:
        return []
    doc, th, pos, count, aoff, flag, *gone = packed.concat(blobs)
    d_doc, d_th, d_len, text = packed.concat(docs)
    base = packed.offsets_of(d_len)
    place = {(i, t): b for i, t, b in zip(d_doc.tolist(), d_th.tolist(), base[:-1].tolist())}
    a = np.array([place[x] for x in zip(doc.tolist(), th.tolist())], dtype=np.int64) + pos
    b = a + count + (window - 1)
    roller = Roller()
    prefix = roller.prefix(text)
    again = decide_equal(roller.ranges(prefix, a, b), doc, th, pos, _confirm(text, a, b))
    anchor = roller.ranges(prefix, a + aoff, a + aoff + k)
    n_gone = len(gone[0])
    spans = [np.concatenate((x, y[again])) for x, y in zip(gone, (doc, th, pos, count))]
    warm, crowded = np.flatnonzero(~again & (flag == 0)), np.flatnonzero(~again & (flag == 1))
    # Crowded anchors: one record per window, by the hash of the whole window.
    each = np.repeat(crowded, count[crowded])
    step = np.arange(len(each)) - np.repeat(packed.offsets_of(count[crowded])[:-1], count[crowded])
    w_pos, w_at = pos[each] + step.astype(np.int32), a[each] + step
    h1 = h2 = roller.ranges(prefix, w_at, w_at + window)
    if len(each):
        other = roller.twin(seed=23)
        h2 = other.ranges(other.prefix(text), w_at, w_at + window)
    w_gone = decide_equal(h1, doc[each], th[each], w_pos, _confirm(text, w_at, w_at + window))
    spans = [np.concatenate((x, y[w_gone])) for x, y in zip(spans, (doc[each], th[each], w_pos, np.ones(len(each), count.dtype)))]
    stay = np.flatnonzero(~w_gone)
    by_anchor = {b_: warm[g] for b_, g in packed.split_by((anchor[warm] % np.uint64(buckets)).astype(np.int32))}
    by_window = {b_: stay[g] for b_, g in packed.split_by((h1[stay] % np.uint64(buckets)).astype(np.int32))}
    by_span = {b_: g for b_, g in packed.split_by(packed.row_bucket(spans[0], spans[1], buckets))}
    none = np.zeros(0, np.int64)
    rows = []
    for bucket in sorted(by_anchor.keys() | by_window.keys() | by_span.keys()):
        g, w, s = by_anchor.get(bucket, none), by_window.get(bucket, none), by_span.get(bucket, none)
        e = each[w]
        rows.append((bucket, packed.dump(
            doc[g], th[g], pos[g], count[g], aoff[g], packed.slices(text, a[g], b[g]),
            doc[e], th[e], w_pos[w], h1[w], h2[w], *(x[s] for x in spans),
        )))
    return rows


def anchor_steps(window: int, k: int) -> list[int]:
    """By how much an anchor of ``k`` bytes is extended: a window that lacks
    that many bytes before it must hold them after it."""
    steps = []
    for most in (30, 15):
        steps.append(min(most, (window - k + 1) // 2))
        k += steps[-1]
    return [x for x in steps if x]


def shard_repeats(doc, th, pos, count, aoff, text, window: int, k: int):
    """Windows (doc, th, position, windows) of one shard's fragments that repeat
    an earlier one, by the suffix array over the fragments sharing an anchor.

    Fragments are first cut where their anchor can be extended: windows with
    at least ``more`` bytes before the anchor take those into it, the others
    take as many after it.  Equal windows stay together, and fragments that
    agree on the short anchor only part."""
    roller = Roller()
    prefix = roller.prefix(text)
    at = packed.offsets_of(count.astype(np.int64) + (window - 1))[:-1]
    pos, count, aoff = pos.astype(np.int64), count.astype(np.int64), aoff.astype(np.int64)
    out = []
    for more in (*anchor_steps(window, k), 0):
        end = at + count + (window - 1)
        content = roller.ranges(prefix, at, end)
        gone = decide_equal(content, doc, th, pos, _confirm(text, at, end))
        out.append(tuple(x[gone] for x in (doc, th, pos, count)))
        live = np.flatnonzero(~gone)
        # Different fragments: records of equal content share one entry.
        _, first, entry = np.unique(content[live], return_index=True, return_inverse=True)
        kinds = live[first]
        anchor = roller.ranges(prefix, at[kinds] + aoff[kinds], at[kinds] + aoff[kinds] + k)
        _, name, often = np.unique(anchor, return_inverse=True, return_counts=True)
        if not len(kinds) or often.max() < 2:
            return out
        if more:
            keep = live[(often[name] > 1)[entry]]
            d, t, p, c, o, x = (v[keep] for v in (doc, th, pos, count, aoff, at))
            before = np.clip(o - more + 1, 0, c)  # leading windows with enough before the anchor
            skip = np.minimum(before, c)
            doc, th = np.concatenate((d, d)), np.concatenate((t, t))
            pos, at = np.concatenate((p, p + skip)), np.concatenate((x, x + skip))
            count, aoff = np.concatenate((before, c - skip)), np.concatenate((o - more, o - skip))
            some = count > 0
            doc, th, pos, at, count, aoff = (v[some] for v in (doc, th, pos, at, count, aoff))
            k += more
    pick = np.flatnonzero(often[name] > 1)
    size = count + (window - 1)
    # One string of symbols: bytes, and for each anchor a symbol of its own.
    pick = pick[np.argsort(name[pick], kind="stable")]
    frag = kinds[pick]
    short = size[frag] - k + 1
    s_at = packed.offsets_of(short)
    symbols = np.empty(s_at[-1] + 1, dtype=np.int64)
    symbols[-1] = 0
    inside = np.arange(s_at[-1]) - np.repeat(s_at[:-1], short)
    mid = np.repeat(aoff[frag], short)
    src = np.repeat(at[frag], short) + inside + np.where(inside > mid, k - 1, 0)
    symbols[:-1] = np.where(inside == mid, 257 + np.repeat(name[pick], short), text[src].astype(np.int64) + 1)
    width = window - k + 1
    order = np.array(suffix_array(np.unique(symbols, return_inverse=True)[1].tolist()), dtype=np.int64)
    owner = np.full(len(symbols), -1, dtype=np.int64)
    owner[:-1] = np.where(inside < np.repeat(count[frag], short), np.repeat(np.arange(len(frag)), short), -1)
    order = order[owner[order] >= 0]  # suffixes that begin a window
    new = np.ones(len(order), dtype=bool)
    for lo in range(1, len(order), 1 << 16):
        x = order[lo - 1 : lo + (1 << 16)]
        cells = symbols[x[:, None] + np.arange(width)]
        new[lo : lo + len(x) - 1] = (cells[1:] != cells[:-1]).any(axis=1)
    label = np.cumsum(new) - 1
    shared = np.bincount(label)[label] > 1 if len(label) else np.zeros(0, bool)
    order, label = order[shared], label[shared]
    # Back to records: every record of the fragment's content, at that offset.
    by_entry = np.argsort(entry, kind="stable")
    cut = np.searchsorted(entry[by_entry], np.arange(len(kinds) + 1))
    kind = pick[owner[order]]
    n = cut[kind + 1] - cut[kind]
    rec = live[by_entry[np.repeat(cut[kind], n) + np.arange(n.sum()) - np.repeat(packed.offsets_of(n)[:-1], n)]] if len(n) else live[:0]
    w_pos = pos[rec] + np.repeat(order - s_at[owner[order]], n)
    lab = np.repeat(label, n)
    again = decide_equal(lab, doc[rec], th[rec], w_pos, lambda i, j: True)
    out.append((doc[rec][again], th[rec][again], w_pos[again], np.ones(int(again.sum()), count.dtype)))
    return out


def _shard(blobs, window: int, k: int, buckets: int):
    doc, th, pos, count, aoff, text, w_doc, w_th, w_pos, h1, h2, *gone = packed.concat(blobs)
    spans = [tuple(gone)]
    if len(doc):
        spans += shard_repeats(doc, th, pos, count, aoff, text, window, k)
    if len(w_doc):
        _, key = np.unique(np.stack((h1, h2), axis=1), axis=0, return_inverse=True)
        again = decide_equal(key.ravel(), w_doc, w_th, w_pos, lambda i, j: True)
        spans.append((w_doc[again], w_th[again], w_pos[again], np.ones(int(again.sum()), gone[3].dtype)))
    doc, th, pos, count = (np.concatenate([s[i] for s in spans]) for i in range(4))
    # Runs of neighbouring windows become one span.
    order = np.lexsort((pos, th, doc))
    doc, th, a = doc[order], th[order], pos[order].astype(np.int64)
    b = a + count[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (a[1:] > b[:-1])
    lead = np.flatnonzero(new)
    if len(lead):
        b = np.maximum.reduceat(b, lead)
        doc, th, a = doc[lead], th[lead], a[lead]
    n = (b - a + window - 1).astype(np.int32)
    return [(bucket, packed.dump(doc[g], th[g], a[g].astype(np.int32), n[g])) for bucket, g in packed.split_by(packed.row_bucket(doc, th, buckets))]


def suffix_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 100, k: int | None = None, hot: int = 2000, bucket_bytes: int = 8 << 20, flush_bytes: int = 16 << 20
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans``, ``kept``
    (binary: the bytes that stay) and ``kept_sha256``.

    Every byte covered by a ``window``-byte string that also starts in a
    document with a smaller id, or earlier in the same row, goes.  Null text
    reads as empty; null ids count as larger than all others; rows with one id
    and different texts do not remove from each other, true repeats of a row
    are one document and get the same result.  Shorter texts stay whole; an
    empty table gives no rows; other columns are ignored.  Anchors have ``k``
    bytes, at most ``window``: 40, or two fifths of a window under 100."""
    ready(df.sparkSession)
    k = min(40, max(1, 2 * window // 5)) if k is None else k
    if not 1 <= k <= window:
        raise ValueError(f"an anchor of {k} bytes does not fit a window of {window}")
    source = keyed_texts(df, id_col, text_col)
    buckets = packed.bucket_count(text_bytes(source, "_text"), bucket_bytes)

    def anchors(batches):
        out = _Anchors(window, k, buckets, flush_bytes)
        for b in batches:
            ids, ths = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data, offsets = flat(b.column(2))
            for lo, hi in row_chunks(offsets):
                out.add(ids[lo:hi], ths[lo:hi], data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                if out.size >= flush_bytes:
                    yield from out.flush()
        yield from out.flush()

    def blobs_of(tab):
        return tab.column("blob").to_pylist()

    def repeated(tab: pa.Table) -> pa.Table:
        return packed.blob_table(_repeated(blobs_of(tab), buckets, hot))

    def fetch(docs: pa.Table, found: pa.Table) -> pa.Table:
        return packed.blob_table(_fetch(blobs_of(docs), blobs_of(found), window, k, buckets))

    def shard(tab: pa.Table) -> pa.Table:
        return packed.blob_table(_shard(blobs_of(tab), window, k, buckets))

    docs = packed.pack_documents(source, buckets, flush_bytes)
    found = packed.spread(source.mapInArrow(anchors, packed.BLOBS), buckets).groupBy("bucket").applyInArrow(repeated, packed.BLOBS)
    found = packed.spread(found, buckets)
    pieces = docs.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(fetch, packed.BLOBS)
    spans = packed.spread(pieces, buckets).groupBy("bucket").applyInArrow(shard, packed.BLOBS)
    return packed.cut_documents(docs, spans, buckets, _cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string", [])


def _cut(doc: int, text: bytes, spans: list | None) -> tuple:
    runs = packed.merge_spans(spans, len(text))
    parts, at = [], 0
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    kept = b"".join([*parts, text[at:]])
    return doc, len(text), len(text) - len(kept), len(runs), kept, hashlib.sha256(kept).hexdigest()
