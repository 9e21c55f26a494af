"""Exact BM25 top-k over sharded inverted indexes with block-max WAND.

A shard holds documents with their postings (term -> documents, counts), built
where the documents are read; texts of like words share one (``alike``).  Scores
use statistics of the whole corpus (documents, mean length, document frequencies),
so shards merge exactly.  Within a shard documents form blocks.  The index stores
per term a list of blocks, each with its greatest impact and the number of its
postings.  Many queries are searched at once:

* a query whose lists' maxima together miss the bar (the present k-th score)
  leaves the shard; where they are close to it, summed block maxima bound its
  blocks, and those that miss the bar are never opened;
* lists that stand in many documents and that many queries ask for hold most of
  the postings.  They are opened once for many queries: as a matrix, lists by
  documents, whose product with the queries' weights is their part of every score.
  Bounds, the first bar (the k-th greatest part) and the pivot start from it;
* the pivot term is the first of the other lists at which maxima add up to
  ``PIVOT_SHARE`` of the bar: a document needs it or one after it, so only these
  lists are opened, whole where most blocks are live, else block by block.

What documents reach this way is summed in single precision, with its greatest
error; documents that can reach the bar are scored in double precision by all their
postings.  The k best hits found in some shards from all over the table (a 512th,
a 64th, an 8th of them) are the bars for those that follow, so that a shard
is searched with bars of the whole table, not of its own task.

Queries go in blocks of about ``block_terms`` terms and ``block_queries``
queries at most, each broadcast to one pass over the index.
"""

from __future__ import annotations

import heapq
import math
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm import packed
from farebox.llm.common import NULL_ID, Roller, flat, keyed_texts, ready, row_chunks, text_bytes, words

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

DOCS_PER_BLOCK = 128
#: Documents opened before there is a bar.
FIRST_DOCS = 128
#: Part of the bar that the terms before the pivot may add up to: less opens
#: more lists at first, and leaves fewer documents to score to the end.
PIVOT_SHARE = 0.02
#: Cells of a product that cost as much as a posting summed up by itself, and those
#: that cost as much as a cell's place in the matrix.
DENSE_GAIN, DENSE_FILL = 1000, 64
#: Greatest matrix in cells, and queries that it is made for; most queries of a
#: product, and its cells.
DENSE_CELLS, WIDE_GROUP, GROUP, GROUP_CELLS = 3 << 20, 1024, 1024, 1 << 20
#: Cells of documents whose other lists are opened at a time: temporary arrays stay small.
OPEN_CELLS = 1 << 17
#: Block maxima are added up for queries whose lists' maxima add up to less than so many bars.
LOOSE = 2.0
#: Counts by which texts are grouped, least texts of a group, and the part of the
#: variance that halves of a group tell apart at least.
ALIKE_SIZE, ALIKE_LEAST, ALIKE_GAIN = 256, 256, 0.08
#: Error of a single-precision step, doubled.
_EPS = 2.0**-23
#: Documents of a query that are scored at a time.
SCORE_DOCS = 1024


def term_rows(data: np.ndarray, offsets: np.ndarray, roller: Roller):
    """(row, term hash, byte start, byte end) of every word, ASCII lower-cased."""
    low = _LOWER[data]
    start, end, row = words(low, offsets)
    return row, roller.ranges(roller.prefix(low), start, end), start, end, low


def build_shard(ids, lengths, row, term, mean_length: float, k1: float, b: float) -> bytes:
    """Postings of one shard, sorted by term, then document, and above them
    the blocks of every term with their greatest impact."""
    order = np.lexsort((row, term))
    t, r = term[order], row[order]
    new = np.ones(len(t), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
    lead = np.flatnonzero(new)
    tf = np.diff(np.append(lead, len(t)))
    t, r = t[lead], r[lead]
    df = _runs(t)
    block = r // DOCS_PER_BLOCK
    first = _starts(t, block)
    impact = _impact(tf, _norm(lengths, mean_length, k1, b)[r], k1)
    top = np.maximum.reduceat(impact, first) if len(first) else impact
    # Rounded up, so that it stays a bound.
    top = np.nextafter(top.astype(np.float32), np.float32(np.inf))
    per_block = np.diff(np.append(first, len(t)))
    return packed.dump(
        ids, lengths.astype(np.int32), t[_starts(t)], df.astype(np.int32),
        _runs(t[first]).astype(np.int32), block[first].astype(np.uint32), per_block.astype(np.uint16), top,
        r.astype(np.uint32), tf.astype(np.uint32),
    )


def alike(row: np.ndarray, term: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """A label for each of ``n`` texts, shared by texts of like words (of one
    language, say), common words above all: groups are halved by their main direction while that tells apart
    ``ALIKE_GAIN`` of their variance.  Any labels give the same hits."""
    label = np.zeros(n, np.int64)
    if n < 2 * ALIKE_LEAST:
        return label
    counts = np.bincount(row * ALIKE_SIZE + (term % np.uint64(ALIKE_SIZE)).astype(np.int64), weights, n * ALIKE_SIZE)
    words = counts.reshape(n, ALIKE_SIZE).astype(np.float32)
    words /= np.maximum(np.sqrt(np.square(words).sum(axis=1, keepdims=True)), 1e-9)
    todo, groups = [np.arange(n)], 0
    while todo:
        own = todo.pop()
        off = words[own] - words[own].mean(axis=0)
        spread = np.square(off).sum(axis=1)
        way = off[np.argmax(spread)]
        for _ in range(12):
            way = off.T @ (off @ way)
            way /= max(float(np.sqrt(np.square(way).sum())), 1e-9)
        side = off @ way > 0
        part = side.mean()
        told = part / (1 - part) * np.square(off[side].mean(axis=0)).sum() if 0 < part < 1 else 0.0
        if told > ALIKE_GAIN * spread.mean() and min(side.sum(), (~side).sum()) >= ALIKE_LEAST:
            todo += [own[side], own[~side]]
        else:
            label[own], groups = groups, groups + 1
    return label


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Positions at which some key differs from the one before."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for x in keys:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _runs(key: np.ndarray) -> np.ndarray:
    return np.diff(np.append(_starts(key), len(key)))


def _norm(lengths, mean_length: float, k1: float, b: float):
    return k1 * (1 - b + b * lengths / max(mean_length, 1e-9))


def _impact(tf, norm, k1: float):
    return tf * (k1 + 1) / (tf + norm)


class Asked:
    """Terms of many queries, each once a query, those of a query from ``at`` on by
    rising weight; ``terms`` has each once, sorted."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, at: np.ndarray):
        self.terms, which = np.unique(terms, return_inverse=True)
        query = np.repeat(np.arange(len(at) - 1), np.diff(at))
        order = np.lexsort((which, query))
        which, query, weights = which[order], query[order], np.asarray(weights, np.float64)[order]
        first = _starts(query, which)  # equal hashes of a query's terms add up
        which, query, weights = which[first], query[first], np.add.reduceat(weights, first) if len(first) else weights
        order = np.lexsort((weights, query))
        self.which, self.weights = which[order].astype(np.int32), weights[order]
        self.at = packed.offsets_of(np.bincount(query, minlength=len(at) - 1))


class Shard:
    def __init__(self, blob: bytes, mean_length: float, k1: float, b: float, digits: int = 6):
        self.ids, lengths, self.terms, _, blocks, self.block, per_block, self.top, self.doc, self.tf = packed.load(blob)
        self.block_at, self.at = packed.offsets_of(blocks), packed.offsets_of(per_block)
        self.norm, self.k1, self.digits = _norm(lengths, mean_length, k1, b), k1, digits
        self.slack = 2 * 10.0**-digits  # rounded scores and sums
        self.block = self.block.astype(np.int64)
        # Document and impact of a posting side by side, worked out once for all queries.
        self.post = np.empty((len(self.doc), 2), np.uint32)
        self.post[:, 0] = self.doc
        self.post.view(np.float32)[:, 1] = _impact(self.tf.astype(np.float32), self.norm.astype(np.float32)[self.doc], np.float32(k1))
        self.post = self.post.view(np.uint64)[:, 0]
        self.blocks = -(-len(self.ids) // DOCS_PER_BLOCK)
        self.edges = np.arange(self.blocks) * DOCS_PER_BLOCK
        self.peak = np.maximum.reduceat(self.top, self.block_at[:-1]) if len(self.top) else self.top
        self.list_at = self.at[self.block_at]
        self.opened = self.scored = 0  # postings

    @cached_property
    def forward(self):
        """Where each document's postings begin, and their terms and counts."""
        doc = self.doc.astype(np.uint16 if len(self.ids) <= 1 << 16 else np.uint32)  # short keys sort by digits
        order = np.argsort(doc, kind="stable")
        term = np.repeat(np.arange(len(self.terms), dtype=np.int32), np.diff(self.list_at))
        return packed.offsets_of(np.bincount(doc, minlength=len(self.ids))), term[order], self.tf[order], np.zeros(len(self.terms))

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, -1 where the shard lacks it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def search_all(self, terms: np.ndarray, weights: np.ndarray, at: np.ndarray, tops: list[list], k: int) -> None:
        """``search`` for many queries, whose terms begin at ``at``."""
        self.search_asked(Asked(terms, weights, at), tops, k)

    def search_asked(self, asked: Asked, tops: list[list], k: int, bars: np.ndarray | None = None) -> None:
        """``bars``: scores that the k best of a query reach by other shards' documents."""
        place, at, n = self.find(asked.terms), asked.at, len(self.ids)
        known = _bars(tops, k) if bars is None else np.maximum(_bars(tops, k), bars)
        group, rows = (max(1, min(GROUP, cells // max(1, n))) for cells in (GROUP_CELLS, OPEN_CELLS))
        for lo in range(0, len(tops), WIDE_GROUP):
            hi = min(len(tops), lo + WIDE_GROUP)
            found = place[asked.which[at[lo] : at[hi]]]
            held = np.flatnonzero(found >= 0)
            found, weights = found[held], asked.weights[at[lo] : at[hi]][held]
            query = np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1]))[held]
            # Queries whose lists' maxima together miss the bar are done.
            sums = np.bincount(query, weights=weights * self.peak[found], minlength=hi - lo)
            own = (sums > 0) & (sums >= known[lo:hi] - self.slack)
            numbers, place_of = np.flatnonzero(own) + lo, np.cumsum(own) - 1
            if len(numbers) < hi - lo:
                held = np.flatnonzero(own[query])
                found, weights, query = found[held], weights[held], place_of[query[held]]
            first = packed.offsets_of(np.bincount(query, minlength=len(numbers)))
            column, lists = self._wide(found, len(numbers))
            error, base = (len(lists) + 16) * _EPS, None
            for a in range(0, len(numbers), group):
                z = min(len(numbers), a + group)
                if len(lists):
                    own = np.flatnonzero(column[first[a] : first[z]] >= 0) + first[a]
                    share = np.zeros((z - a, len(lists)), np.float32)
                    share[query[own] - a, column[own]] = weights[own]
                    base = share @ lists
                for x in range(a, z, rows):
                    y = min(z, x + rows)
                    own, part = slice(first[x], first[y]), None if base is None else base[x - a : y - a]
                    some = [tops[i] for i in numbers[x:y].tolist()]
                    self._search(found[own], weights[own], query[own] - x, column[own] < 0, some, k, known[numbers[x:y]], part, error)

    def search(self, found: np.ndarray, weights: np.ndarray, top: list, k: int) -> None:
        """Improves ``top``, a heap of (score, -id) of at most k entries."""
        low = np.argsort(self.peak[found] * weights, kind="stable")
        self._search(found[low], weights[low], np.zeros(len(found), np.int64), np.ones(len(found), bool), [top], k, _bars([top], k))

    def _search(self, found, weights, query, narrow, tops: list[list], k: int, known, base=None, error: float = 16 * _EPS) -> None:
        """``search`` for some queries at once; ``query`` has the query of each
        term, rising; ``known``: their bars.  ``base``: what documents get from the terms that are not
        ``narrow``; ``error``: the greatest relative one of single-precision sums."""
        n, asked, blocks = len(self.ids), len(tops), self.blocks
        if not len(found) or not k:
            return
        bar = np.maximum(known - self.slack, 0.0)
        lost = np.flatnonzero(bar <= 0)
        if base is not None:
            self._raise(bar, lost, base[lost], k, error)
        t, w, q = found[narrow], weights[narrow], query[narrow]
        # What a document can get from a query's term and those before it.
        peak, first = self.peak[t] * w, packed.offsets_of(np.bincount(q, minlength=asked))
        sums = np.append(0.0, np.cumsum(peak))
        reach, most = sums[1:] - sums[first[q]], np.diff(sums[first])
        if base is not None:
            most += base.max(axis=1) * (1 + error)
        todo = np.repeat((most > 0) & (most >= bar), blocks).reshape(asked, blocks)
        # Block maxima, where they can leave out blocks.
        close = todo[:, 0] & (most < bar * LOOSE) | (bar <= 0)
        bound = np.full((asked, blocks), np.inf)
        if close.any():
            pick = np.flatnonzero(close[q])
            entry, gain, cell = _ranges(self.block_at, t[pick], w[pick], q[pick] * blocks)
            cell += self.block[entry]
            by_block = np.bincount(cell, weights=gain * self.top[entry], minlength=asked * blocks).reshape(asked, blocks)
            bound[close] = by_block[close]
            if base is not None:
                bound[close] += np.maximum.reduceat(base[close], self.edges, axis=1) * (1 + error)
            todo &= bound > 0
        # Best bounds first where there is no bar; then all blocks that reach it.
        lost = np.flatnonzero(bar <= 0)
        if len(lost):
            best = np.argsort(-bound[lost], axis=1, kind="stable")[:, : max(1, FIRST_DOCS // DOCS_PER_BLOCK)]
            live = np.zeros_like(todo)
            live[lost[:, None], best] = todo[lost[:, None], best]
            todo &= ~live
            self._turn(found, weights, query, t, w, q, reach, live, bar, tops, k, base, error)
            bar[lost] = np.maximum(bar[lost], _bars([tops[i] for i in lost.tolist()], k) - self.slack)
        self._turn(found, weights, query, t, w, q, reach, todo & (bound >= bar[:, None]), bar, tops, k, base, error)

    def _turn(self, found, weights, query, t, w, q, reach, live, bar, tops: list[list], k: int, base, error: float) -> None:
        """Searches the live blocks of every query (queries by blocks)."""
        some = live.any(axis=1)
        rows, place = np.flatnonzero(some), np.cumsum(some) - 1
        if not len(rows):
            return
        # Terms before the pivot cannot lift a document to the bar.
        after = reach >= bar[q] * PIVOT_SHARE
        left = np.zeros(len(tops))
        np.maximum.at(left, q[~after], reach[~after])
        left = left[rows]
        read = np.flatnonzero(after & some[q])
        part = self._open(t[read], w[read], place[q[read]], live[rows])
        if base is not None:
            part += base if len(rows) == len(base) else base[rows]
        need = np.maximum((bar[rows] - left) / (1 + error), 1e-300)
        one, doc = np.divmod(np.flatnonzero(part >= need[:, None]), len(self.ids))
        many = np.flatnonzero(np.bincount(one, minlength=len(rows)) > 2 * k)
        if len(many):
            self._raise(bar, rows[many], part[many], k, error)
            need = np.maximum(need, (bar[rows] - left) / (1 + error))
        inside = live[rows[one], doc // DOCS_PER_BLOCK] & (part[one, doc] >= need[one])
        self._score(found, weights, query, rows[one[inside]], doc[inside], bar, tops, k)

    def _wide(self, found: np.ndarray, asked: int):
        """The column of each term in the matrix of wide lists (-1 for others),
        and the matrix: lists by documents."""
        n = len(self.ids)
        sums = np.bincount(found, minlength=len(self.terms)) * np.diff(self.list_at)
        wide = np.flatnonzero(sums * DENSE_GAIN > (asked + DENSE_FILL) * n)
        if len(wide) * n > DENSE_CELLS:
            wide = wide[np.argsort(-sums[wide], kind="stable")[: DENSE_CELLS // n]]
        place = np.full(len(self.terms), -1)
        place[wide] = np.arange(len(wide))
        lists = np.zeros((len(wide), n), np.float32)
        post, row = _ranges(self.list_at, wide, np.arange(len(wide)))
        doc, impact = self._read(post)
        lists[row, doc] = impact
        return place[found], lists

    def _raise(self, bar, which, part, k: int, error: float) -> None:
        """Bars from parts: none is more than its document's score, so k of them make one."""
        if len(which) and k <= len(self.ids):
            at = len(self.ids) - k
            bar[which] = np.maximum(np.partition(part, at, axis=1)[:, at] * (1 - error) - self.slack, bar[which])

    def _read(self, post: np.ndarray):
        """Documents and impacts of postings."""
        self.opened += len(post)
        pair = self.post[post].view(np.uint32).reshape(-1, 2)
        return pair[:, 0], pair.view(np.float32)[:, 1]

    def _open(self, t, w, q, live) -> np.ndarray:
        """What documents of live blocks get from the terms (others may get a part)."""
        n, asked = len(self.ids), len(live)
        whole = (2 * live.sum(axis=1) > self.blocks)[q]  # whole lists where most blocks are live
        post, gain, cell = _ranges(self.list_at, t[whole], w[whole], q[whole] * n)
        if not whole.all():
            rest = ~whole
            entry, spread, one = _ranges(self.block_at, t[rest], w[rest], q[rest])
            pick = np.flatnonzero(live[one, self.block[entry]])
            more = _ranges(self.at, entry[pick], spread[pick], one[pick] * n)
            post, gain, cell = (np.concatenate(x) for x in zip((post, gain, cell), more))
        doc, impact = self._read(post)
        cell += doc
        gain *= impact
        return np.bincount(cell, weights=gain, minlength=asked * n).astype(float, copy=False).reshape(asked, n)

    def _score(self, found, weights, query, one, doc, bar, tops: list[list], k: int) -> None:
        """Scores documents ``doc`` for queries ``one`` (rising) in double precision
        by all their terms, and improves the queries' heaps."""
        if not len(one):
            return
        doc_at, terms, counts, weight = self.forward
        first, turns = packed.offsets_of(np.bincount(query, minlength=len(tops))), _starts(one)
        for lo, hi in zip(turns.tolist(), [*turns[1:].tolist(), len(one)]):
            i = int(one[lo])
            own = slice(first[i], first[i + 1])
            weight[found[own]] = weights[own]
            top, least = tops[i], bar[i]
            for at in range(lo, hi, SCORE_DOCS):
                docs = doc[at : min(hi, at + SCORE_DOCS)]
                post, which = _ranges(doc_at, docs, np.arange(len(docs)))
                gain = weight[terms[post]]
                held = np.flatnonzero(gain)
                self.scored += len(held)
                which = which[held]
                gain = gain[held] * _impact(counts[post[held]], self.norm[docs][which], self.k1)
                score = np.round(np.bincount(which, weights=gain, minlength=len(docs)), self.digits)
                ids = self.ids[docs]
                best = np.lexsort((ids, -score))[:k]
                for s, x in zip(score[best].tolist(), ids[best].tolist()):
                    if s > 0 and s >= least and (len(top) < k or (s, -x) > top[0]):
                        (heapq.heappush if len(top) < k else heapq.heapreplace)(top, (s, -x))
            weight[found[own]] = 0


def _bars(tops: list[list], k: int) -> np.ndarray:
    """The k-th score of each heap, 0 if it has fewer."""
    return np.array([top[0][0] if len(top) == k else 0.0 for top in tops])


def _ranges(at: np.ndarray, found: np.ndarray, *along: np.ndarray):
    """Positions of the found ranges, one after the other, with what goes
    along with each; terms stay in query order, so sums have one order."""
    n = at[found + 1] - at[found]
    start = packed.offsets_of(n)
    post = np.repeat(at[found] - start[:-1], n)
    post += np.arange(len(post))
    return post, *(np.repeat(x, n) for x in along)


def corpus_size(texts: DataFrame) -> tuple[int, int]:
    """Rows and words of all texts."""

    def count(batches):
        for batch in batches:
            data, offsets = flat(batch.column(0))
            n = sum(len(words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])[0]) for lo, hi in row_chunks(offsets))
            yield pa.RecordBatch.from_arrays([pa.array([len(offsets) - 1], pa.int64()), pa.array([n], pa.int64())], names=["n", "words"])

    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "words")]
    return tuple(texts.select("_text").mapInArrow(count, "n long, words long").agg(*sums).first())


def shards(texts: DataFrame, mean_length: float, k1: float, b: float, shard_bytes: int = 16 << 20) -> DataFrame:
    """``turn, blob``: the indexes of every run of about ``shard_bytes`` of text,
    one for each group of like texts.  Runs of turns below 3 are about a 512th, a
    64th and an 8th of all, from all over the table."""

    def run(batches):
        roller, held, size, rows, number = Roller(), [], 0, 0, 2 * TaskContext.get().partitionId()

        def flush():
            ids, lengths, row, term = (np.concatenate([h[i] for h in held]) for i in range(4))
            held.clear()
            label, turn = alike(row, term, len(ids)), next(i for i, x in enumerate((512, 64, 8, 1)) if number % x == 0)
            for x in range(int(label.max()) + 1):
                own = label == x
                pick, place = np.flatnonzero(own[row]), np.cumsum(own) - 1
                blob = build_shard(ids[own], lengths[own], place[row[pick]], term[pick], mean_length, k1, b)
                yield pa.RecordBatch.from_arrays([pa.array([turn], pa.int32()), pa.array([blob], pa.binary())], names=["turn", "blob"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = flat(batch.column(2))
            for lo, hi in row_chunks(offsets):
                row, term, *_ = term_rows(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], roller)
                held.append((ids[lo:hi], np.bincount(row, minlength=hi - lo), (row + rows).astype(np.int32), term))
                rows, size = rows + hi - lo, size + int(offsets[hi] - offsets[lo])
                if size >= shard_bytes:
                    yield from flush()
                    size, rows, number = 0, 0, number + 1
        if held:
            yield from flush()

    return texts.mapInArrow(run, "turn int, blob binary")


def query_terms(index: DataFrame, queries: DataFrame, buckets: int) -> DataFrame:
    """``q, term, hash, tf, df``: the terms of the query texts with their
    document frequency over the whole index."""

    def frequencies(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                _, _, terms, n, *_ = packed.load(blob)
                yield packed.batch([(x, packed.dump(terms[g], n[g])) for x, g in packed.split_by((terms % np.uint64(buckets)).astype(np.int32))])

    def spell(batches):
        roller = Roller()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            data, offsets = flat(b.column(2))
            for lo, hi in row_chunks(offsets):
                row, term, start, end, low = term_rows(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], roller)
                order = np.lexsort((term, row))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (term[order][1:] != term[order][:-1]) | (row[order][1:] != row[order][:-1])
                lead = np.flatnonzero(new)
                one, tf = order[lead], np.diff(np.append(lead, len(order)))
                view = memoryview(np.ascontiguousarray(low))
                spelled = [bytes(view[a:z]) for a, z in zip(start[one].tolist(), end[one].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((term[one] % np.uint64(buckets)).astype(np.int32)), pa.array(ids[lo:hi][row[one]]), pa.array(spelled, pa.binary()), pa.array(term[one].view(np.int64)), pa.array(tf)],
                    names=["bucket", "q", "term", "hash", "tf"],
                )

    def look_up(asked: pa.Table, known: pa.Table) -> pa.Table:
        h = asked.column("hash").to_numpy().view(np.uint64)
        df = np.zeros(len(h), np.int64)
        blobs = known.column("blob").to_pylist()
        if blobs and len(h):
            wanted, which = np.unique(h, return_inverse=True)
            total = np.zeros(len(wanted), np.int64)
            for blob in blobs:  # one at a time: the bucket's dictionary is never merged
                t, n = packed.load(blob)
                at = np.minimum(np.searchsorted(wanted, t), len(wanted) - 1)
                ok = wanted[at] == t
                np.add.at(total, at[ok], n[ok])
            df = total[which]
        return asked.select(["q", "term", "hash", "tf"]).append_column("df", pa.array(df))

    known = packed.spread(index.select("blob").mapInArrow(frequencies, packed.BLOBS), buckets)
    asked = packed.spread(queries.mapInArrow(spell, "bucket int, q long, term binary, hash long, tf long"), buckets)
    out = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(look_up, "q long, term binary, hash long, tf long, df long")
    return out.withColumn("term", F.col("term").cast("string"))


def search(
    df: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 10, k1: float = 1.2, b: float = 0.75,
    max_terms: int | None = None, min_df: int = 2, block_queries: int = 8192, bucket_bytes: int = 8 << 20, block_terms: int = 2 << 20,
    digits: int = 6,
) -> DataFrame:
    """``query_id, rank, id, score``: for every row of ``queries`` (same
    columns as ``df``) the k rows of ``df`` of greatest BM25, ties by smaller id.

    A query has every term of its text that occurs in at least ``min_df``
    documents (a term of one document finds that document alone: pass 1 to
    count it too); ``max_terms`` asks with those of greatest tf * idf only (ties
    by term).  The index holds every term of every row; the search is exact.
    Scores are rounded to ``digits`` before they are ranked, so the order does not
    hang on the order of sums.  Terms are runs without white space, ASCII
    lower-cased; idf = ln(1 + (N - df + 0.5) / (df + 0.5)).  Rows that share no
    query term are no results; null and empty texts match nothing; null ids
    read as the largest id; a repeated row is a result per repeat, a repeated
    query id is one query with the rows' terms together.  Empty tables give
    no rows; other columns are ignored."""
    ready(df.sparkSession)
    texts = keyed_texts(df, id_col, text_col)
    n, total = corpus_size(texts)
    mean = total / n if n else 0.0
    index = shards(texts, mean, k1, b).checkpoint()
    asked = queries.select(*keyed_texts(queries, id_col, text_col).columns) if "_id" in queries.columns else keyed_texts(queries, id_col, text_col)
    terms = query_terms(index, asked, packed.bucket_count(text_bytes(texts, "_text"), bucket_bytes))
    terms = terms.where(F.col("df") >= min_df).groupBy("q", "term", "hash", "df").agg(F.sum("tf").alias("tf"))
    terms = terms.withColumn("idf", F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    best = Window.partitionBy("q").orderBy(F.desc(F.col("tf") * F.col("idf")), "term")
    terms = terms.withColumn("r", F.row_number().over(best))
    if max_terms is not None:
        terms = terms.where(F.col("r") <= max_terms)
    terms = terms.select("q", "r", "hash", "idf").checkpoint()
    count, held = terms.agg(F.coalesce(F.sum((F.col("r") == 1).cast("long")), F.lit(0)), F.count("*")).first()
    blocks = max(1, math.ceil(count / block_queries), math.ceil(held / block_terms))
    terms = terms.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)))
    parts = index.rdd.getNumPartitions()
    # Runs of the early turns are so many parts apart; a table with few of them takes these turns at once.
    few = [256, 32, 4] if parts > 256 else [32, 4]
    steps = [F.col("turn") <= 3 - len(few), *(F.col("turn") == i for i in range(4 - len(few), 4))]
    turns = [index.where(x).select("blob") for x in steps]
    turns[:-1] = [x.coalesce(max(1, parts // y)).checkpoint() for x, y in zip(turns, few)]
    out = None
    for block in range(blocks):
        part = _one_block(turns, terms.where(F.col("block") == block).select("q", "hash", "idf").toArrow(), mean, k, k1, b, digits)
        out = part if out is None else out.unionAll(part)
    out = _best(out, k)
    clean = [F.when(F.col(c) != NULL_ID, F.col(c)).alias(c) for c in ("query_id", "id")]
    return out.select(clean[0], "rank", clean[1], "score")


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of every query, with their ``rank``."""
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k)


def _one_block(turns: list[DataFrame], rows: pa.Table, mean: float, k: int, k1: float, b: float, digits: int) -> DataFrame:
    """Hits of a block of queries; the k-th best score of the turns before is the
    bar of a turn, so that the whole index is searched with bars of the whole table."""
    spark = turns[0].sparkSession
    q, terms, idf = (rows.column(c).to_numpy() for c in ("q", "hash", "idf"))
    ids, row = np.unique(q, return_inverse=True)
    terms = terms.view(np.uint64)
    order = np.argsort(alike(row, terms, len(ids), np.exp(-idf)), kind="stable")  # like queries have wide lists in common
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    ids, row = ids[order], place[row]
    order = np.argsort(row, kind="stable")
    sent = spark.sparkContext.broadcast((ids, Asked(terms[order], idf[order], packed.offsets_of(np.bincount(row, minlength=len(ids))))))

    def over(shards: DataFrame, bars: np.ndarray | None) -> DataFrame:
        known = spark.sparkContext.broadcast(bars)

        def run(batches):
            ids, asked = sent.value
            tops: list[list] = [[] for _ in ids]
            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    Shard(blob, mean, k1, b, digits).search_asked(asked, tops, k, known.value)
            hits = [(int(i), -d, s) for i, top in zip(ids, tops) for s, d in top]
            if hits:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*hits), (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "id", "score"])

        return shards.mapInArrow(run, "query_id long, id long, score double")

    hits, bars = None, None
    for turn in turns[:-1]:
        found = over(turn, bars)
        hits = _best(found if hits is None else hits.unionAll(found), k).drop("rank").checkpoint()
        full = hits.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("bar")).where(F.col("n") >= k).toArrow()
        bars, by_id = np.zeros(len(ids)), np.argsort(ids)
        bars[by_id[np.searchsorted(ids[by_id], full.column("query_id").to_numpy())]] = full.column("bar").to_numpy()
    return hits.unionAll(over(turns[-1], bars))
