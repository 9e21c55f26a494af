"""Mixture-controlled packing into fixed windows.

Each source is a queue of tokens; a window takes from every queue its share by
deficit round-robin, so the share of a source in any run of windows is exact
to a token and no window is padded but the last.  While the same queues are
active, the tokens queue k has sent after j windows are

    Q_k(j) = floor(j * L * W_k / W) - floor(j * L * W_(k-1) / W)

(W_k: cumulative weights): the deficit counters in closed form.  A document
that knows its place in its queue thus finds its own pieces, windows and
offsets, wherever it lies: deficits carry across windows and partitions without
any of them waiting for another.  A queue's place is a prefix sum of token
counts over the partitions; tokens never move to a packer.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import ready, worker_cache


# ---------------------------------------------------------------- token layer
#: Letters and other characters of words that may be taken apart: ASCII and
#: Latin letters with their accents (no apostrophe: contractions stay whole).
_RUNS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+|[^A-Za-zÀ-ÖØ-öø-ÿ]+")
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")


def byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: visible
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class WordIds(dict):
    """Token ids (packed little-endian) by white-space separated word.  Words
    are tokenised alone, which equals tokenising the text because the
    tokenizer drops white space and never looks across it.  Plain words are
    cut further into runs of letters and of other characters, lower-cased, and a
    run of letters goes straight to the merge model, if a probe shows that
    the tokenizer works that way."""

    #: Entries that are kept, of at most so many bytes each.
    LIMIT, LONGEST = 400_000, 64
    PROBE = ("Straße", "ÉTÉ,", "the", "THE!!", "a|b", "x%%%y", "Ñandú.", "zz9", "[A]b_c")

    def __init__(self, tokenizer, kind: str):
        super().__init__()
        self.tokenizer, self.kind, self.plain = tokenizer, kind, True
        self.alphabet = byte_alphabet()
        self.pack = {"<u2": "H", "<u4": "I"}[kind]
        self.plain = all(self[w.encode()] == self._whole(w) for w in self.PROBE)
        self.clear()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _letters(self, word: bytes) -> bytes:
        """A lower-case run of letters, by the merge model alone."""
        spelled = word.decode() if word.isascii() else word.decode("latin-1").translate(self.alphabet)
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}{self.pack}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > self.LIMIT:
            self.clear()
        text = word.decode("utf-8")
        if not self.plain or not _PLAIN.fullmatch(text) or "<|" in text:
            out = self._whole(text)
        else:
            runs = _RUNS.findall(text.lower())
            if runs != [text]:
                out = b"".join([self[r.encode()] for r in runs])
            elif text.isalpha():
                out = self._letters(word)
            else:
                out = self._whole(text)
        if len(word) <= self.LONGEST:
            self[word] = out
        return out

    def text(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, raw.split()))


def word_ids(path: str, kind: str) -> WordIds:
    def make():
        from tokenizers import Tokenizer

        return WordIds(Tokenizer.from_file(path), kind)

    return worker_cache(f"{kind}:{path}", make)


def tokenized(df: DataFrame, path: str, end_id: int, id_col: str, text_col: str, source_col: str, kind: str = "<u2") -> DataFrame:
    """``id, source, shard, at, n, ids``: every row's tokens (with the end
    token) and its place among its source's tokens in its partition."""

    def run(batches):
        cache, seen = word_ids(path, kind), {}
        end = np.array([end_id], dtype=kind).tobytes()
        width = len(end)
        for b in batches:
            shard = b.column(0).to_pylist()
            sources = b.column(2).to_pylist()
            ids, at, n = [], [], []
            for part, source, raw in zip(shard, sources, b.column(3).to_pylist()):
                x = cache.text(raw) + end
                ids.append(x)
                n.append(len(x) // width)
                at.append(seen.get((part, source), 0))
                seen[part, source] = at[-1] + n[-1]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), b.column(0), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                names=["id", "source", "shard", "at", "n", "ids"],
            )

    src = df.select(
        F.spark_partition_id().cast("long").alias("shard"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"),
    )
    return src.mapInArrow(run, "id long, source string, shard long, at long, n long, ids binary")


# ------------------------------------------------------------------ the plan
@dataclass
class Segment:
    """Windows first..first+count-1 of ``size`` tokens, all under one set of
    cumulative weights; base[k]: tokens queue k had sent before."""

    first: int
    count: int
    size: int
    base: list[int]
    cum: list[int]

    def sent(self, k: int, j: int) -> int:
        """Tokens queue k has sent before window j of this segment."""
        step = (j - self.first) * self.size
        return self.base[k] + step * self.cum[k + 1] // self.cum[-1] - step * self.cum[k] // self.cum[-1]

    def offset(self, k: int, j: int) -> int:
        """Where queue k's tokens begin in window j."""
        step = (j - self.first) * self.size
        return (step + self.size) * self.cum[k] // self.cum[-1] - step * self.cum[k] // self.cum[-1]


def plan_windows(totals: list[int], weights: list[int] | None, length: int) -> list[Segment]:
    """Deficit round-robin over queues of the given token totals.  Without
    weights the queues keep their own proportions to the end.  When a queue
    runs dry the others go on in proportion to their weights."""
    left = list(totals)
    queues = range(len(left))
    weigh = [t if w is None else w for t, w in zip(totals, weights or [None] * len(left))]
    out, at, base = [], 0, [0] * len(left)
    while sum(left):
        active = [k for k in queues if left[k]]
        total = sum(weigh[k] for k in active) or 1
        # Every active queue sends at least about a token a window.
        w = [max(weigh[k], 2 * total // length + 1) if left[k] else 0 for k in queues]
        total = sum(w)
        n = min(left[k] * total // (length * w[k]) for k in active)
        cum = [0]
        for x in w:
            cum.append(cum[-1] + x)
        while n > 0:
            seg = Segment(at, n, length, list(base), cum)
            if all(seg.sent(k, at + n) - base[k] <= left[k] for k in queues):
                break
            n -= 1
        if n > 0:
            took = [seg.sent(k, at + n) - base[k] for k in queues]
        else:  # one window in which a queue may run dry: the rest is shared out
            n, size, took = 1, min(length, sum(left)), [0] * len(left)
            while sum(took) < size:
                room = size - sum(took)
                open_ = [k for k in active if took[k] < left[k]]
                share = sum(w[k] for k in open_)
                add = {k: min(left[k] - took[k], room * w[k] // share) for k in open_}
                if not any(add.values()):
                    add = {k: 1 for k in sorted(open_, key=lambda k: (-w[k], k))[:room]}
                for k, x in add.items():
                    took[k] += x
            cum = [0]
            for x in took:
                cum.append(cum[-1] + x)
            seg = Segment(at, 1, size, list(base), cum)
        out.append(seg)
        at += n
        base = [b + t for b, t in zip(base, took)]
        left = [x - t for x, t in zip(left, took)]
    return out


class Layout:
    """Finds the pieces of a stretch of one queue."""

    def __init__(self, segments: list[Segment]):
        self.segments = segments
        self.bases = [list(col) for col in zip(*(s.base for s in segments))]

    def pieces(self, k: int, begin: int, end: int):
        """(begin, end, window, offset in the window) of queue tokens [begin, end)."""
        s = bisect.bisect_right(self.bases[k], begin) - 1
        at = begin
        while at < end:
            seg = self.segments[s]
            share = seg.cum[k + 1] - seg.cum[k]
            stop = self.bases[k][s + 1] if s + 1 < len(self.segments) else None
            if share == 0 or (stop is not None and at >= stop):
                s += 1
                continue
            j = seg.first + min(max((at - seg.base[k]) * seg.cum[-1] // (seg.size * share), 0), seg.count - 1)
            while j > seg.first and seg.sent(k, j) > at:
                j -= 1
            while j + 1 < seg.first + seg.count and seg.sent(k, j + 1) <= at:
                j += 1
            here = seg.sent(k, j)
            while at < end and j < seg.first + seg.count:
                after = seg.sent(k, j + 1)
                upto = min(end, after)
                if upto > at:
                    yield at, upto, j, seg.offset(k, j) + at - here
                    at = upto
                here = after
                j += 1
            s += 1


#: Children of a node below the top, and window tokens there for each child.
FAN, CHILD_TOKENS = 16, 16


class Node:
    """A layout whose windows, one after the other, are the tokens of queue
    ``k`` of the node ``up``, or the windows themselves at the top."""

    def __init__(self, totals: list[int], weights: list[int] | None, length: int, up: Node | None = None, k: int = 0):
        self.layout, self.length, self.up, self.k = Layout(plan_windows(totals, weights, length)), length, up, k

    def pieces(self, k: int, begin: int, end: int):
        """As ``Layout.pieces``, in windows of the top."""
        if self.up is None:
            yield from self.layout.pieces(k, begin, end)
            return
        held = None
        for lo, hi, window, offset in self.layout.pieces(k, begin, end):
            at = window * self.length + offset
            for a, z, w, o in self.up.pieces(self.k, at, at + hi - lo):
                a, z = a + lo - at, z + lo - at
                if held and held[2] == w and held[3] + held[1] - held[0] == o:
                    held = (held[0], z, *held[2:])
                    continue
                if held:
                    yield held
                held = (a, z, w, o)
        if held:
            yield held


def plan_sources(totals: dict[str, int], weights: dict[str, int] | None, length: int, max_queues: int) -> dict[str, tuple[Node, int]]:
    """Node and queue of every source.  The top has at most ``max_queues``
    queues (at least two); sources without one of their own share a queue that is laid
    out again by their weights (or totals), in a tree of ``FAN`` children a node."""
    if weights:
        listed = sorted(weights, key=lambda s: (-weights[s], s))
    else:
        listed = sorted(totals, key=lambda s: (-totals[s], s))[: max_queues - 1]
    own, tail = listed, []
    if len(listed) > max_queues - 1:
        own, tail = listed[: max(0, max_queues - 2)], [s for s in listed[max(0, max_queues - 2) :] if totals.get(s)]
    own, known = sorted(own), set(listed)
    rest = [s for s in sorted(totals, key=lambda s: (-totals[s], s)) if s not in known]
    sums, target = [totals.get(s, 0) for s in own], [int(weights[s]) for s in own] if weights else None
    for shared, weigh in ((tail, weights), (rest, None)) if tail else ((rest, None),):
        sums.append(sum(totals[s] for s in shared))
        if target is not None:
            mean = max(1, sum(int(weights[s]) for s in listed) // len(listed))
            target.append(sum(int(weigh[s]) for s in shared) if weigh else mean)
    top = Node(sums, target, length)
    place = {s: (top, k) for k, s in enumerate(own)}
    share = target or sums

    def nest(sources: list[str], weigh, up: Node, k: int, room: int) -> None:
        step = 1
        while step * FAN < len(sources):
            step *= FAN
        groups = [sources[i : i + step] for i in range(0, len(sources), step)]
        w = [sum(int(weigh[s]) for s in g) for g in groups]
        # As many tokens as the queue above has in a window, if all children fit.
        node = Node([sum(totals[s] for s in g) for g in groups], w, max(room, CHILD_TOKENS * len(groups)), up, k)
        for i, g in enumerate(groups):
            if step == 1:
                place[g[0]] = (node, i)
            else:
                nest(g, weigh, node, i, node.length * w[i] // max(1, sum(w)))

    for k, (shared, weigh) in enumerate(((tail, weights), (rest, totals)) if tail else ((rest, totals),), len(own)):
        if len(shared) == 1:
            place[shared[0]] = (top, k)
        elif shared:
            nest(shared, weigh or totals, top, k, length * share[k] // max(1, sum(share)))
    return place


def pack(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    length: int = 4096, end_id: int = 2, weights: dict[str, int] | None = None, max_queues: int = 256,
) -> DataFrame:
    """Pieces ``id, source, start, length, ids_crc32, ids`` (little-endian
    16-bit), ``doc_tokens, sequence_id, offset`` of all rows packed into windows
    of ``length`` tokens.

    ``weights`` are target token proportions by source; without them every
    source keeps its share of the corpus; sources that the weights do not name
    have their mean weight together.  The ``max_queues - 1`` largest sources (or those
    of the weights) have a queue each, the others share one that holds each at
    its share again (and leave what a dry one had to those they share it with);
    nothing is left out.  The driver holds a row per source.  Null or empty text is its end token alone; a null
    source is a source; repeated rows are packed each; null ids pass through.  An
    empty table gives no rows; other columns are ignored."""
    spark = ready(df.sparkSession)
    tokens = tokenized(df, tokenizer_path, end_id, id_col, text_col, source_col).checkpoint()
    by_part = tokens.groupBy("shard", "source").agg(F.sum("n").alias("n")).checkpoint()
    totals = {r[0]: int(r[1]) for r in by_part.groupBy("source").agg(F.sum("n")).collect()}
    sent = spark.sparkContext.broadcast(plan_sources(totals, weights, length, max_queues))
    order = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0)))
    placed = tokens.join(bases.select("shard", "source", "base"), ["shard", "source"])

    def run(batches):
        place = sent.value
        for b in batches:
            out = [[] for _ in range(9)]
            cols = [b.column(c).to_pylist() for c in ("id", "source", "base", "at", "n", "ids")]
            for i, source, base, at, n, raw in zip(*cols):
                ids = np.frombuffer(raw, "<u2")
                wide = ids.astype("<u4").tobytes()
                begin = base + at
                node, k = place[source]
                for lo, hi, window, offset in node.pieces(k, begin, begin + n):
                    a, z = lo - begin, hi - begin
                    for col, v in zip(out, (i, source, a, z - a, zlib.crc32(wide[4 * a : 4 * z]), raw[2 * a : 2 * z], n, window, offset)):
                        col.append(v)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["id", "source", "start", "length", "ids_crc32", "ids", "doc_tokens", "sequence_id", "offset"])

    schema = "id long, source string, start long, length long, ids_crc32 long, ids binary, doc_tokens long, sequence_id long, offset long"
    return placed.select("id", "source", "base", "at", "n", "ids").mapInArrow(run, schema)
