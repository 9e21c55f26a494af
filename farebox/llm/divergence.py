"""Divergence of sources within a language, by their term frequencies.

Terms are counted per shard (a run of texts of about ``shard_bytes``) by sorting
pointers: every term start in the Arrow text buffer is a pointer, and a
multikey quicksort over eight-byte characters orders them by the bytes they
point at.  All segments of a depth are sorted at once; a segment of equal
characters goes on to the next eight bytes.  Runs of equal terms then give the
document frequency and the counts by source.  Spark adds the shards up, keeps
the terms with enough documents, and compares the sources on integers only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import flat, is_small, join_groups, ready, row_chunks

#: Width of a sort character in bytes.
WIDTH = 8

#: Bytes of a term: letters and all bytes of other alphabets.
IS_TERM = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    IS_TERM[_lo : _hi + 1] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every term."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = IS_TERM[data]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # A term does not reach over the end of a row.
    edge = offsets[1:-1]
    edge = np.unique(edge[(edge > 0) & (edge < len(data))])
    edge = edge[(inside[edge] == 1) & (inside[edge + 1] == 1)]
    if len(edge):
        start, end = np.sort(np.concatenate((start, edge))), np.sort(np.concatenate((end, edge)))
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def characters(words: np.ndarray, start: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes behind ``depth`` of every pointer, as big-endian
    numbers; bytes behind the term's end are zero, which no term holds."""
    left = np.clip(end - start - depth, 0, WIDTH)
    key = words[np.minimum(start + depth, len(words) - 1)].astype(np.uint64)
    shift = ((WIDTH - left) * 8).astype(np.uint64)
    return np.where(left > 0, key >> np.minimum(shift, np.uint64(63)) << np.minimum(shift, np.uint64(63)), np.uint64(0))


def sort_pointers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each pointer's term, a pointer of each term): terms are
    numbered in byte order.

    A level sorts the pointers still open by (segment, next eight bytes): first
    by the character alone, which gives its rank, then by segment and rank in
    one number.  Pointers whose term ends within the character are done."""
    n = len(start)
    padded = np.concatenate((data, np.zeros(WIDTH, np.uint8)))
    words = np.ndarray(len(padded) - WIDTH + 1, dtype=">u8", buffer=padded, strides=(1,))
    order, place, segment = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    first = np.zeros(n, dtype=bool)  # positions where another term begins
    first[:1] = True
    depth = 0
    while len(place):
        mine = order[place]
        key = characters(words, start[mine], end[mine], depth)
        by = np.argsort(key)
        step = np.ones(len(by), dtype=np.int64)
        step[1:] = key[by][1:] != key[by][:-1]
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(step)
        code = (segment << 32) | rank
        by = np.argsort(code) if depth else by
        code = code[by]
        order[place] = mine[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = code[1:] != code[:-1]
        first[place[new]] = True
        # On to the next character where the term may go on and is not alone.
        alone = new & np.append(new[1:], True)
        on = ((key[by] & np.uint64(0xFF)) != 0) & ~alone
        place, segment = place[on], np.cumsum(new)[on]
        depth += WIDTH
    number = np.cumsum(first) - 1
    term = np.empty(n, np.int64)
    term[order] = number
    return term, order[np.flatnonzero(first)]


def count_shard(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms as binary, group, count, documents) of every term and group that
    occur together; ``group`` numbers the group of each row."""
    low = _LOWER[data]
    start, end, row = terms(low, offsets)
    if not len(start):
        return pa.array([], pa.binary()), *(np.zeros(0, np.int64) for _ in range(3))
    number, one = sort_pointers(low, start, end)
    # Rows in the order of their groups, so that a run of codes is a group's.
    by = np.argsort(group, kind="stable")
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    code = np.sort(number * len(group) + place[row])
    lead = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    tf = np.diff(np.append(lead, len(code)))
    term, doc = np.divmod(code[lead], len(group))
    mine = group[by][doc]
    cut = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (mine[1:] != mine[:-1]))))
    length = (end - start)[one]
    at = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
    body = low[np.repeat(start[one] - at[:-1], length) + np.arange(at[-1])]
    spelled = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(at), pa.py_buffer(body)])
    return spelled.take(pa.array(term[cut])), mine[cut], np.add.reduceat(tf, cut), np.diff(np.append(cut, len(lead)))


def term_counts(df: DataFrame, text_col: str, lang_col: str, source_col: str, shard_bytes: int = 8 << 20) -> DataFrame:
    """``lang, source, term, n, df`` per shard: one row per term and group."""

    def flush(held):
        data, sizes, keys = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), [k for h in held for k in h[2]]
        names = sorted(set(keys))
        number = {k: i for i, k in enumerate(names)}
        spelled, group, n, docs = count_shard(data, np.concatenate(([0], np.cumsum(sizes))), np.array([number[k] for k in keys], np.int64))
        lang, source = (pa.array([k[i] for k in names], pa.string()).take(pa.array(group)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, spelled, pa.array(n), pa.array(docs)], names=["lang", "source", "term", "n", "df"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, offsets = flat(batch.column(2))
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for lo, hi in row_chunks(offsets, shard_bytes):
                held.append((np.array(data[offsets[lo] : offsets[hi]]), np.diff(offsets[lo : hi + 1]), keys[lo:hi]))
                size += len(held[-1][0])
                if size >= shard_bytes:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return _texts(df, text_col, lang_col, source_col).mapInArrow(run, "lang string, source string, term binary, n long, df long")


def _texts(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    names = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    return df.select(*names, F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"))


#: Scale of the smoothed shares.
SCALE = 1_000_000_000


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 v)), exactly."""
    top = (F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")).alias("t")
    return F.lit(1).cast("long") + F.call_function("div", top, (total + 2 * v).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_docs: int = 10, top: int = 10, shard_bytes: int = 8 << 20, small: bool | None = None,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group.

    A language keeps the terms (runs of letters and other alphabets' bytes,
    A-Z lower-cased) that at least ``min_docs`` of its rows hold; a group's
    share of a term is add-two smoothed and scaled to integers.  Part ``pair``:
    the sum of ``distance`` over the kept terms to each other source of the
    language, all ranks.  Part ``term``: the ``top`` kept terms that the group
    has more often than its language, by distance.  Ties go by the item's
    bytes.  Null text, language or source read as ''.  Repeated rows count each;
    a language that keeps no term has pairs of value 0; an empty table gives no
    rows; other columns are ignored.

    The absent terms of a pair of sources are not visited: their distance
    depends on the two smoothing shares alone, so a pair costs the terms that
    both hold, plus the distinct counts of either.  ``small`` fixes whether the
    group table is broadcast (by default its size is checked)."""
    ready(df.sparkSession)
    counts = term_counts(df, text_col, lang_col, source_col, shard_bytes)
    # One exchange: by language and term; both aggregates below keep that partitioning.
    counts = counts.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lang", "term")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    kept = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("by"))
    kept = kept.where(F.col("df") >= min_docs).select("lang", "term", F.col("n").alias("lang_n"), "by").checkpoint()
    cells = kept.select("lang", "term", "lang_n", F.explode("by").alias("x")).select("lang", "term", "lang_n", "x.source", "x.n")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = _texts(df, text_col, lang_col, source_col).select("lang", "source").distinct()
    groups = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "v", "lang_total"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    p0 = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("v"))).otherwise(F.lit(1))
    groups = groups.withColumn("g", number).withColumn("p0", p0).checkpoint()
    if small is None:
        small = is_small(groups, ["lang", "source"])

    stats = groups.select("lang", "source", "g", "p0", "total", "v", "lang_total")
    cells = join_groups(cells, stats, ["lang", "source"], small).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    cells = cells.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).checkpoint()

    by_item = [F.desc("value"), F.asc("item")]
    over = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    over = over.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_item))).where(F.col("rank") <= top)

    left = groups.select("lang", F.col("g").alias("i"), F.col("p0").alias("pi"), "v", "source")
    right = groups.select("lang", F.col("g").alias("j"), F.col("p0").alias("pj"), F.col("source").alias("item"))
    # What a source's terms add where the other source lacks them, by distinct share.
    shares = cells.groupBy("lang", F.col("g").alias("i"), F.col("p0").alias("pi"), "p").agg(F.count("*").alias("many"))
    lone = shares.join(right, "lang").where("i != j")
    lone = lone.groupBy("lang", "i", "j").agg(F.sum(F.col("many") * (distance(F.col("p"), F.col("pj")) - distance(F.col("pi"), F.col("pj")))).alias("add"))
    lone = lone.unionAll(lone.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "add"))
    both = common_terms(cells)
    both = both.unionAll(both.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "add"))
    extra = lone.unionAll(both).groupBy("lang", "i", "j").agg(F.sum("add").alias("add"))
    pairs = left.join(right, "lang").where("i != j").join(extra, ["lang", "i", "j"], "left")
    value = F.col("v") * distance(F.col("pi"), F.col("pj")) + F.coalesce("add", F.lit(0))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_item)))
    return pairs.unionByName(over)


def common_terms(cells: DataFrame, block_pairs: int = 1 << 21) -> DataFrame:
    """``lang, i, j, add`` with i < j: what the terms that two sources both
    hold add to their distance beyond the two one-sided sums."""
    rows = cells.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("g", "p", "p0"))).alias("x"))
    rows = rows.where(F.size("x") > 1).select("lang", F.col("x.g").alias("g"), F.col("x.p").alias("p"), F.col("x.p0").alias("p0"))

    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    def block(langs, sizes, g, p, p0):
        # Entry a of a term meets the entries behind it.
        at = np.concatenate(([0], np.cumsum(sizes)))
        behind = np.repeat(at[1:], sizes) - np.arange(at[-1]) - 1
        a = np.repeat(np.arange(at[-1]), behind)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.concatenate(([0], np.cumsum(behind)[:-1])), behind)
        add = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
        lang = np.repeat(langs, sizes)[a]
        order = np.lexsort((g[b], g[a], lang))
        key = [x[order] for x in (lang, g[a], g[b])]
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
        lead = np.flatnonzero(new)
        return [*(k[lead] for k in key), np.add.reduceat(add[order], lead)]

    def run(batches):
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            sizes = np.diff(batch.column(1).offsets.to_numpy()).astype(np.int64)
            cols = [batch.column(c).flatten().to_numpy().astype(np.int64) for c in (1, 2, 3)]
            at = np.concatenate(([0], np.cumsum(sizes)))
            pairs = np.concatenate(([0], np.cumsum(sizes * (sizes - 1) // 2)))
            for lo, hi in row_chunks(pairs, block_pairs):
                lang, i, j, add = block(coded.indices.to_numpy()[lo:hi], sizes[lo:hi], *(c[at[lo] : at[hi]] for c in cols))
                yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(lang)), pa.array(i), pa.array(j), pa.array(add)], names=["lang", "i", "j", "add"])

    return rows.mapInArrow(run, "lang string, i long, j long, add long").groupBy("lang", "i", "j").agg(F.sum("add").alias("add"))
