"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Fingerprint: 64 majority bits over the XXH64 of a text's word shingles.
2. Bits that occur together (correlation over *all* distinct fingerprints) go
   to the same of ``m`` parts, so that the other parts stay selective.
3. Two fingerprints within ``tau`` bits agree within t_i bits in some part i
   whenever the t_i sum to tau - m + 1 (t_i = -1 leaves the part out).  For
   every fingerprint a dynamic program over the parts picks the unequal
   thresholds with the fewest estimated candidates, from the exact number of
   fingerprints in its part values and the bit frequencies.
4. Probe the part index with every value inside the thresholds, verify the
   whole distance, and link.

A part value shared by more than ``bucket_cap`` fingerprints is not
paired up: its members and probers link through the values within half the
distance of them (two fingerprints within tau bits share one), which finds
the same components with a fixed number of rows per fingerprint.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import NULL_ID, ready, row_key, smallest_by
from farebox.llm.graph import components

BITS = 64


# ---------------------------------------------------------------- fingerprint
def fingerprint_bytes(text: bytes | None, shingle: int, seed: int = 42) -> int:
    """Fingerprint of one text (unsigned)."""
    import xxhash

    words = (text or b"").lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        parts = [joined]
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = np.concatenate(([0], gaps + 1))[: n - shingle + 1].tolist()
        ends = np.concatenate((gaps, [len(joined)]))[shingle - 1 :].tolist()
        parts = [joined[a:b] for a, b in zip(starts, ends)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(seed)), dtype=np.uint64, count=len(parts))
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, keyed: bool = False) -> DataFrame:
    """``id, fp`` (long, two's complement) of every row, and ``th``, its text's
    64-bit hash, if ``keyed``.  ASCII letters are
    lower-cased, words are runs without white space; a text with fewer words
    than a shingle is one shingle, one without words (or null) gives zero."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint_bytes(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            rest = [b.column(2)] if keyed else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *rest], names=["id", "fp", "th"][: 2 + keyed])

    src = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    src = src.withColumn("th", F.xxhash64("t")) if keyed else src
    return src.mapInArrow(run, "id long, fp long" + ", th long" * keyed)


# -------------------------------------------------------------- bit partition
def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, ones per bit, rows in which both bits are one), over all rows."""

    def run(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            v = b.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(v, axis=1, bitorder="little").astype(np.float32)
            both += x.T @ x
            n += len(x)
        if n:
            cells = np.concatenate((both.ravel().astype(np.int64), [n]))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    cells = dict(tuple(r) for r in fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect())
    both = np.array([cells.get(i, 0) for i in range(BITS * BITS)], dtype=np.float64).reshape(BITS, BITS)
    return cells.get(BITS * BITS, 0), np.diag(both).copy(), both


def group_bits(n: int, ones: np.ndarray, both: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy grouping: start a part with the free bit of strongest total
    correlation, then add the free bit most correlated with the part."""
    p = ones / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        first = max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())
        part = [first]
        free.remove(first)
        while len(part) < size:
            nxt = max(sorted(free), key=lambda b: corr[b, part].sum())
            part.append(nxt)
            free.remove(nxt)
        out.append(sorted(part))
    return out


def project(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of unsigned fingerprints, packed into a long."""
    out = np.zeros(len(fps), dtype=np.uint64)
    for at, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(at)
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of at most ``radius`` of ``width`` bits."""
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in c) for c in itertools.combinations(range(width), r)]
    return np.array(masks, dtype=np.uint64)


# ---------------------------------------------------------------- thresholds
def allocate(cost: np.ndarray, tau: int) -> np.ndarray:
    """Thresholds per part that sum to tau - m + 1 at least cost, for many
    fingerprints at once.  cost[x, i, t + 1] for t = -1..tau."""
    n, m, levels = cost.shape
    goal = tau - m + 1
    # best[s]: least cost of the parts so far with thresholds summing to s - m.
    span = m + tau + 2 + m * tau
    best = np.full((n, span), np.inf)
    best[:, m] = 0
    choice = np.zeros((m, n, span), dtype=np.int8)
    for i in range(m):
        nxt = np.full((n, span), np.inf)
        for level in range(levels):
            t = level - 1
            lo, hi = max(0, t), min(span, span + t)
            cand = best[:, lo - t : hi - t] + cost[:, i, level][:, None]
            better = cand < nxt[:, lo:hi]
            nxt[:, lo:hi] = np.where(better, cand, nxt[:, lo:hi])
            choice[i, :, lo:hi] = np.where(better, t, choice[i, :, lo:hi])
        best = nxt
    out = np.zeros((n, m), dtype=np.int64)
    at = np.full(n, goal + m)
    rows = np.arange(n)
    for i in range(m - 1, -1, -1):
        out[:, i] = choice[i, rows, at]
        at = at - out[:, i]
    return out


def estimated_costs(fps: np.ndarray, counts: np.ndarray, groups: list[list[int]], p: np.ndarray, tau: int) -> np.ndarray:
    """Candidates (plus one per probe) of each part and threshold: the exact
    size of the fingerprint's own part value, carried to neighbouring values
    by how often each of its bits takes the other value."""
    n, m = len(fps), len(groups)
    cost = np.zeros((n, m, tau + 2))
    for i, bits in enumerate(groups):
        ratio = np.empty((n, len(bits)))
        for k, b in enumerate(bits):
            one = ((fps >> np.uint64(b)) & np.uint64(1)).astype(bool)
            q = min(max(p[b], 1e-6), 1 - 1e-6)
            ratio[:, k] = np.where(one, (1 - q) / q, q / (1 - q))
        poly = [np.ones(n)] + [np.zeros(n) for _ in range(tau)]  # elementary symmetric sums
        for k in range(len(bits)):
            for r in range(tau, 0, -1):
                poly[r] = poly[r] + poly[r - 1] * ratio[:, k]
        mass, probes = np.zeros(n), 0
        for t in range(tau + 1):
            mass = mass + poly[t]
            probes += sum(1 for _ in itertools.combinations(range(len(bits)), t))
            cost[:, i, t + 1] = counts[:, i] * mass + probes
    return cost


def part_count(n: int, tau: int) -> int:
    """Parts of about log2(n) bits, so a part value holds few fingerprints."""
    return int(min(tau + 1, max(2 if tau else 1, BITS // (max(n, 1).bit_length() + 1))))


# --------------------------------------------------------------------- links
def half_distance_links(fps: DataFrame, tau: int) -> DataFrame:
    """Edges that connect exactly what lies within ``tau`` bits: all rows
    that share a value within tau // 2 bits of one and tau - tau // 2 of the
    other join the smallest near one."""
    near, far = tau // 2, tau - tau // 2
    masks = ball(BITS, far).view(np.int64)
    small = len(ball(BITS, near))
    lit = F.explode(F.array(*[F.struct(F.lit(int(x)).alias("mask"), F.lit(i < small).alias("near")) for i, x in enumerate(masks)])).alias("m")
    spread = fps.select("fp", lit).select("fp", F.col("fp").bitwiseXOR(F.col("m.mask")).alias("mid"), F.col("m.near").alias("near"))
    hub = spread.groupBy("mid").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    hub = hub.where("hub is not null and a <> b").select("mid", "hub")
    return spread.join(hub, "mid").where("fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v"))


def pigeonhole_links(fps: DataFrame, tau: int, parts: int | None = None, bucket_cap: int = 128) -> DataFrame:
    """``fp`` (distinct longs) -> edges ``u, v`` whose components are those of
    all pairs within ``tau`` bits."""
    n, ones, both = bit_statistics(fps)
    m = parts or part_count(n, tau)
    groups = group_bits(n, ones, both, m)
    p = ones / max(n, 1)
    link_rows = len(ball(BITS, tau - tau // 2))

    def index(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            vals = [project(fp.view(np.uint64), bits) for bits in groups]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(m, dtype=np.int32), len(fp))), pa.array(np.concatenate(vals).view(np.int64)), pa.array(np.tile(fp, m))],
                names=["part", "val", "fp"],
            )

    entries = fps.select("fp").mapInArrow(index, "part int, val long, fp long")
    sizes = entries.groupBy("part", "val").agg(F.count("*").alias("size"))
    entries = entries.join(sizes, ["part", "val"]).checkpoint()
    per_fp = entries.groupBy("fp").agg(*[F.max(F.when(F.col("part") == i, F.col("size"))).alias(f"c{i}") for i in range(m)])

    def probe(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            un = fp.view(np.uint64)
            counts = np.stack([b.column(1 + i).to_numpy(zero_copy_only=False) for i in range(m)], axis=1)
            # A crowded value costs its fixed number of linking rows instead.
            counts = np.where(counts > bucket_cap, link_rows, counts)
            t = allocate(estimated_costs(un, counts, groups, p, tau), tau)
            for i, bits in enumerate(groups):
                val = project(un, bits)
                for radius in range(tau + 1):
                    pick = np.flatnonzero(t[:, i] == radius)
                    masks = ball(len(bits), radius)
                    for at in range(0, len(pick), max(1, (1 << 18) // len(masks))):
                        some = pick[at : at + max(1, (1 << 18) // len(masks))]
                        got = (val[some][:, None] ^ masks[None, :]).ravel()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(got), i, np.int32)), pa.array(got.view(np.int64)), pa.array(np.repeat(fp[some], len(masks)))],
                            names=["part", "val", "x"],
                        )

    probes = per_fp.mapInArrow(probe, "part int, val long, x long")
    hit = probes.join(entries.where(F.col("size") <= bucket_cap).select("part", "val", "fp"), ["part", "val"])
    pairs = hit.where((F.col("x") != F.col("fp")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("fp"))) <= tau))
    pairs = pairs.select(F.greatest("x", "fp").alias("u"), F.least("x", "fp").alias("v"))
    crowded = entries.where(F.col("size") > bucket_cap)
    members = crowded.select("fp").unionAll(
        probes.join(crowded.select("part", "val").distinct(), ["part", "val"], "left_semi").select(F.col("x").alias("fp"))
    ).distinct()
    return pairs.unionAll(half_distance_links(members, tau))


def _rooted(groups: DataFrame, max_bits: int, bucket_cap: int) -> DataFrame:
    """``fp, low`` (one row per fingerprint) with the ``root`` of its component."""
    links = components(pigeonhole_links(groups, max_bits, bucket_cap=bucket_cap))
    return groups.join(links.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def simhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, bucket_cap: int = 128
) -> DataFrame:
    """One row per input row: ``id``, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` bits (itself included).

    Null ids stay as rows and never name a component (null if a component
    has no other id).  Null and word-less texts have fingerprint zero and link
    like any other.  Repeated rows and ties share a fingerprint, so a component.
    An empty table gives no rows; further columns are ignored."""
    ready(df.sparkSession)
    fps = fingerprints(df, id_col, text_col, shingle).checkpoint()
    groups = fps.groupBy("fp").agg(F.min("id").alias("low")).checkpoint()
    rooted = _rooted(groups, max_bits, bucket_cap)
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.join(names, "root").select("fp", "component_id")
    out = fps.join(by_fp, "fp")
    return out.select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, keep_null_ids: bool = True
) -> DataFrame:
    """The input's rows without near copies: of each component the row with
    the smallest (id, text hash) stays, so that different texts under one id
    stand for themselves; of a repeated row (same id and text) one stays.

    Rows with a null id stay as they are, or with ``keep_null_ids=False`` take
    part after every other id, so that one row of each component is left."""
    ready(df.sparkSession)
    fps = fingerprints(df, id_col, text_col, shingle, keyed=True).checkpoint()
    groups = fps.groupBy("fp").agg(F.min(F.struct(F.coalesce("id", F.lit(NULL_ID)).alias("_id"), F.col("th").alias("_th"))).alias("low")).checkpoint()
    keep = _rooted(groups, max_bits, bucket_cap=128).groupBy("root").agg(F.min("low").alias("low")).select("low._id", "low._th")
    key = F.col(f"`{id_col}`")
    src = df.where(key.isNotNull()) if keep_null_ids else df
    # Repeated rows are reduced inside each task, before the shuffle.
    keyed = src.select(F.struct(*[F.col(f"`{c}`") for c in src.columns]).alias("_row"), smallest_by(src, [id_col, text_col]).alias("_order"), *row_key(id_col, text_col))
    one = keyed.groupBy("_id", "_th").agg(F.min_by("_row", "_order").alias("_row"))
    kept = one.join(keep, ["_id", "_th"], "left_semi").select("_row.*")
    return kept.unionAll(df.where(key.isNull())) if keep_null_ids else kept
