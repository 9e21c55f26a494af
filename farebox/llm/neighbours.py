"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become hashed byte-trigram vectors (log counts, inverse document
frequency), projected by a truncated singular value decomposition that is
fitted on a bounded sample of labelled texts.  The labelled latent vectors go
to every task; each document takes exact cosine products with all of them, in
blocks, and its nearest vote with their similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import flat, ready, row_chunks


def trigram_counts(data: np.ndarray, offsets: np.ndarray, dims: int) -> np.ndarray:
    """Hashed byte-trigram counts per row (rows x dims)."""
    rows = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((rows, dims), np.float32)
    d = data.astype(np.uint32)
    code = (d[:-2] << np.uint32(16)) | (d[1:-1] << np.uint32(8)) | d[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - int(dims).bit_length() + 1)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    inside = row[:-2] == row[2:]
    cell = row[:-2][inside] * dims + code[inside]
    return np.bincount(cell, minlength=rows * dims).reshape(rows, dims).astype(np.float32)


def concentration(counts: np.ndarray, bins: int = 12) -> np.ndarray:
    """How a row's trigrams are spread: the share of its mass in cells that
    hold 1/2, 1/4, ... of the row.  Tells repetition, which log counts hide.
    Cells seen under eight times count as spread, however short the row."""
    total = counts.sum(axis=1, keepdims=True)
    rows, cells = np.nonzero(counts)
    share = (counts[rows, cells] / total[rows, 0]) if len(rows) else np.zeros(0)
    level = np.minimum(-np.floor(np.log2(np.maximum(share, 1e-9))).astype(int), bins - 1)
    level[counts[rows, cells] < 8] = bins - 1
    return np.bincount(rows * bins + level, weights=share, minlength=len(counts) * bins).reshape(len(counts), bins).astype(np.float32)


class LatentSpace:
    """idf and truncated SVD (randomised range finder) of a sample."""

    def __init__(self, counts: np.ndarray, rank: int, seed: int = 5):
        n = len(counts)
        self.idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
        x = self._weigh(counts)
        rank = min(rank, *x.shape)
        rng = np.random.default_rng(seed)
        q = np.linalg.qr(x @ rng.normal(size=(x.shape[1], min(rank + 16, n))).astype(np.float32))[0]
        for _ in range(3):
            q = np.linalg.qr(x @ (x.T @ q))[0]
        _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
        self.basis = np.ascontiguousarray(vt[:rank].T).astype(np.float32)

    def _weigh(self, counts):
        x = np.log1p(counts) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        return np.concatenate((x, concentration(counts)), axis=1)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        z = self._weigh(counts) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def vote(z: np.ndarray, known: np.ndarray, labels: np.ndarray, k: int, sharpness: float, block: int = 256) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest; the mean
    label where nothing is similar."""
    k = min(k, len(known))
    out = np.empty(len(z))
    for lo in range(0, len(z), block):
        sims = z[lo : lo + block] @ known.T
        near = np.argpartition(sims, len(known) - k, axis=1)[:, len(known) - k :]
        w = np.maximum(np.take_along_axis(sims, near, axis=1), 0).astype(np.float64) ** sharpness
        total = w.sum(axis=1)
        out[lo : lo + block] = np.where(total > 1e-12, (w * labels[near]).sum(axis=1) / np.maximum(total, 1e-12), labels.mean())
    return out.clip(0, 1)


def quality(
    df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = 3000, dims: int = 2048, rank: int = 64, k: int = 15, sharpness: float = 4.0,
) -> DataFrame:
    """``id, score`` (0 to 1) of every row of ``df``.  ``labelled`` has
    ``id, label``; at most ``sample`` of them (a hash order; repeated ids count
    once, with the smaller label) are looked up in ``df`` and learned, one vector
    (the least) an id however many rows and texts share it.

    Whole texts are read.  Null and empty texts are like nothing and score the
    mean label; so does everything if there are no labels (0.5).  Repeated rows
    score alike, null ids pass through, other columns are ignored."""
    ready(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("t"))
    marks = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    marks = marks.where("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"))
    marks = marks.orderBy(F.xxhash64(F.lit("quality sample"), "id"), "id").limit(sample)  # the bound of what is broadcast

    def learn(batches):
        for b in batches:
            data, offsets = flat(b.column(2))
            for lo, hi in row_chunks(offsets):
                x = trigram_counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], dims)
                cells = [np.flatnonzero(r).astype(np.int32).tobytes() + r[r > 0].tobytes() for r in x]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(cells, pa.binary())], names=["id", "y", "x"])

    found = rows.join(F.broadcast(marks), "id").select("id", "y", "t").mapInArrow(learn, f"id {dict(rows.dtypes)['id']}, y int, x binary")
    found = found.groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x"))  # one row an id, however often it repeats
    got = sorted((r.id, bytes(r.x), r.y) for r in found.collect())
    counts = np.zeros((len(got), dims), np.float32)
    for i, (_, x, _) in enumerate(got):
        n = len(x) // 8
        counts[i, np.frombuffer(x, np.int32, n)] = np.frombuffer(x, np.float32, n, 4 * n)
    labels = np.array([y for _, _, y in got], dtype=np.float64)
    if not len(labels):
        return rows.select("id", F.lit(0.5).alias("score"))
    space = LatentSpace(counts, rank)
    known = space(counts)

    def run(batches):
        for b in batches:
            data, offsets = flat(b.column(1))
            out = np.zeros(len(offsets) - 1)
            for lo, hi in row_chunks(offsets):
                x = trigram_counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], dims)
                out[lo:hi] = vote(space(x), known, labels, k, sharpness)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=["id", "score"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, score double")
