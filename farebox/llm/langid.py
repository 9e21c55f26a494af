"""Language identification with a byte convolutional network in numpy.

Filters of several widths run over one-hot bytes (so a filter tap is a table
row per byte), each filter's maximum over a fixed-length window feeds a
softmax.  Trained with Adam on windows of a bounded sample of labelled rows;
applied to every window of every text, in batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import flat, ready, row_chunks

UNKNOWN = "und"


class ByteCNN:
    """Multi-width byte filters, max pooling, softmax."""

    def __init__(self, classes: int, widths=(2, 3, 4), filters: int = 8, length: int = 256, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.widths, self.filters, self.length = tuple(widths), filters, length
        self.taps = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in self.widths]
        self.bias = [np.zeros(filters, np.float32) for _ in self.widths]
        self.out = rng.normal(0, 0.1, (filters * len(self.widths), classes)).astype(np.float32)
        self.out_bias = np.zeros(classes, np.float32)

    def pooled(self, x: np.ndarray, n: np.ndarray, positions: bool = False):
        """Largest rectified filter response per window; x holds windows of
        bytes, n their used lengths."""
        feats, where = [], []
        for taps, bias in zip(self.taps, self.bias):
            w = len(taps)
            m = x.shape[1] - w + 1
            resp = taps[0][x[:, :m]]
            for o in range(1, w):
                resp += taps[o][x[:, o : o + m]]
            if (n < x.shape[1]).any():  # taps past the end of a short window do not count
                resp[np.arange(m)[None, :] >= np.maximum(n - w + 1, 1)[:, None]] = -1e9
            if positions:
                at = resp.argmax(axis=1)
                where.append(at)
                top = np.take_along_axis(resp, at[:, None, :], axis=1)[:, 0, :]
            else:
                top = resp.max(axis=1)
            feats.append(np.maximum(top + bias, 0))
        feats = np.concatenate(feats, axis=1)
        return (feats, where) if positions else feats

    def tables(self):
        """The taps folded over byte pairs: one look-up instead of two."""
        out = []
        for taps in self.taps:
            folded = [(taps[o][:, None, :] + taps[o + 1][None, :, :]).reshape(65536, -1) for o in range(0, len(taps) - 1, 2)]
            out.append((len(taps), folded, taps[-1] if len(taps) % 2 else None))
        return out

    def pooled_fast(self, x: np.ndarray, n: np.ndarray, tables) -> np.ndarray:
        """As ``pooled``, by pair tables and a tree of maxima."""
        one = x.astype(np.intp)
        two = (one[:, :-1] << 8) | one[:, 1:]
        short = (n < x.shape[1]).any()
        feats = []
        for (w, folded, last), bias in zip(tables, self.bias):
            m = x.shape[1] - w + 1
            resp = np.take(folded[0], two[:, :m], axis=0)
            for o, table in enumerate(folded[1:], start=1):
                resp += np.take(table, two[:, 2 * o : 2 * o + m], axis=0)
            if last is not None:
                resp += np.take(last, one[:, w - 1 : w - 1 + m], axis=0)
            if short:
                resp[np.arange(m)[None, :] >= np.maximum(n - w + 1, 1)[:, None]] = -1e9
            while m > 1:
                half = m // 2
                np.maximum(resp[:, :half], resp[:, m - half : m], out=resp[:, :half])
                m -= half
            feats.append(np.maximum(resp[:, 0] + bias, 0))
        return np.concatenate(feats, axis=1)

    def probabilities(self, feats: np.ndarray) -> np.ndarray:
        z = feats @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)

    def fit(self, x, n, y, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 3):
        rng = np.random.default_rng(seed)
        params = [*self.taps, *self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            # Crops teach the network to decide short texts as well.
            for lo in range(0, len(order), batch):
                pick = order[lo : lo + batch]
                size = np.minimum(n[pick], np.maximum(8, (n[pick] * rng.choice([0.1, 0.25, 1.0, 1.0], len(pick))).astype(int)))
                xb = np.where(np.arange(x.shape[1])[None, :] < size[:, None], x[pick], 32).astype(np.uint8)
                feats, where = self.pooled(xb, size, positions=True)
                delta = self.probabilities(feats)
                delta[np.arange(len(pick)), y[pick]] -= 1
                delta /= len(pick)
                back = (delta @ self.out.T) * (feats > 0)
                grads = []
                bias_grads = []
                for k, w in enumerate(self.widths):
                    g = back[:, k * self.filters : (k + 1) * self.filters]
                    tap = np.zeros_like(self.taps[k])
                    rows = np.arange(len(pick))[:, None]
                    for o in range(w):
                        np.add.at(tap[o], (xb[rows, where[k] + o], np.arange(self.filters)[None, :]), g)
                    grads.append(tap)
                    bias_grads.append(g.sum(axis=0))
                grads += [*bias_grads, feats.T @ delta, delta.sum(axis=0)]
                step += 1
                for p, g, a, b in zip(params, grads, first, second):
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.999
                    b += 0.001 * g * g
                    p -= (rate * (0.5 ** (epoch // 3)) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
        return self

    def predict_rows(self, data: np.ndarray, offsets: np.ndarray, batch: int = 64) -> np.ndarray:
        """Class probabilities of every row: the mean over all of its windows,
        each weighted by its bytes.  Rows without bytes are uniform."""
        classes = len(self.out_bias)
        rows = len(offsets) - 1
        step = self.length - max(self.widths) + 1
        sizes = np.diff(offsets)
        counts = np.maximum(1, -(-np.maximum(sizes - (self.length - step), 0) // step)) * (sizes > 0)
        row = np.repeat(np.arange(rows), counts)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = offsets[row] + inner * step
        used = np.minimum(offsets[row + 1] - start, self.length)
        total = np.zeros((rows, classes))
        grid = np.arange(self.length)
        tables = self.tables()
        for lo in range(0, len(row), batch):
            s, u, r = start[lo : lo + batch], used[lo : lo + batch], row[lo : lo + batch]
            at = s[:, None] + grid[None, :]
            x = np.where(grid[None, :] < u[:, None], data[np.minimum(at, len(data) - 1)], 32)
            np.add.at(total, r, self.probabilities(self.pooled_fast(x, u, tables)) * u[:, None])
        weight = total.sum(axis=1, keepdims=True)
        return np.where(weight > 0, total / np.maximum(weight, 1e-12), 1.0 / max(classes, 1))


def held_out(id_col: str, mod: int, part: int):
    """crc32 of the id's text, modulo ``mod``, equals ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % mod == part, F.lit(False))


def training_windows(df: DataFrame, id_col: str, text_col: str, lang_col: str, documents: int, per_document: int, length: int, labels: int = 1000):
    """At most ``documents`` labelled texts, spread evenly over the labels by a
    hash order, with ``per_document`` windows each at hashed places of the
    whole text: (labels, bytes, used lengths, classes).  The ``labels`` most
    frequent labels are learned (ties by name): a dirty column with more values
    neither reaches the driver nor the network whole."""
    rows = df.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").cast("string").alias("l"))
    rows = rows.where("l is not null and i is not null").where(F.col("t").rlike(r"\p{L}"))
    sizes = {r[0]: r[1] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(labels).collect()}
    names = sorted(sizes)
    if not names:
        return [], None, None, None
    rows = rows.where(F.col("l").isin(names)) if len(names) == labels else rows
    scale = F.create_map(*[F.lit(v) for n in names for v in (n, float(sizes[n]))])[F.col("l")]
    unit = F.pmod(F.xxhash64(F.lit("language sample"), "i"), F.lit(1 << 40)) / float(1 << 40)
    room = F.greatest(F.octet_length(F.col("t").cast("binary")) - length, F.lit(0)) + 1
    cuts = [F.substring(F.col("t").cast("binary"), (F.pmod(F.xxhash64(F.lit(k), "i"), room) + 1).cast("int"), F.lit(length)) for k in range(per_document)]
    # A label's n-th row in hash order has o near n: rows far past the bound need not be ordered at all.
    sample = rows.select("l", "i", (unit * scale).alias("o"), F.array(*cuts).alias("w")).where(F.col("o") <= 2.0 * documents / len(names) + 100)
    got = sample.orderBy("o", "i").limit(documents).collect()
    label, text = [], []
    for r in got:
        for w in {bytes(w) for w in r.w}:
            label.append(names.index(r.l))
            text.append(w)
    order = sorted(range(len(text)), key=lambda k: (label[k], text[k]))
    x = np.full((len(text), length), 32, np.uint8)
    n = np.zeros(len(text), np.int64)
    for row, k in enumerate(order):
        x[row, : len(text[k])] = np.frombuffer(text[k], np.uint8)
        n[row] = len(text[k])
    return names, x, n, np.array([label[k] for k in order])


def identify(
    df: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    documents: int = 4000, per_document: int = 3, length: int = 256, carry: list[str] | None = None, labels: int = 1000,
) -> DataFrame:
    """``id, lang_pred, score`` for every row of ``df`` (then its ``carry``
    columns, as they are), from a network trained
    on at most ``documents`` labelled rows of ``train`` (a bounded, hashed
    sample; more rows do not change its size).  The whole text is read.

    Null texts and texts without a letter are ``und`` with score 0, as is
    everything when there is nothing to learn from.  Repeated rows get the same
    answer each, null ids pass through, other columns are ignored."""
    ready(df.sparkSession)
    names, x, n, y = training_windows(train, id_col, text_col, lang_col, documents, per_document, length, labels)
    text = F.col(f"`{text_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.when(text.rlike(r"\p{L}"), text.cast("binary")).alias("t"), *[F.col(f"`{c}`") for c in carry or []])
    if not names:
        return rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), *(carry or []))
    model = ByteCNN(len(names), length=length).fit(x, n, y)

    def run(batches):
        for b in batches:
            known = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            data, offsets = flat(b.column(1).fill_null(b""))
            prob = np.zeros((len(known), len(names)))
            for lo, hi in row_chunks(offsets):
                prob[lo:hi] = model.predict_rows(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            best = prob.argmax(axis=1) if len(prob) else np.zeros(0, int)
            pred = [names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            score = np.where(known, prob[np.arange(len(best)), best], 0.0).clip(0, 1)
            rest = [b.column(i) for i in range(2, b.num_columns)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), *rest], names=["id", "lang_pred", "score", *(carry or [])])

    kinds = "".join(f", `{c}` {t}" for c, t in rows.dtypes[2:])
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, lang_pred string, score double{kinds}")
