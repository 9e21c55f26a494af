import hashlib
import random

import pytest

from farebox.llm import suffix


@pytest.mark.parametrize("alphabet", [1, 2, 3, 20])
def test_suffix_array_equals_sorted_suffixes(alphabet):
    rng = random.Random(alphabet)
    for n in [0, 1, 2, 3, 5, 8, 13, 40, 200] * 12:
        s = [rng.randint(1, alphabet) for _ in range(n)] + [0]
        assert suffix.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    for s in ([2, 1, 2, 1, 2, 1, 0], [1] * 50 + [0], [3, 2, 1] * 9 + [0], [1, 2] * 20 + [1, 0]):
        assert suffix.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def slow(rows, n):
    raw = [(i, (t or "").encode()) for i, t in rows]
    key = [float("inf") if i is None else i for i, _ in raw]
    low, mine = {}, {}
    for k, (_, b) in enumerate(raw):
        for a in range(len(b) - n + 1):
            x = b[a : a + n]
            low[x] = min(low.get(x, key[k]), key[k])
            mine.setdefault((key[k], b, x), a)
    out = []
    for k, (i, b) in enumerate(raw):
        gone = bytearray(len(b))
        for a in range(len(b) - n + 1):
            x = b[a : a + n]
            if low[x] < key[k] or mine[key[k], b, x] < a:
                gone[a : a + n] = b"\1" * n
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, blob int")
    out = suffix.suffix_dedup(df, **kw).select("id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"hot": 1}, {"flush_bytes": 1500, "bucket_bytes": 4000}, {"hot": 3, "flush_bytes": 700}])
def test_matches_brute_force(spark, kw):
    rng = random.Random(sum(kw.values()))
    words = ["the", "of", "ümlaut", "日本", "x", "alpha", "beta"] + [f"n{i}" for i in range(200)]
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(10, 60))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 50)))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s))
            parts += [s[a:] if rng.random() < 0.3 else s, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))]
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    rows += [(900, None), (None, rows[0][1]), (901, ""), (902, rows[5][1]), (902, rows[6][1] + "z"), *rows[7:12], (903, "a" * 900), (904, "ab" * 300), (905, "a" * 99), (906, "line of text, repeated\n" * 30)]
    assert run(spark, rows, **kw) == slow(rows, 100)


@pytest.mark.parametrize("window", [3, 50, 80, 300])
def test_other_windows(spark, window):
    rng = random.Random(window)
    shared = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(40, 700))) for _ in range(4)]
    rows = [(i, "".join(rng.choice("abcdef ") for _ in range(60)) + rng.choice(shared)[rng.randint(0, 30) :] + "z" * rng.randint(0, 320)) for i in range(40)]
    assert run(spark, rows, window=window) == slow(rows, window)


def test_anchor_must_fit_the_window(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, "a")], window=20, k=40)


def test_texts_that_share_32_bits_of_their_hash_stay_apart(spark):
    a, b = (f"text number {n} " + " ".join(f"w{n}x{j}" for j in range(13)) for n in (91729, 119412))
    rows = [(1, a), (7, a), (7, b), (None, a), (None, b)]
    assert run(spark, rows) == slow(rows, 100)


def test_empty_table(spark):
    assert run(spark, []) == []
