import hashlib
import random
import re

import pytest

from farebox.llm import substring


def slow(rows, n):
    w = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    key = [float("inf") if i is None else i for i, _ in w]
    low = {}
    for k, (_, ws) in enumerate(w):
        for a in range(len(ws) - n + 1):
            x = tuple(ws[a : a + n])
            low[x] = min(low.get(x, key[k]), key[k])
    out = []
    for k, (i, ws) in enumerate(w):
        gone = set()
        for a in range(len(ws) - n + 1):
            if low[tuple(ws[a : a + n])] < key[k]:
                gone.update(range(a, a + n))
        kept = " ".join(x for p, x in enumerate(ws) if p not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, kept int")
    out = substring.substring_dedup(df, **kw).select("id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


def sample(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["ß", "日本"]
    shared = [[rng.choice(vocab) for _ in range(rng.randint(5, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(ws))
            ws[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(ws)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("m", [1, 4])
def test_matches_brute_force(spark, m):
    rows = sample(m)
    rows += [(900, None), (None, rows[0][1]), (901, ""), (902, rows[5][1]), (902, rows[6][1]), *rows[7:12], (903, "a b " * 4000), (904, "a b " * 20)]
    assert run(spark, rows, minimiser_words=m) == slow(rows, 13)


def test_texts_that_share_32_bits_of_their_hash_stay_apart(spark):
    a, b = (f"text number {n} " + " ".join(f"w{n}x{j}" for j in range(13)) for n in (91729, 119412))
    rows = [(1, a), (7, a), (7, b), (None, a), (None, b)]
    assert run(spark, rows) == slow(rows, 13)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_kept_text_keeps_its_own_white_space(spark):
    p = " ".join(f"p{i}" for i in range(13))
    df = spark.createDataFrame([(1, p), (2, f"x\ny {p} z\n\nq"), (3, "a\n b")], "doc_id long, text string")
    got = {r.id: r.kept for r in substring.substring_dedup(df).collect()}
    assert got == {1: p.encode(), 2: b"x\ny z\n\nq", 3: b"a\n b"}
