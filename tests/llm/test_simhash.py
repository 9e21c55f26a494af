import random
import re

import numpy as np
import pytest
import xxhash

from farebox.llm import simhash
from farebox.llm.common import ready
from farebox.llm.graph import components

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not w:
        return 0
    sh = [" ".join(w)] if len(w) < n else [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, edges):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def slow_components(rows, tau=2):
    fp = [(i, slow_fingerprint(t)) for i, t in rows]
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fp)):
        for b in range(a):
            if (fp[a][1] ^ fp[b][1]).bit_count() <= tau:
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(fp):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, format(f, "016x"), low.get(find(k))) for k, (i, f) in enumerate(fp)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    return sorted((tuple(r) for r in simhash.simhash_groups(df, **kw).collect()), key=str)


def test_spark_hash_is_xxh64(spark):
    assert spark.sql("select xxhash64('a b c')").first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("cap", [128, 1])
def test_matches_brute_force(spark, cap):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Ünder", "BIG"]
    rows = []
    for i in range(120):
        base = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 5, 40, 200]))]
        rows.append((i, " ".join(base)))
        if i % 3 == 0:
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((500 + i, "\n".join(copy)))
    rows += [(700, None), (None, "w1 w2 w3"), (701, ""), (702, " \t\n"), (3, rows[3][1]), (None, None), (800, "one " * 30000)]
    assert run(spark, rows, bucket_cap=cap) == slow_components(rows)


def test_half_distance_links_are_exact(spark):
    ready(spark)
    rng = random.Random(9)
    for tau in (1, 2, 3):
        xs = [rng.getrandbits(64) for _ in range(12)]
        for _ in range(60):
            x = rng.choice(xs)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            xs.append(x)
        xs = sorted({x - (1 << 64) if x >> 63 else x for x in xs})
        df = spark.createDataFrame([(x,) for x in xs], "fp long")
        near = {(a, b) for a in xs for b in xs if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= tau}
        for links in (simhash.half_distance_links(df, tau), simhash.pigeonhole_links(df, tau)):
            assert roots(xs, [tuple(r) for r in links.collect()]) == roots(xs, near)


def test_components_of_a_chain_and_a_star(spark):
    ready(spark)
    edges = [(i, i + 1) for i in range(40)] + [(1000 + i, 999) for i in range(50)] + [(7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{1000 + i: 999 for i in range(50)}}


def test_thresholds_sum_and_are_cheapest():
    rng = np.random.default_rng(1)
    cost = rng.random((50, 3, 4)) * 100
    cost[:, :, 0] = 0
    got = simhash.allocate(cost, 2)
    assert (got.sum(axis=1) == 0).all()
    import itertools

    for x in range(50):
        best = min(sum(cost[x, i, t + 1] for i, t in enumerate(ts)) for ts in itertools.product(range(-1, 3), repeat=3) if sum(ts) == 0)
        assert abs(sum(cost[x, i, t + 1] for i, t in enumerate(got[x])) - best) < 1e-9


def test_empty_table(spark):
    assert run(spark, []) == []


def test_dedup_keeps_one_of_each_group(spark):
    rows = [(4, "a b c d e f"), (2, "A B C D E F"), (2, "a b c d e f"), (9, "quite another text here today"), (None, "a b c d e f")]
    df = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, fp double")
    out = simhash.simhash_dedup(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == [2, 9, None]


def test_dedup_keeps_texts_apart_that_share_an_id(spark):
    rng = random.Random(3)
    x, y, z = (" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(3))
    rows = [(7, x), (7, y), (7, y), (3, y), (9, z), (9, z)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for kw in ({}, {"keep_null_ids": False}):
        assert sorted(tuple(r) for r in simhash.simhash_dedup(df, **kw).collect()) == sorted([(7, x), (3, y), (9, z)])


def test_near_copies_stage_leaves_one_of_each_group(spark):
    import corpus_pipeline as P

    rng = random.Random(4)
    x, y, z = (" ".join(f"w{rng.randrange(500)}" for _ in range(60)) for _ in range(3))
    rows = [(None, x)] * 40 + [(None, x.upper())] * 3 + [(5, y), (None, y), (None, y.upper()), (8, z)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = P.near_copies(spark, df, "").collect()
    assert sorted((str(r.doc_id), r.text.lower()) for r in got) == sorted([("None", x), ("5", y), ("8", z)])
    assert sum(r.doc_id is None for r in simhash.simhash_dedup(df).collect()) == 45
