import hashlib
import random

from pyspark.sql import functions as F

from farebox.llm import mixing


def slow_shares(budget, caps, weights):
    """Water filling, one saturated child at a time."""
    got, open_ = {}, {k for k in caps if weights[k] > 0 and caps[k] > 0}
    left = budget
    while open_:
        w = sum(weights[k] for k in open_)
        full = [k for k in sorted(open_, key=lambda k: (caps[k] / weights[k], k)) if caps[k] * w <= weights[k] * left]
        if not full:
            got.update({k: left * weights[k] // w for k in open_})
            break
        k = full[0]
        got[k] = caps[k]
        left -= caps[k]
        open_.remove(k)
    return got


def slow(rows, weights, share, epochs, seed):
    n = lambda t: len((t or "").encode().split())
    leaves = {}
    for i, t, *path in rows:
        leaves.setdefault(tuple(x or "" for x in path), []).append((i if i is not None else 2**63 - 1, n(t)))
    total = sum(x for m in leaves.values() for _, x in m)

    def go(prefix, budget, depth, out):
        if depth == 3:
            out[prefix] = budget
            return out
        kids = {}
        for leaf, m in leaves.items():
            if leaf[:depth] == prefix:
                kids[leaf[depth]] = kids.get(leaf[depth], 0) + epochs * sum(x for _, x in m)
        w = {k: weights[depth].get(k, 1) for k in kids}
        for k, b in slow_shares(budget, kids, w).items():
            go((*prefix, k), b, depth + 1, out)
        return out

    picked = []
    for leaf, budget in go((), int(total * share), 0, {}).items():
        members = leaves[leaf]
        tokens = sum(x for _, x in members)
        whole, rest = divmod(budget, tokens)
        picked += [(i, leaf, e) for e in range(whole) for i, _ in members]
        before = 0
        for i, x in sorted(members, key=lambda m: hashlib.md5(f"{seed}:{whole}:{m[0]}".encode()).hexdigest()):
            if before < rest:
                picked.append((i, leaf, whole))
            before += x
    return sorted(picked)


def run(spark, rows, weights, share, epochs, seed, **kw):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, a string, b string, c string, n_tokens string")
    out = mixing.mix(df, {x: F.col(x) for x in "abc"}, dict(zip("abc", weights)), share, epochs, seed, **kw)
    return sorted((r._id, (r.a, r.b, r.c), r.epoch) for r in out.collect())


def sample():
    rng = random.Random(6)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 30))), rng.choice("pppq"), rng.choice("xyyy"), rng.choice("123")) for i in range(300)]
    return rows + [(900, None, "p", "x", "1"), (None, "a b c", None, "x", None), (901, "", "q", None, "2"), (902, "w " * 3000, "q", "y", "3")]


def test_matches_brute_force(spark):
    rows = sample()
    for weights, share, epochs, seed, per in (
        ([{"p": 1, "q": 5}, {}, {"1": 3}], 0.5, 1, 17, 2000),
        ([{"p": 1, "q": 9}, {"x": 4}, {}], 0.9, 3, 5, 3),
        ([{"p": 0, "q": 1, "": 2}, {}, {}], 1.0, 2, 5, 10),
    ):
        assert run(spark, rows, weights, share, epochs, seed, rows_per_bucket=per) == slow(rows, weights, share, epochs, seed)


def test_rows_come_as_often_as_chosen(spark):
    rows = [(1, "a b", "p", "x", "1"), (1, "a b", "p", "x", "1"), (2, "c", "p", "x", "2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, a string, b string, c string")
    chosen = mixing.mix(df, {x: F.col(x) for x in "abc"}, {}, 2.0, 2)
    assert sorted(r.doc_id for r in mixing.mixed_rows(df, chosen).collect()) == [1, 1, 1, 1, 2, 2]


def test_many_rows_without_id(spark):
    rows = [(None if i % 3 else i, f"t{i} b c", "p", "x", "1") for i in range(200)]
    for share, per in ((0.1, 5), (0.5, 3), (0.5, 2000), (0.9, 7)):
        assert run(spark, rows, [{}, {}, {}], share, 1, 4, rows_per_bucket=per) == slow(rows, [{}, {}, {}], share, 1, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string, a string, b string, c string")
    chosen = mixing.mix(df, {x: F.col(x) for x in "abc"}, {}, 0.5, 1, 4, rows_per_bucket=3)
    got = [r.text for r in mixing.mixed_rows(df, chosen).collect()]
    assert len(got) == len(set(got)) == 100


def test_empty_tables(spark):
    assert run(spark, [], [{}, {}, {}], 0.5, 1, 1) == []
    assert run(spark, [(1, None, "p", "x", "1")], [{}, {}, {}], 0.5, 1, 1) == []


def test_groups_join_in_parts_as_by_broadcast(spark):
    from farebox.llm.common import is_small, join_groups

    rows = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"))
    groups = rows.where("g <> 'g5'").groupBy("g").agg(F.count("*").alias("n"))
    assert is_small(groups, ["g"]) and is_small(groups.limit(0), ["g"])
    for how in ("inner", "left"):
        a, b = (sorted(map(str, join_groups(rows, groups, ["g"], small, how).collect())) for small in (True, False))
        assert a == b and len(a) == (500 if how == "left" else rows.where("g <> 'g5'").count())


def test_weight_zero_below_a_node_loses_no_budget(spark):
    rows = [(i, "w " * 10, "a" if i < 50 else "b", "x" if i % 2 else "y") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, p string, q string")
    levels = {"p": F.col("p"), "q": F.col("q")}
    out = mixing.mix(df, levels, {"q": {"x": 0, "y": 1}}, budget_share=0.5)
    got = out.groupBy("q").agg(F.sum("n_tokens").alias("n")).collect()
    assert [(r.q, r.n) for r in got] == [("y", 500)]
    # One parent has open leaves only through its sibling: the shortage goes there.
    lone = df.where("not (p = 'a' and q = 'y')")
    assert mixing.mix(lone, levels, {"q": {"x": 0, "y": 1}}, budget_share=0.5).agg(F.sum("n_tokens")).first()[0] == 250


def test_repeated_rows_give_the_smallest(spark):
    df = spark.createDataFrame([(1, "a b", "z"), (1, "a b", "c"), (1, "a b", None)], "doc_id long, text string, source string")
    chosen = mixing.mix(df, {"source": F.lit("s")}, {}, budget_share=1.0)
    got = mixing.mixed_rows(df.repartition(3), chosen)
    assert [r.source for r in got.collect()] == [None] * 3
