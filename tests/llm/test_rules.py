import random
import re
from collections import Counter

import numpy as np

from farebox.llm import rules


def slow_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            cover |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


def slow_verdicts(rows, coverage=0.75, steps=3, floor=150.0**2, cutoff=100.0):
    """id, d2 by numpy, group by group."""
    out, groups = {}, {}
    for i, text, lang, source in rows:
        n, chars, sym, dup, rep = slow_counts(text)
        if n < 50 or 100 * rep > 50 * n:
            out[i] = None
            continue
        x = [np.log(max(chars, 1) / n), np.log(1 + 20 * sym / n), np.log(1 + 20 * dup / n), np.log(1 + 5 * rep / n)]
        groups.setdefault((lang, source), []).append((i, np.floor(1000 * np.array(x) + 0.5)))
    for members in groups.values():
        x = np.array([v for _, v in members])
        mean = np.median(x, axis=0)
        cov = np.diag((1.4826 * np.median(np.floor(np.abs(x - mean) + 0.5), axis=0)) ** 2 + floor)

        def dist():
            y = x - mean
            return (y * np.linalg.solve(cov, y.T).T).sum(axis=1)

        def bins(d):
            return np.floor(16 * np.log2(1 + d))

        for _ in range(steps):
            b = bins(dist())
            core = x[b <= np.ceil(np.percentile(b, 100 * coverage))]
            mean = core.mean(axis=0)
            cov = np.cov(core.T, bias=True) + floor * np.eye(4)
        d = dist()
        d /= max(1, (2 ** (np.median(bins(d)) / 16) - 1) / 3.357)
        out.update({i: v for (i, _), v in zip(members, d)})
    return out


def sample():
    rng = random.Random(8)
    rows = []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([3, 60, 200, 400]))]
        text = " ".join(w + ("\n" if rng.random() < 0.1 else "") for w in words)
        if i % 19 == 0:
            text = " ".join(w + "#%|" for w in words)
        if i % 23 == 0:
            text = "same line\n" * 40 + text
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b"])))
    rows += [(900, None, "en", "a"), (901, "", None, None), (902, "x " * 100, "en", "a"), (903, " ".join(map(str, range(99))), "zz", "only"), (904, "a b c a b c a b", "en", "a"), (905, "\n \n\x0b", "en", None)]
    return rows


def test_matches_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_words int")
    got = {r.id: r for r in rules.quality_rules(df).collect()}
    want = slow_verdicts(rows)
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(text), i
        assert r.base_failed == (want[i] is None)
        assert (r.d2 is None) == (want[i] is None)
        if want[i] is not None:
            assert abs(r.d2 - want[i]) <= 1e-6 * max(1, want[i]), i
            assert r.kept == (r.d2 <= 100)
        else:
            assert not r.kept
    assert not got[19].kept and got[903].kept


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(80)), "en", "a")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [(r.n_words, r.kept) for r in rules.quality_rules(df).collect()] == [(80, True)] * 3
    assert rules.quality_rules(df.limit(0)).collect() == []
