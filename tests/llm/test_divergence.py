"""Divergence audit: pointer sort against sorted(), results against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from farebox.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow(rows, min_docs, top):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall((text or "").translate(LOWER))
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * v) for t in kept}

        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, k + 1) for k, (i, x) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def run(spark, rows, min_docs=3, top=4, **kw):
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "text string, lang string, source string, n int, term string")
    return sorted(tuple(r) for r in divergence.audit(df, min_docs=min_docs, top=top, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def sample(seed):
    rng = random.Random(seed)
    vocab = [rng.choice(["a", "Ab", "éa", "日本", "ß"]) * rng.randint(1, 9) + rng.choice("xyzXYZ") for _ in range(60)]
    rows = [(rng.choice([" ", "1", "_", "\n", "\u0000"]).join(rng.choices(vocab, range(1, 61), k=rng.randint(0, 40))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", "", None, "s3"])) for _ in range(150)]
    return rows + rows[:5] + [(None, "en", "only null"), ("", "fr", "lone"), ("solo word", "xx", "one"), ("solo", "xx", "two"), ("abcdefgh " * 3000 + "abcdefghi abcdefghabcdefgh", "en", "s1")]


@pytest.mark.parametrize("kw", [{}, {"shard_bytes": 500}, {"small": False}])
def test_matches_plain_python(spark, kw):
    rows = sample(5)
    assert run(spark, rows, **kw) == slow(rows, 3, 4)


def test_empty_table(spark):
    assert run(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé日z-", max_size=60), max_size=12))
def test_pointer_sort_numbers_terms_in_byte_order(texts):
    raw = [t.translate(LOWER).encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0, *map(len, raw)])
    start, end, row = divergence.terms(data, offsets)
    words = [m.encode() for t in texts for m in TERM.findall(t.translate(LOWER))]
    assert [bytes(data[a:b]) for a, b in zip(start, end)] == words
    assert [i for i, t in enumerate(texts) for _ in TERM.findall(t)] == row.tolist()
    number, one = divergence.sort_pointers(data, start, end) if len(start) else (np.zeros(0, int), np.zeros(0, int))
    rank = {w: i for i, w in enumerate(sorted(set(words)))}
    assert number.tolist() == [rank[w] for w in words]
    assert [words[k] for k in one] == sorted(rank)
