import math
import random
from collections import Counter

import pytest

from farebox.llm import search

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, queries, k, max_terms=None, min_df=2):
    key = lambda i: 2**63 - 1 if i is None else i
    docs = [(key(i), Counter((t or "").translate(ASCII_LOWER).split())) for i, t in rows]
    n, mean = len(docs), sum(sum(c.values()) for _, c in docs) / max(1, len(docs))
    df = Counter(w for _, c in docs for w in c)
    idf = {w: math.log(1 + (n - f + 0.5) / (f + 0.5)) for w, f in df.items()}
    asked = {}
    for i, t in queries:
        asked.setdefault(key(i), Counter()).update((t or "").translate(ASCII_LOWER).split())
    out = []
    for q, c in asked.items():
        terms = sorted((w for w in c if df[w] >= min_df), key=lambda w: (-c[w] * idf[w], w))[:max_terms]
        hits = []
        for i, d in docs:
            s = sum(idf[w] * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * sum(d.values()) / mean)) for w in terms if w in d)
            if s > 0:
                hits.append((-round(s, 6), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def run(spark, rows, queries, **kw):
    schema = "doc_id long, text string, score int"
    df, q = (spark.createDataFrame([(*r, 1) for r in x], schema) for x in (rows, queries))
    key = lambda i: 2**63 - 1 if i is None else i
    return sorted((key(r.query_id), r.rank, key(r.id), round(r.score, 6)) for r in search.search(df, q, **kw).collect())


def sample():
    rng = random.Random(12)
    vocab = [f"t{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["The", "ÉTÉ", "été"]
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 80)))) for i in range(300)]


@pytest.mark.parametrize("kw", [{"k": 10}, {"k": 3, "max_terms": 5, "block_queries": 4}])
def test_matches_brute_force(spark, kw):
    rows = sample()
    rows += [(400, None), (401, ""), (None, rows[3][1]), (500, rows[0][1]), (500, rows[0][1])]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [rows[3], (None, rows[7][1]), (401, "")]
    assert run(spark, rows, queries, **kw) == slow(rows, queries, kw["k"], kw.get("max_terms"))


def test_blocks_are_skipped_without_changing_the_result(monkeypatch, spark):
    rows = sample()
    import numpy as np

    roller = search.Roller()
    data = " ".join(t for _, t in rows).encode()
    offsets = np.cumsum([0] + [len(t.encode()) + 1 for _, t in rows])
    offsets[-1] -= 1
    row, term, *_ = search.term_rows(np.frombuffer(data, np.uint8), offsets, roller)
    monkeypatch.setattr(search, "DOCS_PER_BLOCK", 2)
    monkeypatch.setattr(search, "FIRST_DOCS", 8)
    blob = search.build_shard(np.arange(len(rows)), np.bincount(row, minlength=len(rows)), row, term, 40.0, 1.2, 0.75)
    shard = search.Shard(blob, 40.0, 1.2, 0.75)
    impact = search._impact(shard.tf, shard.norm[shard.doc], 1.2)
    lists = shard.at[shard.block_at]  # the postings of every term
    read = 0
    rng = np.random.default_rng(3)
    for _ in range(50):
        found = rng.choice(len(shard.terms), 6, replace=False)
        w = rng.random(6) + 0.1
        top = []
        shard.search(found, w, top, 5)
        score = np.zeros(len(rows))
        for f, x in zip(found, w):
            s = slice(lists[f], lists[f + 1])
            read += lists[f + 1] - lists[f]
            score[shard.doc[s]] += x * impact[s]
        want = sorted(((round(s, 6), -i) for i, s in enumerate(score.tolist()) if s > 0), reverse=True)[:5]
        assert sorted(((round(s, 6), i) for s, i in top), reverse=True) == want
    assert shard.opened < read and shard.scored < 0.9 * shard.opened, (shard.opened / read, shard.scored / read)


@pytest.mark.parametrize("share", [0.1, 0.3, 1.0])
def test_pivot_share_does_not_change_the_result(monkeypatch, share):
    """Same hits and sums whatever lists are opened first, over several shards
    and with a bar from the shard before; work is below the plain sum's."""
    import numpy as np

    monkeypatch.setattr(search, "DOCS_PER_BLOCK", 4)
    monkeypatch.setattr(search, "FIRST_DOCS", 16)
    monkeypatch.setattr(search, "PIVOT_SHARE", share)
    rng = np.random.default_rng(5)
    shards, docs = [], []
    for at in (0, 200, 400):
        row = np.sort(rng.integers(0, 200, 6000))
        term = np.minimum(rng.zipf(1.4, 6000), 400).astype(np.uint64)
        blob = search.build_shard(np.arange(at, at + 200), np.bincount(row, minlength=200), row, term, 30.0, 1.2, 0.75)
        shards.append(search.Shard(blob, 30.0, 1.2, 0.75))
        docs.append((at, row, term))
    opened = 0
    for _ in range(40):
        terms = rng.choice(np.arange(1, 401), 30, replace=False).astype(np.uint64)
        w, top, score = 5.0 / np.log1p(401.0 - terms.astype(float)), [], Counter()
        for shard, (at, row, term) in zip(shards, docs):
            found = shard.find(terms)
            shard.search(found[found >= 0], w[found >= 0], top, 5)
            for t, x in zip(terms, w):
                tf = np.bincount(row[term == t], minlength=200)
                opened += np.count_nonzero(tf)
                for d in np.flatnonzero(tf):
                    score[at + int(d)] += x * tf[d] * 2.2 / (tf[d] + shard.norm[d])
        want = sorted(((round(s, 6), -i) for i, s in score.items()), reverse=True)[:5]
        assert sorted(((round(s, 6), i) for s, i in top), reverse=True) == want
    assert sum(s.scored for s in shards) < opened


@pytest.mark.parametrize("cells", [1 << 20, 900, 0])
def test_wide_lists_are_opened_once_for_many_queries(monkeypatch, cells):
    """Same hits with a matrix for all wide lists, for three of them and for none;
    with it the postings read do not grow with queries times list lengths."""
    import numpy as np

    monkeypatch.setattr(search, "DOCS_PER_BLOCK", 16)
    monkeypatch.setattr(search, "DENSE_CELLS", cells)
    monkeypatch.setattr(search, "GROUP", 7)
    rng = np.random.default_rng(8)
    shards, docs = [], []
    for at in (0, 300):
        row = np.sort(rng.integers(0, 300, 9000))
        term = np.minimum(rng.zipf(1.3, 9000), 2000).astype(np.uint64)
        row, term = np.append(row, [5, 9]), np.append(term, np.array([3000, 3000], np.uint64))
        order = np.argsort(row, kind="stable")
        row, term = row[order], term[order]
        blob = search.build_shard(np.arange(at, at + 300), np.bincount(row, minlength=300), row, term, 30.0, 1.2, 0.75)
        shards.append(search.Shard(blob, 30.0, 1.2, 0.75))
        docs.append((at, row, term))
    asked = [np.unique(t[r == d]) for d in range(0, 300, 4) for _, r, t in docs[:1]]
    asked += [np.array([1, 2], np.uint64), np.array([3000], np.uint64), np.array([9999], np.uint64)]
    weights = [8.0 / np.log1p(t.astype(float)) for t in asked]
    tops = [[] for _ in asked]
    at = np.cumsum([0] + [len(t) for t in asked])
    for shard in shards:
        shard.search_all(np.concatenate(asked), np.concatenate(weights), at, tops, 5)
    read = 0
    for terms, w, top in zip(asked, weights, tops):
        score = Counter()
        for shard, (first, row, term) in zip(shards, docs):
            for t, x in zip(terms, w):
                tf = np.bincount(row[term == t], minlength=300)
                read += np.count_nonzero(tf)
                for d in np.flatnonzero(tf):
                    score[first + int(d)] += x * tf[d] * 2.2 / (tf[d] + shard.norm[d])
        want = sorted(((round(s, 6), -i) for i, s in score.items()), reverse=True)[:5]
        assert sorted(((round(s, 6), i) for s, i in top), reverse=True) == want
    opened = sum(s.opened for s in shards)
    assert opened < read / 10 if cells == 1 << 20 else opened > read / 10, opened / read


def test_very_long_text(spark):
    rows = [(1, "a b " * 60000 + "end"), (2, "end b"), (3, "b")]
    assert run(spark, rows, rows) == slow(rows, rows, 10)


@pytest.mark.parametrize("block_terms", [1 << 20, 50])
def test_all_terms_of_the_query_text(spark, block_terms):
    rows = sample() + [(None, sample()[5][1])]
    queries = [r for r in rows if r[0] is None or r[0] % 15 == 0]
    got = run(spark, rows, queries, k=10, block_terms=block_terms)
    assert got == slow(rows, queries, 10)
    assert got != slow(rows, queries, 10, 5)


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "a b")], []) == []
    assert run(spark, [], [(1, "a b")]) == []


def two_tongues(n, seed=4):
    """Texts of two vocabularies that share one word."""
    rng = random.Random(seed)
    vocab = [[f"{c}{int(rng.paretovariate(0.7))}" for _ in range(300)] for c in "ab"]
    return [(i, " ".join(["und", *(rng.choice(vocab[i % 2]) for _ in range(rng.randint(20, 60)))])) for i in range(n)]


def built(rows, labels=None):
    """Shards of the rows, one for each label."""
    import numpy as np

    roller, data = search.Roller(), " ".join(t for _, t in rows).encode()
    offsets = np.cumsum([0] + [len(t.encode()) + 1 for _, t in rows])
    offsets[-1] -= 1
    row, term, *_ = search.term_rows(np.frombuffer(data, np.uint8), offsets, roller)
    labels, ids = np.zeros(len(rows), int) if labels is None else labels, np.array([i for i, _ in rows])
    lengths, out = np.bincount(row, minlength=len(rows)), []
    for x in np.unique(labels):
        own = labels == x
        pick, place = np.flatnonzero(own[row]), np.cumsum(own) - 1
        out.append(search.build_shard(ids[own], lengths[own], place[row[pick]], term[pick], float(lengths.mean()), 1.2, 0.75))
    return row, term, [search.Shard(x, float(lengths.mean()), 1.2, 0.75) for x in out]


@pytest.mark.parametrize("cells", [1 << 20, 0])
def test_bars_of_the_whole_table_spare_work_and_keep_hits(monkeypatch, cells):
    """With the k-th best scores known, ties at the bar by smaller id included, a
    shard opens and scores less, and nothing where all lists together miss the bar."""
    import numpy as np

    monkeypatch.setattr(search, "DENSE_CELLS", cells)
    rows = two_tongues(400)
    rows += [(i + 1000, t) for i, t in rows[:40]] + [(i + 2000, t) for i, t in rows[:40]]
    labels = np.array([i % 2 for i, _ in rows])
    row, term, shards = built(rows, labels)
    terms = [np.unique(term[row == d]) for d in range(0, 400, 8)]  # of the first vocabulary
    at = np.cumsum([0] + [len(t) for t in terms])
    df = dict(zip(*np.unique(np.concatenate([np.unique(term[row == d]) for d in range(len(rows))]), return_counts=True)))
    weights = np.array([math.log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) for t in np.concatenate(terms)])

    def run(bars):
        tops = [[] for _ in terms]
        asked, before = search.Asked(np.concatenate(terms), weights, at), [(s.opened, s.scored) for s in shards]
        for s in shards[::-1]:
            s.search_asked(asked, tops, 5, bars)
        return [sorted(t, reverse=True) for t in tops], [(s.opened - o, s.scored - c) for s, (o, c) in zip(shards, before)]

    free, work = run(None)
    assert all(len(t) == 5 for t in free) and any(t[0][0] == t[1][0] for t in free)
    held, less = run(np.array([t[-1][0] for t in free]))
    assert held == free
    assert less[1] == (0, 0) < work[1] and less[0] <= work[0], (work, less)


def test_like_texts_share_a_label_and_labels_change_no_hit(monkeypatch):
    import numpy as np

    rows = two_tongues(600)
    row, term, (whole,) = built(rows)
    label = search.alike(row, term, len(rows))
    assert len(np.unique(label)) == 2 and len(np.unique(label[::2])) == len(np.unique(label[1::2])) == 1
    assert not search.alike(row[row < 300], term[row < 300], 300).any()  # too few to part
    assert not search.alike(np.zeros(0, int), np.zeros(0, np.uint64), 0).size
    parts = built(rows, label)[2]
    asked = search.Asked(term, np.ones(len(term)), np.searchsorted(row, np.arange(len(rows) + 1)))
    assert len(np.unique(asked.which[asked.at[7] : asked.at[8]])) == asked.at[8] - asked.at[7]  # a query has a term once
    found = []
    for shards in ([whole], parts, parts[::-1]):
        tops = [[] for _ in rows]
        for s in shards:
            s.search_asked(asked, tops, 10)
        found.append([sorted(t) for t in tops])
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("parts", [40, 260])
def test_turns_over_many_parts(spark, parts):
    """Runs of all turns, with copies whose scores tie across them."""
    rows = two_tongues(520)
    rows += [(i + 5000, rows[i % 3][1]) for i in range(60)] + [(None, rows[1][1]), (7, rows[8][1]), (9000, None)]
    schema = "doc_id long, text string"
    df = spark.createDataFrame(rows, schema).repartition(parts)
    queries = [r for r in rows if r[0] is None or r[0] % 50 < 2]
    key = lambda i: 2**63 - 1 if i is None else i
    got = sorted((key(r.query_id), r.rank, key(r.id), round(r.score, 6)) for r in search.search(df, spark.createDataFrame(queries, schema)).collect())
    assert got == slow(rows, queries, 10)


def test_index_has_like_texts_in_shards_of_a_turn(spark):
    from farebox.llm.common import keyed_texts

    rows = two_tongues(600)
    texts = keyed_texts(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text")
    got = search.shards(texts, 40.0, 1.2, 0.75).collect()
    shards = [search.Shard(bytes(r.blob), 40.0, 1.2, 0.75) for r in got]
    assert len(shards) == 2 and {r.turn for r in got} == {0}
    assert sorted({int(i) % 2 for i in s.ids} for s in shards) == [{0}, {1}]
    assert sorted(int(i) for s in shards for i in s.ids) == list(range(600))
