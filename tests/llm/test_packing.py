import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farebox.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_alone_give_the_same_ids():
    tok = Tokenizer.from_file(PATH)
    cache = packing.WordIds(tok, "<u2")
    texts = ["", " \n", "It's we're THE the, The. ÀÉÎ straße Straße, x|y ||| 12,345 a.b. !?", "日本 語 x é É", "<|endoftext|> a<|startoftext|>b", "İstanbul ΣΑΣ \x0b\x0c\x1c y", "don't. I'm, '' 's 't"]
    for t in texts:
        assert np.frombuffer(cache.text(t.encode()), "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("weights", [None, [5, 1, 1, 3]])
def test_plan_covers_every_token_once(weights):
    rng = random.Random(2)
    for totals in ([0, 0, 0, 0], [1, 0, 2, 5], [900, 30, 2, 400], [5000, 1, 1, 1], [64, 64, 64, 64], [10, 3000, 10, 3000]):
        layout = packing.Layout(packing.plan_windows(totals, weights, 64))
        cells = set()
        for k, n in enumerate(totals):
            at = 0
            while at < n:
                end = min(n, at + rng.randint(1, 90))
                for lo, hi, w, o in layout.pieces(k, at, end):
                    assert lo == at and 0 <= o and o + hi - lo <= 64
                    cells.update((w, o + i) for i in range(hi - lo))
                    at = hi
                assert at == end
        total = sum(totals)
        assert cells == {(i // 64, i % 64) for i in range(total)}


def test_windows_hold_the_corpus_proportions():
    totals = [6400, 3200, 640]
    layout = packing.Layout(packing.plan_windows(totals, None, 64))
    per = {}
    for k, n in enumerate(totals):
        for lo, hi, w, _ in layout.pieces(k, 0, n):
            per.setdefault(w, [0, 0, 0])[k] += hi - lo
    assert all(abs(c[k] - 64 * totals[k] / sum(totals)) <= 2 for w, c in per.items() for k in range(3))


def spans(totals, weights, length, max_queues):
    """Tokens of every source by window, all cells taken once."""
    place, per, cells = packing.plan_sources(totals, weights, length, max_queues), {}, set()
    for s, n in totals.items():
        node, k = place[s]
        at = 0
        for begin in range(0, n, 37):
            for lo, hi, w, o in node.pieces(k, begin, min(n, begin + 37)):
                assert lo == at and 0 <= o and o + hi - lo <= length
                cells.update((w, o + i) for i in range(hi - lo))
                per.setdefault(w, {}).setdefault(s, 0)
                per[w][s] += hi - lo
                at = hi
        assert at == n
    assert cells == {(i // length, i % length) for i in range(sum(totals.values()))}
    return per


@pytest.mark.parametrize("sources,queues", [(12, 4), (40, 2), (300, 256), (600, 20)])
def test_sources_of_the_shared_queue_hold_their_share(sources, queues):
    names = [f"s{i:03d}" for i in range(sources)]
    length = 8 * sources
    for weights in (None, {s: 1 + i % 3 for i, s in enumerate(names)}):
        totals = {s: 300 + 150 * (i % 3) for i, s in enumerate(names)}
        per = spans(totals, weights, length, queues)
        share = weights or totals
        first = sum(totals.values()) // length // 3
        for s in names:
            got = sum(per[w].get(s, 0) for w in range(first))
            want = first * length * share[s] / sum(share.values())
            assert abs(got - want) <= 0.25 * want + 16, (s, got, want)


def test_more_weights_than_queues(spark):
    names = [f"s{i:02d}" for i in range(12)]
    rows = [(100 * i + j, "the " * 50, s) for i, s in enumerate(names) for j in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    weights = {s: 1 + 9 * (i == 11) for i, s in enumerate(names)}
    out = packing.pack(df, PATH, length=256, weights=weights, max_queues=4).collect()
    check(rows, out, 256)
    for i, s in enumerate(names):
        got = sum(r.length for r in out if r.source == s and r.sequence_id < 8)
        assert abs(got - 8 * 256 * weights[s] / 21) <= 40, (s, got)


def check(rows, out, length):
    tok = Tokenizer.from_file(PATH)
    want = sorted((i is None, i or 0, tok.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in rows)
    got, cells = {}, {}
    for r in out:
        assert zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 and r.length > 0
        got.setdefault((r.id, r.doc_tokens), []).append(r)
        cells.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in cells.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= length
    assert sum(n for p in cells.values() for _, n in p) == sum(len(w) for *_, w in want)
    assert sorted(cells) == list(range(len(cells)))
    if len({i for i, *_ in rows}) == len(rows):
        back = sorted((k[0] is None, k[0] or 0, np.concatenate([np.frombuffer(r.ids, "<u2") for r in sorted(p, key=lambda r: r.start)]).tolist()) for k, p in got.items())
        assert back == want
        for p in got.values():
            at = 0
            for r in sorted(p, key=lambda r: r.start):
                assert r.start == at
                at += r.length
            assert at == p[0].doc_tokens


@pytest.mark.parametrize("weights,queues", [(None, 256), ({"a": 3, "b": 1}, 256), (None, 2)])
def test_pieces_give_the_documents_back(spark, weights, queues):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["the", "of", "zwölf,", "Tokens", "x!"]) for _ in range(rng.randint(0, 90))), rng.choice("aaabbc")) for i in range(80)]
    rows += [(100, None, "a"), (101, "", None), (None, "null id", "b"), (102, "long " * 5000, "c")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, shard int").repartition(5)
    check(rows, packing.pack(df, PATH, length=64, weights=weights, max_queues=queues).collect(), 64)
    if weights is None and queues == 256:
        check(rows + rows, packing.pack(df.unionAll(df), PATH, length=64).collect(), 64)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.pack(df, PATH).collect() == []
