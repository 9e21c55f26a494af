"""Token alignment against a plain walk over the tokens of whole texts."""

import functools
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from farebox.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def spelled_a(model, i):
    return bytes(letters()[c] for c in model.id_to_token(i))


@functools.cache
def letters():
    table = {chr(b): b for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
    n = 0
    for b in range(256):
        if b not in table.values():
            table[chr(256 + n)] = b
            n += 1
    return table


def slow(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    docs, counts = [], Counter()
    for i, text in rows:
        ids, ends = [[], []], [[], []]
        if text:
            ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
            names = [[spelled_a(a, x) for x in ids[0]], [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x in ids[1] for p in [b.id_to_piece(x)]]]
            if any(b"".join(n) != (" " + text).encode() for n in names):
                ids = [[], []]
            for k in (0, 1):
                at = 0
                for x, n in zip(ids[k], names[k]):
                    at += len(n)
                    ends[k].append(at)
        links = [(x, y) for x, e in zip(ids[0], ends[0]) for y, f in zip(ids[1], ends[1]) if e == f] if len(ids[0]) < 500 else None
        if links is None:
            at = dict(zip(ends[1], ids[1]))
            links = [(x, at[e]) for x, e in zip(ids[0], ends[0]) if e in at]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, before = [], 0
        for e in both:
            groups.append("|".join(",".join(str(x) for x, f in zip(ids[k], ends[k]) if before < f <= e) for k in (0, 1)) if len(both) < 500 else None)
            before = e
        counts.update(links)
        docs.append((i, len(ids[0]), len(ids[1]), len(both), links, ";".join(groups) if None not in groups else None, bool(ids[0])))
    best = Counter()
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (i, na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if used and g is not None else g and None or ("" if not used else None))
        for i, na, nb, ng, links, g, used in docs
    ]


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n int, links string")
    docs, _ = alignment.align(df, A, B, **kw)
    return sorted((tuple(r) for r in docs.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def sample(seed):
    rng = random.Random(seed)
    words = ["the", "tokenizer", "Éauouon", "ciónrauedo", "日本語", "a", "x1", "don't", "été", "\U0001f600", "naïve", "12345", "é"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", " \n ", " ", " 　", ", ", ". ", "\r\n", "   ", "  ", " ́"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 40)))) for i in range(60)]
    odd = [None, "", " ", "  ", "\n", " a", "a ", "  a  b  ", "a▁ b", "<|endoftext|> x <s> </s>", "\u0000 \u0007", "x" * 300, "  q", "▁"]
    return rows + [(100 + k, t) for k, t in enumerate(odd)] + [(None, "null id"), (1, rows[1][1]), (1, "another text"), rows[2]]


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 200, "known_bytes": 2000, "pair_rows": 50}, {"broadcast_pairs": 0, "block_bytes": 500}])
def test_matches_plain_walk(spark, kw):
    rows = sample(3)
    assert run(spark, rows, **kw) == sorted(slow(rows), key=str)


def test_very_long_text(spark):
    rows = [(1, "été the 12345, " * 20000), (2, "the y")]
    got, want = run(spark, rows), sorted(slow(rows), key=str)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_cut_units_are_tokenised_like_whole_texts():
    a, b = alignment.ByteLevel(A), alignment.Pieces(B)
    assert a.safe and b.safe
    for _, text in sample(9):
        if text:
            import numpy as np

            data = np.frombuffer((" " + text).encode(), np.uint8)
            at, _ = alignment.cut_units(data, np.array([0, len(data)]))
            units = [bytes(data[x:y]).decode() for x, y in zip(at[:-1], at[1:])]
            for model in (a, b):
                assert [i for u in model.encode(units) for i in u] == [i for u in model.encode([" " + text]) for i in u]
