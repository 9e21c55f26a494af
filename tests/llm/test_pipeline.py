"""Each stage of the pipeline against brute force on its own input (sf0.001)."""

import re

import corpus_pipeline as P
from test_mixing import slow as slow_mix
from test_packing import check
from test_simhash import slow_components
from test_substring import slow as slow_passages


def test_stages(spark, sf_small):
    P.ready(spark)
    docs = P.load(spark, sf_small, "documents").select(*P.COLUMNS)
    extra = [(90001, None, "en", "src1", 0), (90002, "12 34 %%", None, "src1", 8), (90003, "", None, None, 0), (90004, "The of and that, thonst.", None, None, 24)]
    docs = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["language", "near_copies", "passages", "mixture", "pack"]

    def go(name, df):
        out = stages[name](spark, df, sf_small)
        assert name == "pack" or out.columns == P.COLUMNS
        return out.cache(), sorted((tuple(r) for r in out.collect()), key=str)

    rows = [tuple(r) for r in docs.collect()]
    d1, r1 = go("language", docs)
    assert [r[:2] for r in r1] == sorted([r[:2] for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])], key=str)
    assert all(r[2] for r in r1) and {r[0]: r[2] for r in r1 if r[0] < 90000} == {r[0]: r[2] for r in rows if r[0] < 90000}
    d2, r2 = go("near_copies", d1)
    first = {c for _, _, c in slow_components([r[:2] for r in r1])}
    assert r2 == sorted((r for r in r1 if r[0] in first), key=str)
    d3, r3 = go("passages", d2)
    want = {i: (n, gone) for i, n, gone, _ in slow_passages([r[:2] for r in r2], 13)}
    assert {r[0]: len(r[1].split()) for r in r3} == {i: n - gone for i, (n, gone) in want.items() if n > gone}
    assert all(r[4] == len(r[1]) for r in r3) and {(r[0], r[2], r[3]) for r in r3} <= {(r[0], r[2], r[3]) for r in r2}
    d4, r4 = go("mixture", d3)
    path = lambda r: (f"d{int(re.search(r'[0-9]+', r[3] or '0')[0]) % 4}", r[2], r[3])
    weights = [P.MIX_WEIGHTS["domain"], P.MIX_WEIGHTS["lang"], {}]
    chosen = {i for i, _, _ in slow_mix([(*r[:2], *path(r)) for r in r3], weights, P.MIX_SHARE, 1, P.MIX_SEED)}
    assert r4 == sorted((r for r in r3 if r[0] in chosen), key=str) and 0 < len(r4) < len(r3)
    pieces = P.packing.pack(d4, P.public_tokenizers.path("word_bpe_49k.json")).collect()
    check([(r[0], r[1], r[3]) for r in r4], pieces, 4096)
    _, r5 = go("pack", d4)
    assert len(r5) == len(pieces)


def test_run_gives_the_last_stage(spark, sf_small):
    out = P.run(spark, sf_small)
    assert out.columns == ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0
