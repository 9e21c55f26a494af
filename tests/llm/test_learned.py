"""Held-out accuracy and edge cases of the learned operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import langid, neighbours
from farebox.llm.catalog import REGISTRY, table

SF = "/root/testdata/sf0.01"


def test_language_accuracy_on_held_out_rows(spark):
    docs = table(spark, SF, "documents")
    got = REGISTRY["op4_language"][0](spark, SF).join(docs, "doc_id")
    held, right, n = got.where("held_out").agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("score")).first()
    assert held > 150 and right / held > 0.95 and n == held
    bad = got.where("score < 0 or score > 1 or lang_pred is null").count()
    assert bad == 0 and got.count() == docs.count()


def test_fast_and_plain_forward_agree():
    rng = np.random.default_rng(1)
    model = langid.ByteCNN(3, length=40)
    x = rng.integers(0, 256, (20, 40)).astype(np.uint8)
    n = rng.integers(1, 41, 20)
    assert np.allclose(model.pooled(x, n), model.pooled_fast(x, n, model.tables()), atol=1e-4)


def test_long_text_is_read_to_its_end():
    model = langid.ByteCNN(2, length=32)
    seen = []
    model.pooled_fast = lambda x, n, t: (seen.append(sum(n)), np.zeros((len(x), 24), np.float32))[1]
    p = model.predict_rows(np.full(1000, 65, np.uint8), np.array([0, 0, 5, 1000]))
    assert sum(seen) >= 1000 and np.allclose(p.sum(axis=1), 1)


def test_language_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score int"
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de", 0) for i in range(60)]
    odd = [(100, None, "en", 0), (101, "", "de", 0), (102, "12 %%", None, 0), (None, "der hund", None, 0), (1, rows[1][1], "en", 0), (103, "und " * 50000, None, 0)]
    df = spark.createDataFrame(rows + odd, schema)
    out = langid.identify(df, df, carry=["lang"]).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r.id: r for r in out}
    assert all(by[i].lang_pred == "und" for i in (100, 101, 102))
    assert by[None].lang_pred == "de" and by[1].lang_pred == "en" and by[103].lang_pred == "de"
    assert langid.identify(df.limit(0), df).collect() == []
    assert {r.lang_pred for r in langid.identify(df, df.limit(0)).collect()} == {"und"}


def test_only_the_most_frequent_labels_are_learned(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100 + i, "some text", f"dirty{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, *_ = langid.training_windows(df, "doc_id", "text", "lang", 100, 3, 64, labels=2)
    assert names == ["de", "en"]


def test_a_repeated_label_id_is_one_neighbour(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "good words here")] + [(2, f"bad bad bad {i % 3}") for i in range(300)], "doc_id long, text string")
    by = {r.id: r.score for r in neighbours.quality(docs, labels, k=1).collect()}
    assert by[1] > 0.9 and by[2] < 0.1


def test_quality_accuracy_on_held_out_rows(spark):
    labels = table(spark, SF, "labels")
    got = REGISTRY["op6_quality"][0](spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    j = got.where("held_out").join(labels, "doc_id")
    n, right = j.agg(F.count("*"), F.sum((F.col("quality") == F.col("predicted")).cast("int"))).first()
    assert n > 40 and right / n > 0.9


def test_vote_is_the_exact_weighted_share():
    rng = np.random.default_rng(4)
    z, known = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(30, 8)), rng.normal(size=(50, 8))))
    y = rng.integers(0, 2, 50).astype(float)
    got = neighbours.vote(z, known, y, 7, 4.0, block=11)
    for a, s in zip(z, got):
        sims = known @ a
        near = np.argsort(-sims)[:7]
        w = np.maximum(sims[near], 0) ** 4
        assert abs(s - (w * y[near]).sum() / w.sum()) < 1e-9
    assert neighbours.vote(np.zeros((1, 8)), known, y, 7, 4.0)[0] == pytest.approx(y.mean())


def test_quality_edge_cases(spark):
    df = spark.createDataFrame([(1, "good text here", 5), (2, "bad! bad! bad!", 5), (3, None, 5), (None, "good", 5), (1, "good text here", 5), (4, "x" * 300000, 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (9, None)], "doc_id long, quality int")
    out = {r.id: r.score for r in neighbours.quality(df, labels).collect()}
    assert len(out) == 5 and out[1] > out[2] and 0 <= out[3] <= 1
    assert {r.score for r in neighbours.quality(df, labels.limit(0)).collect()} == {0.5}
    assert neighbours.quality(df.limit(0), labels).collect() == []
