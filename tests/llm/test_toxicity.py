from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicework.llm import toxicity as T
from sluicework.llm.queries import QUERIES
from tests.llm.messy import ROWS, empty, messy

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    good = [f"a calm and pleasant text about things number {i} and more of it" for i in range(60)]
    bad = [f"a calm text about you stupid idiots number {i} and more" for i in range(60)]
    return T.train(good + bad, [0] * 60 + [1] * 60, T.Settings())


def test_filters_run_over_the_whole_text(model):
    """One word at the end of a very long text decides; cutting the text into runs changes nothing."""
    plain = "a calm and pleasant text about things " * 30_000
    scores = T.score_texts([plain, plain + " stupid idiots", "", "stupid idiots"], model)
    assert scores[1] > 0.5 > scores[0] and scores[3] > 0.5 and 0 <= scores[2] <= 1


def test_scores_equal_a_plain_network(model, monkeypatch):
    texts = ["stupid things", "", "one", "you stupid idiots and more of it " * 9, "x y z"]
    expected = []
    rows = T.Rows()
    for text in texts:
        found = [rows[w] for w in text.encode().split()] or [0]
        x = model.embeddings[rows.table[[*found, 0, 0]]].sum(axis=1)
        pooled = []
        for filters, bias in zip(model.filters, model.biases, strict=True):
            values = [sum(x[p + k] @ filters[k] for k in range(len(filters))) + bias for p in range(len(found))]
            pooled.append(np.maximum(np.max(values, axis=0), 0))
        expected.append(1 / (1 + np.exp(-(np.concatenate(pooled) @ model.out + model.out_bias))))
    assert np.allclose(T.score_texts(texts, model), expected, atol=1e-5)
    monkeypatch.setattr(T, "WORDS_AT_ONCE", 3)
    assert np.allclose(T.score_texts(texts, model), expected, atol=1e-5)


def test_gradients_lower_the_loss():
    random = np.random.default_rng(0)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(random.choice(words, 20)) + (" bad phrase" if i % 2 else " phrase bad") for i in range(200)]
    labels = [i % 2 for i in range(200)]
    found = T.score_texts(texts, T.train(texts, labels, T.Settings(epochs=8)))
    assert np.mean((found >= 0.5) == np.array(labels)) > 0.95  # the order of two words, which single words cannot tell


def test_best_cut():
    scores, labels = np.array([0.9, 0.8, 0.7, 0.2, 0.1]), np.array([1, 1, 0, 0, 0])
    assert 0.7 < T.best_cut(scores, labels, np.ones(5)) < 0.8


def test_query_learns_from_the_other_folds(spark):
    rows = QUERIES["op10_toxicity"](spark, FOLDER).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.85


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", F.when(T.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (T.fit(docs, x) for x in (labels, turned))
    assert np.array_equal(one.embeddings, other.embeddings) and one.out_bias == other.out_bias


def test_messy_rows(spark):
    labels = spark.createDataFrame([(i, 5, i % 2, "x") for i in range(12)] + [(1, 0, 0, "y"), (None, 0, 1, ""), (2, 0, None, ""), (3, 0, 7, "")], "doc_id long, quality int, toxic int, text string")
    got = T.toxicity(messy(spark), labels).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, *_ in ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    none = T.toxicity(messy(spark), labels.filter("false")).collect()
    assert {(r.score, r.rejected) for r in none} == {(0.0, False)}
    assert T.toxicity(empty(spark), labels).count() == 0


def test_calibration_takes_all_labelled_rows_and_long_texts(spark):
    """More rows than the training sample may hold, and a language whose texts are all longer than it allows."""
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 == 1 or i % 8 < 2]
    rows = [(i, ("stupid idiots " if i % 2 else "calm things ") * (1 if i % 3 else 60) + f"number {i % 7}", "en" if i % 3 else "xx") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    settings = T.Settings(rows_a_class=30, longest=200)
    model = T.fit(docs, labels, settings)
    assert set(model.thresholds) == {"en", "xx"}
    # The cuts are the best ones over every row of the fold.
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 1]
    scores, y = T.score_texts([t for _, t, _ in held], model), np.array([i % 2 for i, *_ in held])
    for lang in ("en", "xx"):
        own = np.array([x == lang for *_, x in held])
        best = T.best_cut(scores[own], y[own], np.ones(own.sum()))
        assert np.array_equal(scores[own] >= model.thresholds[lang], scores[own] >= best)
    best = T.best_cut(scores, y, np.ones(len(y)))
    assert np.array_equal(scores >= 0.5, scores >= best)
