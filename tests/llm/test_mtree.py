from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicework.llm import mtree
from sluicework.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"


def brute(rows, k=5, every=50):
    """All pairs, in Python numbers."""
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i, tuple(math.floor(x * 256) for x in v)] = None
    out = []
    for q, v in good:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_query_equals_its_twin(spark):
    got = QUERIES["op4_top_k"](spark, FOLDER).toPandas()
    assert difference(got, connect(FOLDER).execute(ORACLES["op4_top_k"]).df()) == ""


def test_many_small_trees_with_ties(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 60)
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(mtree, "QUERIES_AT_ONCE", 7)
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.integers(-2, 3, 4)]) for i in range(600)]
    rows += [(i, [1.0, 0.5, -0.25, 2.0]) for i in range(600, 900)]
    got = mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0)
    assert result(got) == brute(rows)


def test_messy_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [0.1, -0.1]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, []), (7, [3.0, 1e-9]), (8, [-0.001, 0.0]), (100, None),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, tree int, v string")
    assert result(mtree.top_k(table, F.col("vec_id") % 50 == 0)) == brute(rows)
    assert mtree.top_k(table.filter("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert mtree.top_k(table.filter("vec_id = 7"), F.col("vec_id") % 50 == 0).count() == 0
    assert mtree.top_k(table.filter("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("scale", [1, 1e4, 1e6, 1e8])
def test_large_components_stay_exact(spark, scale):
    """Scores beyond a long are cut to its range."""
    random, most = np.random.default_rng(3), 2**63 - 1
    rows = [(i, [float(x) for x in random.normal(0, scale, 3)]) for i in range(120)]
    got = result(mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    if scale <= 1e6:
        assert got == brute(rows)
    else:
        assert sorted(s for *_, s in got) == sorted(max(-most, min(most, s)) for *_, s in brute(rows))


def test_bounds_save_computations():
    random = np.random.default_rng(4)
    centres = random.normal(0, 2000, (40, 16))
    v = np.floor(np.repeat(centres, 100, axis=0) + random.normal(0, 20, (4000, 16)))
    tree, seen = mtree.build(np.arange(4000), v), []
    original = mtree.products
    mtree.products = lambda vectors, *rest: seen.append(len(vectors)) or original(vectors, *rest)
    try:
        found = mtree.search(tree, -1, v[17], 5, -np.inf)
    finally:
        mtree.products = original
    scores = v @ v[17]
    assert [s for s, _ in found] == sorted(scores.astype(int).tolist(), reverse=True)[:5]
    assert sum(seen) < 2000
