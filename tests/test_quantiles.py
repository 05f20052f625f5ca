from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluicework.operators import quantiles as Q


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    hot = pd.DataFrame({"g": "hot", "v": rng.lognormal(11, 0.7, 6000).round(2)})
    signed = pd.DataFrame({"g": "signed", "v": rng.normal(0, 50, 999).round(3)})
    equal = pd.DataFrame({"g": "equal", "v": [7.0] * 40})
    tiny = pd.DataFrame({"g": ["one", "two", "two"], "v": [1.5, -2.0, 3.0]})
    gaps = pd.DataFrame({"g": ["gaps"] * 3 + [None] * 2, "v": [None, None, None, 1.0, 2.0]})
    return pd.concat([hot, signed, equal, tiny, gaps], ignore_index=True)


def test_grouped_quantiles_equal_linear_interpolation(spark, frame):
    fractions = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    rows = Q.grouped_quantiles(spark.createDataFrame(frame), ["g"], "v", fractions).toPandas().set_index("g")
    known = frame.dropna()
    assert sorted(rows.index) == sorted(known.g.unique())
    for g, part in known.groupby("g"):
        assert rows.loc[g, "n_values"] == len(part)
        for name, p in fractions.items():
            assert rows.loc[g, name] == pytest.approx(np.quantile(part.v, p), rel=1e-12), (g, name)


def test_approximate_quantiles_are_close(spark, frame):
    rows = Q.grouped_quantiles(spark.createDataFrame(frame), ["g"], "v", {"p50": 0.5}, approximate=True)
    hot = rows.filter("g = 'hot'").first()["p50"]
    assert hot == pytest.approx(frame[frame.g == "hot"].v.median(), rel=0.01)


def test_box_stats_and_outliers(spark, frame):
    df = spark.createDataFrame(frame)
    box = Q.box_stats(df, "g", "v").toPandas().set_index("g")
    for g, part in frame.dropna().groupby("g"):
        q1, q3 = np.quantile(part.v, [0.25, 0.75])
        inside = part.v[(part.v >= q1 - 1.5 * (q3 - q1)) & (part.v <= q3 + 1.5 * (q3 - q1))]
        assert box.loc[g, "whisker_low"] == inside.min() and box.loc[g, "whisker_high"] == inside.max()
        assert box.loc[g, "n_outliers"] == len(part) - len(inside)
    assert Q.outliers(df, "g", "v").count() == box.n_outliers.sum()


def test_histogram(spark, frame):
    rows = Q.histogram(spark.createDataFrame(frame), "v", 40).orderBy("bin").toPandas()
    counts, edges = np.histogram(frame.v.dropna(), bins=40)
    assert rows["count"].tolist() == counts.tolist()
    assert rows.bin_start.tolist() == pytest.approx(edges[:-1].tolist())


def test_histogram_of_one_value(spark):
    rows = Q.histogram(spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double"), "v", 4)
    assert rows.agg(F.sum("count")).first()[0] == 2 and rows.count() == 4
