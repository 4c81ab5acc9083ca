"""Robust local lines against a plain version."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablescope.operators import stats as M


def plain(x, y, points, frac, rounds):
    ps = np.arange(points + 1) / points
    lo = np.minimum(np.maximum(0.0, ps - frac / 2), 1 - frac)
    g = np.quantile(x, ps)
    h = np.maximum(g - np.quantile(x, lo), np.quantile(x, lo + frac) - g)
    v = np.ones(len(x))
    for r in range(rounds + 1):
        trend = []
        for c, reach in zip(g, h):
            u = np.abs(x - c) / reach
            w = np.where(u < 1, (1 - np.minimum(u, 1) ** 3) ** 3, 0) * v
            trend.append(np.linalg.lstsq(np.column_stack([np.ones(len(x)), x - c]) * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0][0])
        size = np.abs(y - np.interp(x, g, trend))
        v = np.clip(1 - (size / (6 * np.median(size))) ** 2, 0, None) ** 2
    return np.array(trend)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    x = rng.gamma(2, 3, 900)
    y = np.sin(x / 3) * 5 + rng.normal(0, 0.3, 900)
    y[::9] += 400  # outliers
    return pd.DataFrame({"x": x, "y": y})


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_equal_to_the_plain_rounds(spark, rows, rounds):
    got = M.robust_trend(spark.createDataFrame(rows).repartition(3), "x", "y", 12, 0.3, rounds).orderBy("grid").collect()
    assert [r.trend for r in got] == pytest.approx(list(plain(rows.x.to_numpy(), rows.y.to_numpy(), 12, 0.3, rounds)), abs=1e-6)


def test_equal_at_any_size(spark, rows, large_mode):
    got = M.robust_trend(spark.createDataFrame(rows), "x", "y", 12).orderBy("grid").collect()
    assert [r.trend for r in got] == pytest.approx(list(plain(rows.x.to_numpy(), rows.y.to_numpy(), 12, 0.3, 3)), abs=1e-6)
    # Against the smooth curve without outliers, window for window: what is left is their pull.
    clean = rows[rows.y < 200]
    want = plain(clean.x.to_numpy(), clean.y.to_numpy(), 12, 0.3, 0)
    assert np.abs(np.interp([r.x for r in got], np.quantile(clean.x, np.arange(13) / 12), want) - [r.trend for r in got])[2:-2].max() < 1
    once = M.local_trend(spark.createDataFrame(rows), "x", "y", 12).orderBy("grid").collect()
    assert min(abs(r.trend - 5 * np.sin(r.x / 3)) for r in once[2:-2]) > 10


def test_odd_rows(spark):
    none = spark.createDataFrame([], "x double, y double")
    assert M.robust_trend(none, "x", "y").collect() == []
    nulls = spark.createDataFrame([(1.0, None), (None, 2.0)], "x double, y double")
    assert M.robust_trend(nulls, "x", "y").collect() == []
    line = spark.range(200).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    assert all(r.trend == pytest.approx(2 * r.x, abs=1e-6) for r in M.robust_trend(line, "x", "y").collect())
    alike = spark.createDataFrame([(1.0, 5.0)] * 20, "x double, y double")
    assert all(r.trend is None or r.trend == 5.0 for r in M.robust_trend(alike, "x", "y").collect())
