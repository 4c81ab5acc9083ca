"""Categories of many levels against plain computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablescope.operators import models as L, stats as M, wide as W


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(4)
    n = 600
    g = np.r_[np.zeros(200, int), rng.integers(1, 40, n - 200)]  # a third of the rows have one level
    d = pd.DataFrame({"a": rng.normal(5, 2, n), "b": rng.normal(0, 1, n), "g": [f"k{v:03d}" for v in g], "h": rng.choice(["u", "v", "w"], n)})
    d["y"] = 3 + 2 * d.a - d.b + np.sin(g) * 4 + (d.h == "v") * 1.5 + rng.normal(0, 1, n)
    return d


def same(spark, one, two):
    key = lambda c: {r.feature: r for r in c.collect()}
    a, b = key(one), key(two)
    assert set(a) == set(b)
    for f in a:
        for c in ("coef", "std_err", "t_stat", "p_value", "ci_lower", "ci_upper"):
            assert a[f][c] == pytest.approx(b[f][c], rel=1e-6, abs=1e-8), (f, c)


@pytest.mark.parametrize("features", [["a", "b", "g"], ["g", "a", "h"], ["g"]])
@pytest.mark.parametrize("log", [False, True])
def test_absorbed_is_the_plain_fit(spark, pdf, features, log):
    d = pdf.assign(y=pdf.y.abs())
    df = spark.createDataFrame(d).withColumn("a", F.when(F.col("b") < 2.2, F.col("a"))).repartition(4)
    (c1, f1), (c2, f2) = M.fit_ols(df, "y", features, log), W.fit_absorbed(df, "y", features, "g", log)
    same(spark, c1, c2)
    assert f1.columns == f2.columns
    x, y = f1.first(), f2.first()
    assert list(x[3:]) == pytest.approx(list(y[3:]), rel=1e-8) and list(x[:3]) == list(y[:3])


def test_absorbed_dependent_and_empty(spark, pdf):
    df = spark.createDataFrame(pdf).withColumn("a2", F.col("a") * 2)
    coefs = {r.feature: r for r in W.fit_absorbed(df, "y", ["a", "a2", "g"], "g")[0].collect()}
    assert coefs["a"].std_err is None and coefs["a"].coef + 2 * coefs["a2"].coef == pytest.approx(2, abs=0.1)
    c, f = W.fit_absorbed(df.limit(0), "y", ["a", "g"], "g")
    assert c.collect() == [] and f.collect() == []


def test_fifty_thousand_levels(spark, large_mode):
    d = spark.range(120_000).select((F.col("id") % 50_000).cast("string").alias("g"), (F.col("id") % 7).cast("double").alias("a"))
    d = d.withColumn("y", 2 * F.col("a") + F.col("g").cast("double"))
    coefs, fit = M.fit_ols(d, "y", ["a", "g"])
    got = coefs.filter(F.col("feature").isin("a", "const", "g_49999")).collect()
    assert {r.feature: round(r.coef, 6) for r in got} == {"a": 2.0, "const": 0.0, "g_49999": 49999.0}
    assert coefs.count() == 50_001 and fit.first().n_obs == 120_000
    v = W.one_hot_vector(d, "g", out="v").where("g = '1'").first()["v"]
    assert v.size == 49_999 and list(v.indices) == [0]
    c = L.confusion_matrix(d.withColumn("p", F.col("g")), "g", "p", zeros=False)
    assert c.count() == 50_000


@pytest.mark.parametrize("drop", [True, False])
def test_one_hot_vector(spark, drop):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "c"), (5, "b")], "id int, c string")
    got = {r.id: list(r.c_vector.toArray()) for r in W.one_hot_vector(df, "c", drop).collect()}
    full = {1: [0, 1, 0], 2: [0, 0, 0], 3: [1, 0, 0], 4: [0, 0, 1], 5: [0, 1, 0]}
    assert got == {k: v[1:] if drop else v for k, v in full.items()}


def test_counts_without_zeros(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "a"), ("a", "x"), (None, "a"), ("b", None)], "t string, p string")
    full = {(r.actual, r.predicted): r.n for r in L.confusion_matrix(df, "t", "p").collect()}
    got = {(r.actual, r.predicted): r.n for r in L.confusion_matrix(df, "t", "p", zeros=False).collect()}
    assert got == {k: n for k, n in full.items() if n} == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 1}
