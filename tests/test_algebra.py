"""Closed forms and models against direct computations."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablescope.functions.special import beta_cdf, f_tail, t_quantile, t_two_sided
from tablescope.operators import cluster as K, models as L, selection as X, stats as M


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 400
    d = pd.DataFrame({"id": range(n), "a": rng.normal(5, 2, n), "b": rng.normal(0, 1, n), "g": rng.integers(0, 3, n)})
    d["c"] = d.a * 0.5 + d.b + rng.normal(0, 0.3, n)
    d["y"] = 1 + 2 * d.a - d.b + d.g * 0.4 * d.a + rng.normal(0, 1, n)
    return d


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf)


def lstsq_sse(x, y):
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    return float(((y - x @ b) ** 2).sum()), b


def test_special_functions():
    assert beta_cdf(0.5, 1, 1) == pytest.approx(0.5)
    assert beta_cdf(0.3, 2, 3) == pytest.approx(sum(math.comb(4, k) * 0.3**k * 0.7 ** (4 - k) for k in range(2, 5)), abs=1e-12)
    assert t_quantile(0.975, 10) == pytest.approx(2.2281388520, abs=1e-8)
    assert f_tail(4.964602744, 1, 10) == pytest.approx(0.05, abs=1e-7)
    assert t_two_sided(2.2281388520, 10) == pytest.approx(f_tail(2.2281388520**2, 1, 10), abs=1e-12)


def test_ols(df, pdf):
    coefs, fit = M.fit_ols(df, "y", ["a", "b"])
    x = np.column_stack([pdf.a, pdf.b, np.ones(len(pdf))])
    sse, b = lstsq_sse(x, pdf.y.to_numpy())
    got = {r["feature"]: r for r in coefs.collect()}
    assert [got[k]["coef"] for k in ("a", "b", "const")] == pytest.approx(list(b), rel=1e-8)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * sse / (len(pdf) - 3))
    assert [got[k]["std_err"] for k in ("a", "b", "const")] == pytest.approx(list(se), rel=1e-6)
    f = fit.first()
    assert f["aic"] == pytest.approx(len(pdf) * (math.log(2 * math.pi) + math.log(sse / len(pdf)) + 1) + 6, rel=1e-9)
    assert got["a"]["ci_lower"] < 2 + 1 < got["a"]["ci_upper"] + 1


def test_regime(df, pdf):
    r = M.regime_statistics(df, "y", ["a"], "g").first()
    d = [(pdf.g == k).to_numpy(float) for k in (1, 2)]
    one, a, y = np.ones(len(pdf)), pdf.a.to_numpy(), pdf.y.to_numpy()
    full, _ = lstsq_sse(np.column_stack([one, a, *d, *[q * a for q in d]]), y)
    slopes, _ = lstsq_sse(np.column_stack([one, a, *d]), y)
    levels, _ = lstsq_sse(np.column_stack([one, a, *[q * a for q in d]]), y)
    noise = full / (len(pdf) - 6)
    assert r["slope_f"] == pytest.approx((slopes - full) / 2 / noise, rel=1e-8)
    assert r["intercept_f"] == pytest.approx((levels - full) / 2 / noise, rel=1e-6)


def test_vif(df, pdf):
    got = {r["feature"]: r["vif"] for r in M.vif_scores(df, ["a", "b", "c"]).collect()}
    sse, _ = lstsq_sse(pdf[["b", "c"]].to_numpy(), pdf.a.to_numpy())
    assert got["a"] == pytest.approx((pdf.a**2).sum() / sse, rel=1e-8)
    twin = df.withColumn("d", F.col("a") * 2)
    assert {r["vif"] for r in M.vif_scores(twin, ["a", "d"]).collect()} == {None}


def test_ridge_redundancy(df, pdf):
    got = {r["column"]: r["predictability_r2"] for r in X.stage3(df, ["a", "b", "c"]).collect()}
    z = ((pdf[["a", "b", "c"]] - pdf[["a", "b", "c"]].mean()) / pdf[["a", "b", "c"]].std(ddof=0)).to_numpy()
    b = np.linalg.solve(z[:, 1:].T @ z[:, 1:] + np.eye(2), z[:, 1:].T @ z[:, 0])
    r2 = 1 - ((z[:, 0] - z[:, 1:] @ b) ** 2).sum() / (z[:, 0] ** 2).sum()
    assert got["a"] == pytest.approx(r2, abs=1e-4)


def test_average_linkage():
    d = np.array([[0, 0.1, 0.9, 0.2], [0.1, 0, 0.9, 0.05], [0.9, 0.9, 0, 0.9], [0.2, 0.05, 0.9, 0]])
    assert X.average_linkage(d, 0.16) == [1, 1, 2, 1]
    assert X.average_linkage(d, 0.14) == [1, 2, 3, 2]


def test_shapley_values(df):
    fit = L.fit_tree(df, "y", ["a", "b", "g"], "id", trees=3, depth=3)
    leaves, expected = L.tree_paths(fit.model)
    rows = fit.test.select("id", "x0", "x1", "x2", "prediction").toPandas()
    x = rows[["x0", "x1", "x2"]].to_numpy()
    got = L.shap_block(x, leaves)[:, :, 0]
    assert got.sum(axis=1) + expected[0] == pytest.approx(rows.prediction.to_numpy(), rel=1e-9)

    def value(row, known):
        total = 0.0
        for v, path in leaves:
            p = 1.0
            for f, z, tests in path:
                ok = all((row[f] <= ref) == left for ref, left in tests)
                p *= float(ok) if f in known else z
            total += v[0] * p
        return total

    for k in range(5):
        for f in range(3):
            rest = [j for j in range(3) if j != f]
            phi = sum(math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (value(x[k], {*s, f}) - value(x[k], set(s)))
                      for n in range(3) for s in itertools.combinations(rest, n))
            assert got[k, f] == pytest.approx(phi, abs=1e-9)


def test_constant_feature_has_no_importance(df):
    fit = L.fit_tree(df.withColumn("flat", F.lit(1.0)), "y", ["a", "flat"], "id", trees=3, depth=2)
    got = {r["feature"]: r for r in L.permutation_importance(fit, 2).collect()}
    assert got["flat"]["importance_mean"] == pytest.approx(0.0, abs=1e-9) and got["a"]["importance_mean"] > 0
    s = {r["feature"]: r["mean_abs_shap"] for r in L.shap_importance(fit).collect()}
    assert s["flat"] == 0.0 and s["a"] > 0


def test_multiclass_tree(df):
    fit = L.fit_tree(df.withColumn("k", F.col("g").cast("string")), "k", ["a", "y"], "id", trees=3, depth=3)
    assert fit.task == "classify" and fit.metric_name == "f1_weighted" and 0 < fit.metric_value <= 1
    assert L.shap_importance(fit).count() == 2
    c = L.confusion_matrix(fit.test, "label", "prediction")
    assert c.agg(F.sum("n")).first()[0] == fit.n_test


def test_mixture_criteria(spark, df, pdf):
    got = {r["n_clusters"]: r for r in K.cluster_count_scan(df, ["a", "b"], 2).collect()}
    z = pdf[["a", "b"]].to_numpy()
    cov = np.cov(z.T, bias=True) + 1e-6 * np.eye(2)
    ll = -0.5 * len(z) * (2 * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + 2)
    assert got[1]["bic"] == pytest.approx(5 * math.log(len(z)) - 2 * ll, rel=1e-6)
    assert got[2]["bic"] is not None


def test_prototypes_are_a_partition(spark):
    d = spark.range(300).select("id", (F.col("id") % 2 * 10.0 + F.rand(5)).alias("x"), F.when(F.col("id") % 2 == 0, "p").otherwise("q").alias("c"))
    labels = K.kprototypes_labels(d, "id", ["x"], ["c"], 2)
    got = labels.join(d, "id").groupBy("cluster", "c").count().collect()
    assert labels.count() == 300 and len(got) == 2


def test_density_clusters_ignore_row_order(spark):
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal((0, 0), 0.2, (300, 2)), rng.normal((5, 5), 0.2, (200, 2)), rng.uniform(-3, 8, (15, 2))])
    d = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, x double, y double")
    one, info = K.density_clusters(d, "id", ["x", "y"], 50)
    two, _ = K.density_clusters(d.orderBy(F.desc("id")).repartition(5), "id", ["x", "y"], 50)
    assert info["n_clusters"] == 2 and one.exceptAll(two).count() == 0
    sizes = {r["cluster"]: r["count"] for r in one.groupBy("cluster").count().collect()}
    assert sizes[0] >= 290 and 185 <= sizes[1] <= 210


def test_power_transform_makes_normal(spark):
    d = spark.range(2000).select("id", F.exp(F.randn(7)).alias("x"))
    lam = K.power_lambdas(d, ["x"])["x"]
    assert -1.2 < lam < 0.2
    got = K.power_transform(d, ["x"]).agg(F.avg("x"), F.stddev_pop("x"), F.skewness("x")).first()
    assert got[0] == pytest.approx(0, abs=1e-9) and got[1] == pytest.approx(1) and abs(got[2]) < 0.2


def test_lags_cross_blocks(spark):
    d = spark.range(1, 101).select("id", (F.col("id") * 1.0).alias("v"))
    a = L.lag_features(d, ["id"], "v", 3, block=10)
    b = L.lag_features(d, ["id"], "v", 3)
    assert a.count() == 100 and a.exceptAll(b).count() == 0
