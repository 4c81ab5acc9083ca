"""Mixtures of several sizes against plain computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablescope.operators import cluster as K, mixture as G


def table(spark, x, parts=3):
    d = pd.DataFrame(x, columns=[f"x{i}" for i in range(x.shape[1])])
    d.insert(0, "id", range(len(d)))
    return spark.createDataFrame(d).repartition(parts, "id")


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(5)
    return np.concatenate([rng.normal(m, s, (n, 3)) for m, s, n in ((0, 1, 500), (8, 0.5, 300), (-9, 2, 200))])


def normal_loglik(x, mean, cov):
    d = x - mean
    return float((-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(2 * np.pi * cov)[1])).sum())


def test_one_component_is_the_closed_form(spark, groups):
    p = G.points(table(spark, groups + 1e5), ["x0", "x1", "x2"])
    m = G.fit(p, [1])[1]
    x = groups + 1e5
    cov = np.cov(x.T, bias=True)
    assert m.means[0] + m.centre == pytest.approx(x.mean(axis=0), rel=1e-12)
    assert m.covs[0] == pytest.approx(cov, rel=1e-8)
    assert m.loglik == pytest.approx(normal_loglik(x, x.mean(axis=0), cov), rel=1e-9)
    bic, aic = m.criteria(p.n)
    assert (bic, aic) == pytest.approx((9 * np.log(1000) - 2 * m.loglik, 18 - 2 * m.loglik))


@pytest.mark.parametrize("form", G.FORMS)
def test_likelihood_never_falls(spark, groups, form):
    flat = np.column_stack([groups, groups[:, 0] * 2, np.ones(len(groups))])  # a dependent and a constant column
    p = G.points(table(spark, flat), [f"x{i}" for i in range(5)])
    for k, m in G.fit(p, range(1, 6), form, tol=1e-7).items():
        assert m.k == k and len(m.history) >= 1
        steps = np.diff(m.history)
        assert (steps >= -1e-7 * abs(m.loglik)).all(), (k, steps.min())


def test_a_round_is_the_plain_round(spark, groups):
    """Means, covariances and log-likelihood of one step, row by row."""
    p = G.points(table(spark, groups), ["x0", "x1", "x2"])
    for form in G.FORMS:
        start = G.Mixture(np.array([0.3, 0.7]), np.array([[0.0, 1, 2], [3, 3, 3]]), np.stack([np.eye(3), 2 * np.eye(3)]), form, p.mean)
        if form == "diagonal":
            start.covs = np.stack([np.ones(3), 2 * np.ones(3)])
        if form == "shared":
            start.covs = np.stack([np.eye(3), np.eye(3)])
        start.prepare()
        s = p.over(start.sums)
        new = start.step(s, p.n)
        x = groups - p.mean
        full = [np.diag(c) if form == "diagonal" else c for c in start.covs]
        dens = np.array([[w * np.exp(-0.5 * (r - m) @ np.linalg.inv(c) @ (r - m)) / np.sqrt(np.linalg.det(2 * np.pi * c))
                          for w, m, c in zip(start.weights, start.means, full)] for r in x])
        assert s[0] == pytest.approx(np.log(dens.sum(axis=1)).sum(), rel=1e-9)
        r = dens / dens.sum(axis=1, keepdims=True)
        assert new.weights == pytest.approx(r.mean(axis=0), rel=1e-9)
        means = (r.T @ x) / r.sum(axis=0)[:, None]
        assert new.means == pytest.approx(means, rel=1e-7, abs=1e-9)
        own = [((x - m).T * r[:, j]) @ (x - m) for j, m in enumerate(means)]
        covs = [sum(own) / len(x)] * 2 if form == "shared" else [c / r[:, j].sum() for j, c in enumerate(own)]
        want = [np.diag(c) for c in covs] if form == "diagonal" else covs
        assert new.covs == pytest.approx(np.array(want), rel=1e-7, abs=1e-9)


def test_groups_are_found(spark, groups):
    df = table(spark, groups)
    cols = ["x0", "x1", "x2"]
    got = {r.id: r.cluster for r in K.gmm_labels(df, "id", cols, 3).collect()}
    labels = np.array([got[i] for i in range(len(groups))])
    truth = np.repeat([0, 1, 2], [500, 300, 200])
    assert (labels == truth).mean() > 0.99  # by falling weight
    scan = {r.n_clusters: r for r in K.cluster_count_scan(df, cols, 6).collect()}
    assert min(scan, key=lambda k: scan[k].bic) == 3
    best = K.silhouette_scan(df, "id", cols, 5).orderBy(F.desc("silhouette")).first()
    assert best.n_clusters in (2, 3)


def test_silhouettes_are_the_plain_ones(spark, groups):
    x = groups[::5]
    df, cols = table(spark, x), ["x0", "x1", "x2"]
    p = G.points(df, cols)
    models = G.fit(p, [2, 4])
    got = G.silhouettes(p, models)
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    for k, m in models.items():
        lab = m.labels(x - p.mean)
        s = []
        for i, c in enumerate(lab):
            if (lab == c).sum() == 1:
                s.append(0.0)
                continue
            a = far[i, lab == c].sum() / ((lab == c).sum() - 1)
            b = min(far[i, lab == o].mean() for o in set(lab) - {c})
            s.append((b - a) / max(a, b))
        assert got[k] == pytest.approx(np.mean(s), abs=1e-9)


def test_many_columns_and_few_rows(spark):
    x = np.random.default_rng(1).normal(size=(150, 64))
    df, cols = table(spark, x), [f"x{i}" for i in range(64)]
    for form in ("shared", "diagonal"):
        rows = K.cluster_count_scan(df, cols, 3, form).collect()
        assert [r.n_clusters for r in rows] == [1, 2, 3] and all(np.isfinite(r.bic) for r in rows)


def test_odd_rows(spark):
    schema = "id int, x double, y float"
    none = spark.createDataFrame([], schema)
    assert K.gmm_labels(none, "id", ["x", "y"], 3).collect() == []
    assert K.cluster_count_scan(none, ["x", "y"]).collect() == [] and K.silhouette_scan(none, "id", ["x", "y"]).collect() == []
    alike = spark.createDataFrame([(i, 4.0, 1.0) for i in range(30)], schema)
    assert {r.cluster for r in K.gmm_labels(alike, "id", ["x", "y"], 3).collect()} == {0}
    assert {r.silhouette for r in K.silhouette_scan(alike, "id", ["x", "y"], 3).collect()} == {None}
    odd = spark.createDataFrame([(1, None, float("nan")), (2, float("inf"), 1.0), (3, 5.0, None), (None, -float("inf"), 2.0)], schema)
    assert K.gmm_labels(odd, "id", ["x", "y"], 2).count() == 4
    one = spark.createDataFrame([(1, 2.0, 3.0)], schema)
    assert K.cluster_count_scan(one, ["x", "y"], 2).count() == 2


def test_seeds_reach_a_small_far_group(spark):
    """A third of all rows are one row; a group of 40 lies far off."""
    rng = np.random.default_rng(2)
    x = np.concatenate([np.zeros((2000, 2)), rng.normal(3, 0.5, (4000, 2)), rng.normal(60, 0.5, (40, 2))])
    p = G.points(table(spark, x), ["x0", "x1"])
    candidates, rows = G.oversampled(p, 6, 5, 42)
    assert rows.sum() == len(x) and len(candidates) <= 30
    lab = G.fit(p, [3])[3].labels(x - p.mean)
    assert len(set(lab[-40:])) == 1 and lab[-1] not in lab[:-40]


def test_prototypes_are_the_plain_ones(spark):
    """Same centres, row by row, from the same start; ties and nulls included."""
    rng = np.random.default_rng(7)
    d = pd.DataFrame({"id": range(120), "a": np.r_[rng.normal(0, 1, 60), rng.normal(6, 1, 60)], "b": rng.normal(0, 1, 120),
                      "c": [None if i % 11 == 0 else "xyz"[(i // 60 + (i % 7 == 0)) % 3] for i in range(120)]})
    df = spark.createDataFrame(d).repartition(3)
    got = {r.id: r.cluster for r in K.kprototypes_labels(df, "id", ["a", "b"], ["c"], 3).collect()}
    z = (d[["a", "b"]] - d[["a", "b"]].mean()) / d[["a", "b"]].std(ddof=0)
    c = d.c.where(d.c.notna(), None).tolist()
    kinds = sorted(set(c), key=lambda v: (-c.count(v), v is not None, v or ""))[:3]
    centres = [(z[[x == v for x in c]].mean().to_numpy(), v) for v in kinds]
    for _ in range(100):
        far = np.array([[((r - m) ** 2).sum() + 0.5 * (v != w) for m, w in centres] for r, v in zip(z.to_numpy(), c)])
        at = far.argmin(axis=1)
        new = []
        for i, old in enumerate(centres):
            own = [v for v, k in zip(c, at) if k == i]
            new.append((z[at == i].mean().to_numpy(), min(set(own), key=lambda v: (-own.count(v), v is None, v or ""))) if own else old)
        if all(a[1] == b[1] and np.allclose(a[0], b[0]) for a, b in zip(new, centres)):
            break
        centres = new
    assert [got[i] for i in range(120)] == list(at)
    with pytest.warns(RuntimeWarning, match="still move"):
        K.kprototypes_labels(df, "id", ["a", "b"], ["c"], 3, max_iter=1)


def test_method_follows_the_columns(spark):
    rng = np.random.default_rng(9)
    x = np.r_[np.exp(rng.normal(0, 0.3, 200)), np.exp(rng.normal(4, 0.3, 100))]
    d = pd.DataFrame({"id": range(300), "x": x, "flag": ["u"] * 200 + ["v"] * 100, "when": pd.Timestamp("2020-01-01")})
    df = spark.createDataFrame(d)
    groups = lambda f: [set(g) for g in f.toPandas().groupby("cluster").id.apply(list)]
    truth = [set(range(200)), set(range(200, 300))]
    assert sorted(groups(K.find_clusters(df, "id", 2)), key=min) == truth
    assert sorted(groups(K.find_clusters(df.drop("flag"), "id", 2)), key=min) == truth
    assert sorted(groups(K.find_clusters(df, "id", 2, "gmm")), key=min) == truth
    with pytest.raises(ValueError):
        K.find_clusters(df.select("id", "flag"), "id", 2, "gmm")


def test_clusters_multiply_no_row(spark, monkeypatch):
    """Neither the grid of the power transform nor a round of k-prototypes
    makes several rows of one; the results are the plain ones."""
    rng = np.random.default_rng(3)
    x = np.r_[np.exp(rng.normal(0, 1, 400)), -rng.exponential(1, 60)]
    d = pd.DataFrame({"id": range(460), "x": x, "y": [5.0] * 460, "c": [None if i % 9 == 0 else "uvw"[i % 3] for i in range(460)]})
    df = spark.createDataFrame(d).withColumn("x", F.when(F.col("id") != 7, F.col("x"))).repartition(5)
    x, best = np.delete(x, 7), 0.0
    for reach, count in ((5.0, 41), (0.25, 21), (0.025, 21)):
        lams = [round(best - reach + 2 * reach * i / (count - 1), 6) for i in range(count)]
        psi = lambda v, m: (np.log1p(v) if m == 0 else ((1 + v) ** m - 1) / m) if v >= 0 else (-np.log1p(-v) if m == 2 else -((1 - v) ** (2 - m) - 1) / (2 - m))
        best = max(lams, key=lambda m: -len(x) / 2 * np.log(np.var([psi(v, m) for v in x])) + (m - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum())
    assert K.power_lambdas(df, ["x", "y"]) == {"x": best, "y": 0.0}

    def fail(*_):
        raise AssertionError("rows are multiplied")

    monkeypatch.setattr(F, "explode", fail)
    assert K.find_clusters(df, "id", 3).count() == 460


def test_prototype_counts_are_sent_in_parts(spark, monkeypatch):
    """Many different values are not all held by a task."""
    d = pd.DataFrame({"a": np.arange(300) % 7 - 3.0, "c": [None if i % 10 == 0 else f"v{i % 150}" for i in range(300)]})
    blocks = K._packed(spark.createDataFrame(d).repartition(6), ["a"], ["c"]).toArrow().to_batches()
    monkeypatch.setattr(K, "HELD_VALUES", 20)
    out = list(K._labelled_sums([([-1.0], ["v1"]), ([2.0], [None])], 1, 1, 0.5)(iter(blocks)))
    assert len(out) > 3
    got = pd.concat([b.to_pandas() for b in out]).fillna({"value": "none"}).groupby(["l", "column", "value"])[["n", "x"]].sum()
    far = [(d.a + 1) ** 2 + 0.5 * (d.c != "v1"), (d.a - 2) ** 2 + 0.5 * d.c.notna()]
    at = np.where(far[1] < far[0], 1, 0)
    plain = d.c.fillna("none").groupby([at, d.c.fillna("none")]).size()
    assert {k: n for (l, c, k), n in got.n.items() if c == "c0" and l == 1} == plain[1].to_dict()
    assert {k: n for (l, c, k), n in got.n.items() if c == "c0" and l == 0} == plain[0].to_dict()
    assert got.x[1, "n0", "none"] == pytest.approx(d.a[at == 1].sum()) and got.n[0, "n0", "none"] == (at == 0).sum()
