"""Boosted trees against a plain version that tries every split of every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescope.operators import boosting as B


def rows_of(n=400, seed=1):
    r = np.random.default_rng(seed)
    x = np.stack([r.integers(0, 12, n), r.integers(0, 30, n), np.ones(n)], axis=1).astype(float)
    y = np.where(x[:, 0] > 5, 3.0, 0.0) + x[:, 1] / 10 + r.normal(0, 0.3, n)
    return x, y


def table(spark, x, y):
    return spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "x0 double, x1 double, x2 double, y double").repartition(5)


def plain_margins(x, y, classes, trees, depth, rate=0.1, reg=1.0, least=20):
    """Margins of all rows, every threshold tried on the rows themselves."""
    outputs = classes if classes > 2 else 1
    if classes:
        prior = np.array([(y == k).mean() for k in range(classes)])
        base = np.log(prior) if classes > 2 else np.log(prior[1:] / prior[:1])
    else:
        base = np.array([y.mean()])
    m = np.tile(base, (len(x), 1)).astype(float)
    for _ in range(trees):
        g, h = B.derivatives(y, m, classes)
        step = np.zeros_like(m)
        for k in range(outputs):
            todo = [(np.arange(len(x)), 0)]
            while todo:
                own, level = todo.pop()
                score = lambda i: g[i, k].sum() ** 2 / (h[i, k].sum() + reg)  # noqa: E731, B023
                best = (1e-9 * max(1.0, score(own)), None)
                if level < depth:
                    for f in range(x.shape[1]):
                        for t in np.unique(x[own, f]):
                            a, b = own[x[own, f] <= t], own[x[own, f] > t]
                            if min(len(a), len(b)) >= least and score(a) + score(b) - score(own) > best[0] * (1 + 1e-9):
                                best = (score(a) + score(b) - score(own), (a, b))
                if best[1]:
                    todo += [(part, level + 1) for part in best[1]]
                elif level:
                    step[own, k] = -rate * g[own, k].sum() / (h[own, k].sum() + reg)
        m += step
    return m


@pytest.mark.parametrize("classes", [0, 2, 4])
def test_every_split_is_the_best_one(spark, classes, monkeypatch):
    monkeypatch.setattr(B, "RENEW", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    x, y = rows_of()
    if classes:
        y = np.clip(np.floor(y / y.max() * classes), 0, classes - 1)
    model = B.fit(table(spark, x, y), "y", ["x0", "x1", "x2"], classes, trees=5, depth=3)
    assert len(model.rounds) == 5 and all(len(t) == (classes if classes > 2 else 1) for t in model.rounds)
    assert model.margins(x) == pytest.approx(plain_margins(x, y, classes, 5, 3), abs=1e-7)
    share = model.importances()
    assert share.sum() == pytest.approx(1) and share[2] == 0


def test_predictions_and_loss(spark):
    x, y = rows_of()
    k = np.clip(np.floor(y), 0, 2)
    df = table(spark, x, k)
    losses = []
    for trees in (1, 10, 40):
        m = B.fit(df, "y", ["x0", "x1", "x2"], 3, trees=trees, depth=3)
        p = np.exp(m.margins(x))
        p /= p.sum(axis=1, keepdims=True)
        losses.append(-np.log(p[np.arange(len(k)), k.astype(int)]).mean())
    assert losses[0] > losses[1] > losses[2]
    got = m.transform(df, [F.col(c) for c in ("x0", "x1", "x2")]).toPandas()
    want = m.margins(got[["x0", "x1", "x2"]].to_numpy())
    assert (got.prediction.to_numpy() == want.argmax(axis=1)).all()
    assert np.allclose([sum(r) for r in got.probability], 1) and (got.prediction == got.y).mean() > 0.8


def test_leaf_limit_and_thin_tables(spark):
    x, y = rows_of()
    df = table(spark, x, y)
    m = B.fit(df, "y", ["x0", "x1"], trees=2, depth=4, leaves=3)
    assert all(sum(f < 0 for f in t.feature) <= 3 for (t,) in m.rounds)
    assert B.fit(df.limit(0), "y", ["x0"], trees=3).rounds == []
    assert B.fit(df.withColumn("y", F.lit(1.0)), "y", ["x0"], 2, trees=3).rounds == []
    assert B.fit(df.withColumn("y", F.lit(1.0)), "y", ["x0"], trees=3).margins(x[:2]).tolist() == [[1.0], [1.0]]


@pytest.mark.parametrize("classes", [0, 2, 4])
def test_equal_rows_become_one_with_the_same_trees(spark, classes, monkeypatch):
    """Few combinations of bins: the fit holds one row for each, however many
    rows there are, and the trees are those of the single rows."""
    monkeypatch.setattr(B, "RENEW", 5)
    monkeypatch.setattr(B, "RENEW_HELD", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    x, y = rows_of(3000)
    if classes:
        y = np.clip(np.floor(y / y.max() * classes), 0, classes - 1)
    held = []
    in_memory = B.in_memory
    monkeypatch.setattr(B, "in_memory", lambda blocks: held.append(blocks) or in_memory(blocks))
    model = B.fit(table(spark, x, y), "y", ["x0", "x1", "x2"], classes, trees=8, depth=3)
    assert model.margins(x) == pytest.approx(plain_margins(x, y, classes, 8, 3), abs=1e-7)
    rows = sum(len(r.bins) // 3 for r in held[0].collect())
    assert rows == len(np.unique(x, axis=0)) < 400


def test_blocks_are_dealt_out_however_rows_were_read(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    monkeypatch.setattr(B, "LEAST_ROWS", 50)
    x, y = rows_of()
    seen = []
    level_sums = B.level_sums
    monkeypatch.setattr(B, "level_sums", lambda blocks, *a: seen.append(blocks.getNumPartitions()) or level_sums(blocks, *a))
    B.fit(table(spark, x, y).coalesce(1), "y", ["x0", "x1"], trees=1)
    assert set(seen) == {8}
