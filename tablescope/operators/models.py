"""Tree models with attribution, and the scores of given predictions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.exprs import clean_double, col, label_columns, share
from ..functions.frames import BUCKET_ROWS, checkpointed, column_quantiles, fits_one_pass, row_index, running_totals
from . import boosting
from .charts import hash_percent
from .features import levels_of
from .selection import MAX_CLASSES, _bin


def infer_task(df: DataFrame, target: str) -> DataFrame:
    n = df.agg(F.count_distinct(col(target)).alias("n"))
    return n.select(F.lit(target).alias("target"), F.col("n").alias("n_unique"), F.when(F.col("n") <= MAX_CLASSES, "classify").otherwise("regress").alias("task"))


# Scores of given predictions

def confusion_matrix(df: DataFrame, actual: str, pred: str, zeros: bool = True) -> DataFrame:
    """Counts over the labels that occur as actual values: actual, predicted,
    n. Zero-filled, or, for any number of labels, without ``zeros``."""
    counts = df.groupBy(col(actual).alias("actual"), col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    if not zeros:
        known = counts.filter("actual is not null").select(F.col("actual").alias("predicted")).distinct()
        return counts.filter("actual is not null").join(known, "predicted", "left_semi").select("actual", "predicted", "n")
    labels = levels_of(df, actual)
    kind = df.schema[actual].dataType.simpleString()
    every = df.sparkSession.createDataFrame([(v,) for v in labels], f"actual {kind}")
    grid = every.select("actual", F.explode(F.array(*[F.lit(v).cast(kind) for v in labels])).alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def classification_scores(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Weighted precision, recall, F1 and accuracy from per-class counts."""
    a, p = col(actual).cast("string"), col(pred).cast("string")
    pairs = df.groupBy(*by, a.alias("__a"), p.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    sides = pairs.select(*by, F.explode(F.array(
        F.struct(F.col("__a").alias("c"), F.col("__n").alias("act"), F.lit(0).cast("bigint").alias("prd"), F.when(F.col("__a") == F.col("__p"), F.col("__n")).otherwise(0).cast("bigint").alias("hit")),
        F.struct(F.col("__p").alias("c"), F.lit(0).cast("bigint").alias("act"), F.col("__n").alias("prd"), F.lit(0).cast("bigint").alias("hit")))).alias("s")).select(*by, "s.*")
    per = sides.groupBy(*by, "c").agg(F.sum("act").alias("act"), F.sum("prd").alias("prd"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hit") * 1.0, F.col("prd")), zero)
    recall = F.coalesce(F.try_divide(F.col("hit") * 1.0, F.col("act")), zero)
    f1 = F.coalesce(F.try_divide(F.col("hit") * 2.0, F.col("act") + F.col("prd")), zero)
    n = F.sum("act")
    mean = lambda e: F.try_divide(F.sum(F.col("act") * e), n)
    out = [mean(precision).alias("precision"), mean(recall).alias("recall"), mean(f1).alias("f1"), F.try_divide(F.sum("hit") * 1.0, n).alias("accuracy"), n.alias("n")]
    return per.groupBy(*by).agg(*out) if by else per.agg(*out)


def r2_score(df: DataFrame, actual: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = clean_double(col(actual)), clean_double(col(pred))
    out = [F.count(y).alias("n"), (1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2")]
    return df.groupBy(*by).agg(*out) if by else df.agg(*out)


def _roc_counts(df: DataFrame, actual: str, score: str, positive) -> DataFrame:
    y = col(actual) == F.lit(positive)
    return df.filter(col(score).isNotNull() & col(actual).isNotNull()).groupBy(clean_double(col(score)).alias("threshold")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def roc_curve(df: DataFrame, actual: str, score: str, positive=1, one_pass: bool | None = None) -> DataFrame:
    """threshold, fpr, tpr at every distinct score and the origin."""
    c = _roc_counts(df, actual, score, positive)
    run = running_totals(c, "threshold", {"tp": "pos", "fp": "neg"}, one_pass=one_pass, descending=True)
    t = c.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("s")).scalar()
    pts = run.select("threshold", share(F.col("fp"), t["n"]).alias("fpr"), share(F.col("tp"), t["p"]).alias("tpr"))
    origin = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def auc_score(df: DataFrame, actual: str, score: str, positive=1, one_pass: bool | None = None) -> DataFrame:
    """Area under the curve by trapezoids over the distinct scores."""
    c = _roc_counts(df, actual, score, positive)
    run = running_totals(c, "threshold", {"tp": "pos"}, one_pass=one_pass, descending=True)
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos"))) / 2.0
    return run.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
                   F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def auc_one_vs_rest(df: DataFrame, actual: str, scores: dict[str, str], one_pass: bool | None = None) -> DataFrame:
    """AUC per class, given {class: column of its score}. All classes are
    counted in one pass over the rows."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("class"), clean_double(col(c)).alias("threshold")) for k, c in scores.items()]))
    long = df.filter(col(actual).isNotNull()).select(col(actual).alias("__y"), each.alias("s")).filter("s.threshold is not null")
    c = long.groupBy(F.col("s.class").alias("class"), F.col("s.threshold").alias("threshold")).agg(
        F.count_if(F.col("__y") == F.col("s.class")).alias("pos"), F.count_if(F.col("__y") != F.col("s.class")).alias("neg"))
    run = running_totals(c, "threshold", {"tp": "pos"}, ["class"], one_pass=one_pass, descending=True)
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos"))) / 2.0
    return run.groupBy("class").agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def tree_curves(fit: TreeModel) -> dict[str, DataFrame]:
    """ROC points and AUC of the test rows; for two classes those of the second
    one, for more the area of each class against the rest."""
    p = F.col("probability")
    if len(fit.classes) == 2:
        t = fit.test.select("label", p[1].alias("score"))
        return {"roc_curve": roc_curve(t, "label", "score", 1.0), "auc": auc_score(t, "label", "score", 1.0)}
    t = fit.test.select("label", *[p[i].alias(f"s{i}") for i in range(len(fit.classes))])
    return {"auc": auc_one_vs_rest(t, "label", {float(i): f"s{i}" for i in range(len(fit.classes))})}


# Tree models

@dataclass
class TreeModel:
    target: str
    features: list[str]
    task: str
    model: boosting.Boosted
    levels: dict
    classes: list
    test: DataFrame
    n_train: int
    n_test: int
    metric_name: str
    metric_value: float

    def importance(self, n: int = 20) -> DataFrame:
        spark = self.test.sparkSession
        rows = [(f, float(v)) for f, v in zip(self.features, self.model.importances())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(n)

    def summary(self) -> DataFrame:
        return self.test.sparkSession.createDataFrame(
            [(self.target, self.task, self.n_train, self.n_test, self.metric_name, self.metric_value)],
            "target string, task string, n_train bigint, n_test bigint, metric_name string, metric_value double")


def encode(df: DataFrame, target: str, features: Sequence[str], id_col: str, task: str, log_target: bool = False) -> tuple[DataFrame, dict, list]:
    """Complete rows as (id, label, x0..): categories become level numbers."""
    full = df.dropna(subset=[target, *features])
    cats = set(label_columns(df))
    levels = {f: levels_of(full, f) for f in features if f in cats}
    number = lambda c, vs: F.element_at(F.create_map(*[F.lit(x) for i, v in enumerate(vs) for x in (v, float(i))]), c)
    classes = levels_of(full, target) if task == "classify" else []
    if classes:
        y = number(col(target), classes)
    else:
        y = clean_double(col(target))
        y = F.when(y > -1, F.log1p(y)) if log_target else y
    xs = [number(col(f), levels[f]) if f in levels else clean_double(col(f)) for f in features]
    flat = full.select(col(id_col).alias("id"), y.alias("label"), *[x.alias(f"x{i}") for i, x in enumerate(xs)])
    return flat.dropna(), levels, classes


def xs_of(p: int) -> list[str]:
    return [f"x{i}" for i in range(p)]


def _task(df: DataFrame, target: str, task: str) -> str:
    return infer_task(df, target).first()["task"] if task == "auto" else task


def _metric(scored: DataFrame, task: str) -> float:
    if task == "classify":
        return float(classification_scores(scored, "label", "prediction").first()["f1"] or 0.0)
    return float(r2_score(scored, "label", "prediction").first()["r2"] or 0.0)


def fit_tree(df: DataFrame, target: str, features: Sequence[str], id_col: str, task: str = "auto", log_target: bool = False,
             test_percent: int = 20, trees: int = 100, depth: int = 4) -> TreeModel:
    """Boosted trees, tested on the rows whose id hashes into the last
    test_percent. The encoded rows are written once to the checkpoint folder."""
    task = _task(df, target, task)
    flat, levels, classes = encode(df, target, features, id_col, task, log_target)
    xs = xs_of(len(features))
    data = checkpointed(flat.withColumn("__test", hash_percent("id") >= 100 - test_percent))
    train, test = data.filter(~F.col("__test")), data.filter("__test")
    model = boosting.fit(train, "label", xs, len(classes), trees, depth)
    scored = checkpointed(model.transform(test, [F.col(x) for x in xs]).select("id", "label", "prediction", *xs, *([] if task == "regress" else ["probability"])))
    n = {r["__test"]: r["count"] for r in data.groupBy("__test").count().collect()}
    return TreeModel(target, list(features), task, model, levels, classes, scored, n.get(False, 0), n.get(True, 0),
                     "f1_weighted" if task == "classify" else "r2", _metric(scored, task))


def cv_f1(df: DataFrame, target: str, features: Sequence[str], id_col: str, folds: int = 5, trees: int = 100, depth: int = 4) -> DataFrame:
    """Weighted F1 per fold and on average; folds by hash of the id."""
    flat, _, classes = encode(df, target, features, id_col, "classify")
    fold = (F.conv(F.substring(F.md5(F.col("id").cast("string").cast("binary")), 9, 8), 16, 10).cast("bigint") % folds).cast("int")
    data, xs = checkpointed(flat.withColumn("fold", fold)), xs_of(len(features))

    def one(k: int) -> tuple[int, float]:
        model = boosting.fit(data.filter(F.col("fold") != k), "label", xs, len(classes), trees, depth)
        return k, _metric(model.transform(data.filter(F.col("fold") == k), [F.col(x) for x in xs]), "classify")

    # The jobs of the folds are small; they share the cluster instead of waiting for each other.
    with ThreadPoolExecutor(folds) as pool:
        rows = list(pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds)))
    rows.append((None, sum(r[1] for r in rows) / folds))
    return df.sparkSession.createDataFrame(rows, "fold int, f1 double")


def permutation_importance(fit: TreeModel, repeats: int = 5) -> DataFrame:
    """Drop of the test score when one feature is shuffled: mean and deviation.

    All shuffles are one table: every test row once per (feature, repeat),
    given the feature value of the row of equal rank in a hash order.
    """
    p = len(fit.features)
    xs = [f"x{i}" for i in range(p)]
    base = fit.test.select("id", "label", *xs)
    runs = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(r).alias("r")) for f in range(p) for r in range(repeats)])
    each = base.select("*", F.explode(runs).alias("t")).select("id", "label", *xs, "t.f", "t.r")
    order = lambda salt: F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(salt), F.col("id").cast("string"), F.col("f"), F.col("r")).cast("binary")), 1, 12), 16, 10).cast("double")
    taker = row_index(each.withColumn("h", order("a")), ["f", "r"], ["h", "id"], "rk")
    value = F.array(*[F.col(x) for x in xs])[F.col("f")]
    giver = row_index(each.select("id", "f", "r", value.alias("v"), order("b").alias("h")), ["f", "r"], ["h", "id"], "rk").select("f", "r", "rk", "v")
    mixed = taker.join(giver, ["f", "r", "rk"]).select(
        "f", "r", "label", *[F.when(F.col("f") == i, F.col("v")).otherwise(F.col(x)).alias(x) for i, x in enumerate(xs)])
    scored = fit.model.transform(mixed, [F.col(x) for x in xs]).select("f", "r", "label", "prediction")
    if fit.task == "classify":
        s = classification_scores(scored, "label", "prediction", ["f", "r"]).withColumn("s", F.col("f1"))
    else:
        s = r2_score(scored, "label", "prediction", ["f", "r"]).withColumn("s", F.col("r2"))
    names = F.array(*[F.lit(f) for f in fit.features])
    drop = F.lit(fit.metric_value) - F.col("s")
    return s.groupBy("f").agg(F.avg(drop).alias("importance_mean"), F.coalesce(F.stddev_pop(drop), F.lit(0.0)).alias("importance_std")).select(
        names[F.col("f")].alias("feature"), "importance_mean", "importance_std")


# Attribution

def tree_paths(model: boosting.Boosted) -> tuple[list, np.ndarray]:
    """Leaves of all trees as (value per output, [(feature, zero_share,
    tests)]) and the expected output. A test is (threshold, left or not)."""
    leaves = []

    def walk(tree: boosting.Tree, node: int, path: list, output: int) -> None:
        f = tree.feature[node]
        if f < 0:
            value = np.zeros(len(model.base))
            value[output] = tree.value[node]
            merged: dict[int, list] = {}
            for f, z, test in path:
                m = merged.setdefault(f, [1.0, []])
                m[0] *= z
                m[1].append(test)
            leaves.append((value, [(f, z, tests) for f, (z, tests) in merged.items()]))
            return
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            walk(tree, child, path + [(f, tree.cover[child] / tree.cover[node], (tree.threshold[node], left))], output)

    for trees in model.rounds:
        for k, tree in enumerate(trees):
            walk(tree, 0, [], k)
    expected = sum((v * math.prod(z for _, z, _ in path) for v, path in leaves), model.base)
    return leaves, expected


def shap_block(x: np.ndarray, leaves: list) -> np.ndarray:
    """Path-dependent Shapley values, rows x features x outputs.

    A leaf's values follow from which of its features a row agrees with, so
    they are worked out once per combination, and rows only look them up.
    """
    n, p = x.shape
    x = np.ascontiguousarray(x.T)
    out = np.zeros((p, len(leaves[0][0]) if leaves else 1, n))
    for value, path in leaves:
        m = len(path)
        if not m:
            continue
        table = shap_table(tuple(z for _, z, _ in path))
        code = np.zeros(n, np.int64)
        for j, (f, _, tests) in enumerate(path):
            agrees = np.ones(n, bool)
            for threshold, left in tests:
                agrees &= (x[f] <= threshold) == left
            code += agrees.astype(np.int64) << j
        for i, (f, _, _) in enumerate(path):
            for k in np.flatnonzero(value):
                out[f, k] += (table[:, i] * value[k]).take(code)
    return np.moveaxis(out, -1, 0)


@lru_cache(maxsize=65_536)
def shap_table(zeros: tuple[float, ...]) -> np.ndarray:
    """Shares of a leaf's value by features that a row agrees with (bit j of
    the table's row number) x feature of the path."""
    m = len(zeros)
    ones = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
    weight = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
    table = np.zeros((1 << m, m))
    for i in range(m):
        # Sum over subsets by size: product of (zero + one * t) over the others.
        poly = np.zeros((1 << m, m))
        poly[:, 0] = 1.0
        for j in range(m):
            if j != i:
                up = poly * zeros[j]
                up[:, 1:] += poly[:, :-1] * ones[:, j][:, None]
                poly = up
        table[:, i] = (poly @ weight) * (ones[:, i] - zeros[i])
    return table


def shap_values(fit: TreeModel, rows: DataFrame | None = None) -> DataFrame:
    """id, x array, shap array<array<double>> (feature, output) per row."""
    spark = fit.test.sparkSession
    src = fit.test if rows is None else rows
    leaves, _ = tree_paths(fit.model)
    shared = spark.sparkContext.broadcast(leaves)  # trees x leaves, fixed by the model
    kind = src.schema["id"].dataType.simpleString()
    flat = src.select("id", F.array(*[F.col(f"x{i}") for i in range(len(fit.features))]).alias("x"))

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                s = shap_block(np.array(b["x"].tolist(), dtype=float), shared.value)
                yield pd.DataFrame({"id": b["id"], "x": b["x"], "shap": [r.tolist() for r in s]})

    return flat.mapInPandas(explain, f"id {kind}, x array<double>, shap array<array<double>>")


def shap_importance(fit: TreeModel) -> DataFrame:
    """Mean absolute value per feature, averaged over the outputs."""
    per = F.transform("shap", lambda o: F.aggregate(o, F.lit(0.0), lambda a, v: a + F.abs(v)) / F.size(o))
    long = shap_values(fit).select(F.posexplode(per).alias("i", "s"))
    names = F.array(*[F.lit(f) for f in fit.features])
    return long.groupBy("i").agg(F.avg("s").alias("mean_abs_shap")).select(names[F.col("i")].alias("feature"), "mean_abs_shap")


def shap_dependence(fit: TreeModel, feature: str, interaction: str | None = None) -> DataFrame:
    """id, feature_value, shap_value and, on request, interaction_value."""
    i = fit.features.index(feature)
    s = shap_values(fit)
    one = F.col("shap")[i]
    value = F.when(F.size(one) == 1, one[0]).otherwise(F.aggregate(one, F.lit(0.0), lambda a, v: a + F.abs(v)) / F.size(one))
    extra = [F.col("x")[fit.features.index(interaction)].alias("interaction_value")] if interaction else []
    return s.select("id", F.col("x")[i].alias("feature_value"), value.alias("shap_value"), *extra)


def actual_vs_predicted(fit: TreeModel, rows: int = 2000, log_target: bool = True) -> DataFrame:
    """Bounded sample of test rows (by hash of the id) on the original scale."""
    back = F.expm1 if log_target else (lambda c: c)
    s = fit.test.select("id", back(F.col("label")).alias("actual"), back(F.col("prediction")).alias("predicted"))
    return s.orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id").limit(rows)


# Lagged prediction

def lag_features(df: DataFrame, order: Sequence[str], value: str, max_lag: int = 12, keep: Sequence[str] = (),
                 block: int = BUCKET_ROWS, one_pass: bool | None = None) -> DataFrame:
    """order..., keep..., row_index, lag_1..lag_n without a one-task window.

    Rows are numbered, cut into blocks, and the last max_lag rows of a block
    are also sent to the next one. There are as many tasks as blocks.
    """
    slim = df.select(*dict.fromkeys([*order, value, *keep]))
    if one_pass is None:
        one_pass = fits_one_pass(slim)
    r = row_index(slim, [], order, one_pass=one_pass)
    here = F.floor((F.col("row_index") - 1) / block)
    tail = (F.col("row_index") - 1) % block >= block - max_lag
    sent = r.select("*", F.explode(F.when(tail, F.array(here, here + 1)).otherwise(F.array(here))).alias("__b"), here.alias("__own"))
    if not one_pass:
        tasks = max(-(-slim.count() // block), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        sent = sent.repartition(tasks, "__b")
    w = Window.partitionBy("__b").orderBy("row_index")
    lagged = sent.select("*", *[F.lag(value, k).over(w).alias(f"lag_{k}") for k in range(1, max_lag + 1)])
    return lagged.filter(F.col("__b") == F.col("__own")).drop("__b", "__own")


def lag_scores(df: DataFrame, order: Sequence[str], value: str, label: str, max_lag: int = 12, splits: int = 5,
               metric: str = "roc", bins: int = 16) -> DataFrame:
    """How well each lag alone predicts a 0/1 label over expanding folds.

    The learner is a step function over quantile bins of the lagged value,
    so all lags and folds are fitted from one table of counts. The edges are
    quantiles of the value over the rows before the first test fold. A fold with
    only one class scores 0.5.
    """
    lags = lag_features(df, order, value, max_lag, [label])
    used = lags.filter((F.col("row_index") > max_lag) & col(label).isNotNull())
    full = used.dropna(subset=[f"lag_{k}" for k in range(1, max_lag + 1)])
    n = full.count()
    size = n // (splits + 1)
    first = n - splits * size
    pos = F.col("row_index") - max_lag  # complete rows follow each other
    part = F.when(pos <= first, 0).otherwise(F.least(F.floor((pos - first - 1) / max(size, 1)) + 1, F.lit(splits))).cast("int")
    # The first part trains every fold; no row that is ever tested moves an edge.
    known = full.select(col(value).alias("v"), part.alias("part")).filter("part = 0").select("v")
    edges = column_quantiles(known, ["v"], [i / bins for i in range(bins + 1)]).first()["q"] or [0.0]
    cells = F.array(*[F.struct(F.lit(k).alias("lag"), _bin(clean_double(F.col(f"lag_{k}")), edges).alias("bin")) for k in range(1, max_lag + 1)])
    counts = full.select(part.alias("part"), col(label).cast("int").alias("y"), F.explode(cells).alias("c")).groupBy("part", "c.lag", "c.bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    # From here on the table has lags x folds x bins rows.
    tests = counts.filter(F.col("part") > 0)
    folds = counts.select("lag", "bin", "n", "pos", F.explode(F.sequence(F.col("part") + 1, F.lit(splits + 1))).alias("fold")).filter(F.col("fold") <= splits)
    train = folds.groupBy("lag", "fold", "bin").agg(F.sum("n").alias("tn"), F.sum("pos").alias("tp"))
    base = train.groupBy("lag", "fold").agg((F.sum("tp") * 2 > F.sum("tn")).alias("default"))
    j = tests.withColumnRenamed("part", "fold").join(train, ["lag", "fold", "bin"], "left").join(base, ["lag", "fold"])
    say = F.coalesce(F.col("tp") * 2 > F.col("tn"), F.col("default"))
    s = j.groupBy("lag", "fold").agg(
        F.sum(F.when(say, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(say, F.col("n") - F.col("pos")).otherwise(0)).alias("fp"),
        F.sum("pos").alias("p"), F.sum(F.col("n") - F.col("pos")).alias("q"))
    zero = F.lit(0.0)
    rec, prec = F.try_divide(F.col("tp") * 1.0, F.col("p")), F.try_divide(F.col("tp") * 1.0, F.col("tp") + F.col("fp"))
    score = {
        "roc": F.when((F.col("p") == 0) | (F.col("q") == 0), 0.5).otherwise((rec + 1 - F.try_divide(F.col("fp") * 1.0, F.col("q"))) / 2),
        "recall": F.coalesce(rec, zero), "precision": F.coalesce(prec, zero),
        "f1": F.coalesce(F.try_divide(F.col("tp") * 2.0, F.col("tp") * 2 + F.col("fp") + F.col("p") - F.col("tp")), zero),
    }[metric]
    return s.groupBy("lag").agg(F.avg(score).alias("score"))
