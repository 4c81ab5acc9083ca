"""Group tests, collinearity and linear models.

The row-sized work is one distributed aggregate to sufficient statistics;
what is left for the driver is algebra on (columns x columns) numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import clean_double, col, label_columns, numeric_columns, one, rnd, varies
from ..functions.frames import pair_fan, per_column, quantiles_of, unpivot_numeric
from ..functions.special import f_tail, t_quantile, t_two_sided
from . import wide
from .charts import box_stats
from .features import levels_of


def gram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uncentred sums of products (i, j, g), null counted as zero."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    fan = pair_fan(df, [F.coalesce(clean_double(col(c)), F.lit(0.0)) for c in cols], pairs)
    return fan.groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("g"))


def matrix(rows: DataFrame, size: int, value: str) -> np.ndarray:
    m = np.zeros((size, size))
    for r in rows.collect():  # size * (size + 1) / 2 numbers
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = np.nan if r[value] is None else r[value]
    return m


def vif_scores(df: DataFrame, cols: Sequence[str] | None = None, null_share: float = 0.2) -> DataFrame:
    """Variance inflation without intercept; null where columns are dependent."""
    cols = list(cols or numeric_columns(df))
    nulls = per_column(df, cols, {"p": F.try_divide(F.count_if(F.col("value").isNull()) * 1.0, F.count(F.lit(1)))})
    few = {r["column"] for r in nulls.filter(F.col("p") < null_share).collect()}
    cols = [c for c in cols if c in few]
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, vif double")
    g = matrix(gram(df, cols), len(cols), "g")
    scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    scaled = g / np.outer(scale, scale)
    rows = []
    regular = np.linalg.cond(scaled) < 1e13
    inv = np.linalg.inv(scaled) if regular else None
    for i, c in enumerate(cols):
        rows.append((c, float(scaled[i, i] * inv[i, i]) if regular else None))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double").orderBy(F.desc_nulls_first("vif"))


def anova(df: DataFrame, target: str, cluster: str) -> DataFrame:
    """One-way ANOVA: k, n, f_stat, eta_squared (unrounded), one row."""
    y = clean_double(col(target))
    g = df.filter(col(cluster).isNotNull()).groupBy(cluster).agg(
        F.count(F.lit(1)).alias("rows"), F.count(y).alias("n"), F.avg(y).alias("m"), F.coalesce(F.var_samp(y), F.lit(0.0)).alias("v"))
    whole = one(df, mu=F.avg(y), ss=F.var_pop(y) * F.count(y))
    d = F.col("m") - whole["mu"]
    s = g.filter((F.col("rows") >= 2) & (F.col("n") > 0)).agg(
        F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum((F.col("n") - 1) * F.col("v")).alias("ssw"),
        F.sum(F.col("n") * d * d).alias("b2"), F.sum(F.col("n") * d).alias("b1"))
    ssb = F.col("b2") - F.col("b1") * F.col("b1") / F.col("n")
    f = F.try_divide(ssb / (F.col("k") - 1), F.col("ssw") / (F.col("n") - F.col("k")))
    two = F.col("k") >= 2
    return s.select(
        "k", "n", F.when(two, f).otherwise(0.0).alias("f_stat"),
        F.when(two, F.coalesce(F.try_divide(F.col("b2"), whole["ss"]), F.lit(0.0))).otherwise(0.0).alias("eta_squared"))


def anova_test(df: DataFrame, target: str, cluster: str) -> DataFrame:
    """anova with its p-value: f_stat, p_value, eta_squared."""
    r = anova(df, target, cluster).first()
    p = 1.0 if r["k"] < 2 else f_tail(r["f_stat"], r["k"] - 1, r["n"] - r["k"])
    row = (round(r["f_stat"] or 0.0, 2), round(p, 6), round(r["eta_squared"], 4))
    return df.sparkSession.createDataFrame([row], "f_stat double, p_value double, eta_squared double")


def regime_statistics(df: DataFrame, target: str, features: Sequence[str], cluster: str) -> DataFrame:
    """Joint F statistics of slopes and of intercepts per feature, from
    per-cluster sums: feature, n, k, slope_f, intercept_f (null if degenerate)."""
    whole = df.select(col(cluster).alias("__c"), clean_double(col(target)).alias("__y"),
                      *[clean_double(col(f)).alias(f) for f in features]).dropna()
    y, x = F.col("__y"), F.col("value")
    sums = unpivot_numeric(whole, features, ["__c", "__y"]).groupBy("column", "__c").agg(
        F.count(F.lit(1)).alias("n"), F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"),
        F.sum(x).alias("x1"), F.sum(y).alias("y1"), F.sum(x * x).alias("x2"), F.sum(x * y).alias("xy"), F.sum(y * y).alias("y2"),
        varies(x).alias("moves"))
    total = lambda e: F.sum(e)
    own = F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    back = F.try_divide(F.lit(1.0), F.col("x2"))
    s = sums.groupBy("column").agg(
        total(F.col("n")).alias("n"), F.count(F.lit(1)).alias("k"), F.bool_and("moves").alias("ok"),
        total(F.col("syy") - own).alias("sse1"),
        (total(F.col("syy")) - F.try_divide(total(F.col("sxy")) * total(F.col("sxy")), total(F.col("sxx")))).alias("sse0"),
        total(F.col("n") - F.col("x1") * F.col("x1") * back).alias("a"),
        total(F.col("y1") - F.col("x1") * F.col("xy") * back).alias("b"),
        total(F.col("y2") - F.col("xy") * F.col("xy") * back).alias("c"))
    df2 = F.col("n") - 2 * F.col("k")
    noise = F.col("sse1") / df2
    f_of = lambda sse: F.when(F.col("k") > 1, F.try_divide((sse - F.col("sse1")) / (F.col("k") - 1), noise)).otherwise(0.0)
    kept = s.filter(F.col("ok") & (F.col("n") >= 50) & (df2 > 0))
    return kept.select(F.col("column").alias("feature"), "n", "k", f_of(F.col("sse0")).alias("slope_f"),
                       f_of(F.col("c") - F.try_divide(F.col("b") * F.col("b"), F.col("a"))).alias("intercept_f"))


def regime_tests(df: DataFrame, target: str, features: Sequence[str], cluster: str) -> DataFrame:
    """feature, intercept_p, slope_p, is_regime (slopes differ), f_stat."""
    rows = []
    for r in regime_statistics(df, target, features, cluster).collect():  # one row per feature
        d1, d2 = r["k"] - 1, r["n"] - 2 * r["k"]
        slope = f_tail(r["slope_f"], d1, d2) if d1 else 1.0
        level = f_tail(r["intercept_f"], d1, d2) if d1 else 1.0
        rows.append((r["feature"], round(level, 6), round(slope, 6), slope < 0.05, round(r["slope_f"] or 0.0, 2)))
    return df.sparkSession.createDataFrame(rows, "feature string, intercept_p double, slope_p double, is_regime boolean, f_stat double")


# Linear model

def design(df: DataFrame, target: str, features: Sequence[str], log_target: bool = False, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Complete rows as (keep..., label, features vector) and term names.
    Categories become indicator columns without their first level."""
    cats = set(label_columns(df))
    y = clean_double(col(target))
    y = F.when(y > -1, F.log1p(y)) if log_target else y
    full = df.dropna(subset=[target, *features])
    exprs, names = [], []
    for f in features:
        if f in cats:
            for v in levels_of(full, f)[1:]:
                exprs.append(F.when(col(f) == v, 1.0).otherwise(0.0))
                names.append(f"{f}_{v}")
        else:
            exprs.append(clean_double(col(f)))
            names.append(f)
    cols = [f"__x{i}" for i in range(len(exprs))]
    flat = full.select(*[col(k) for k in keep], y.alias("label"), *[e.alias(c) for e, c in zip(exprs, cols)]).dropna(subset=["label", *cols])
    out = VectorAssembler(inputCols=cols, outputCol="features").transform(flat)
    return out.select(*[col(k) for k in keep], "label", "features"), names


def fit_ols(df: DataFrame, target: str, features: Sequence[str], log_target: bool = False) -> tuple[DataFrame, DataFrame]:
    """Least squares on all rows: (coefficients, fit statistics). A category
    of more levels than columns should have is absorbed by means per level."""
    spark = df.sparkSession
    for f in features:
        if f in set(label_columns(df)) and wide.is_wide(df, f):
            return wide.fit_absorbed(df, target, features, f, log_target)
    data, names = design(df, target, features, log_target)
    model = LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(data)
    s = model.summary
    n, k = s.numInstances, len(names) + 1
    dof = n - k
    coef = [float(b) for b in (*model.coefficients, model.intercept)]
    try:
        errors = [float(e) for e in s.coefficientStandardErrors]
    except Exception:  # dependent columns have no standard errors
        errors = [None] * k
    reach = t_quantile(0.975, dof) if dof > 0 else math.nan
    rows = []
    for name, b, se in zip([*names, "const"], coef, errors):
        t = b / se if se else None
        rows.append((name, float(b), None if se is None else float(se), t, None if t is None else t_two_sided(t, dof),
                     None if se is None else b - reach * se, None if se is None else b + reach * se))
    coefs = spark.createDataFrame(rows, "feature string, coef double, std_err double, t_stat double, p_value double, ci_lower double, ci_upper double")
    sse = s.meanSquaredError * n
    base = n * (math.log(2 * math.pi) + math.log(sse / n) + 1) if sse > 0 else -math.inf
    fit = spark.createDataFrame([(target, log_target, n, float(s.r2), float(1 - (1 - s.r2) * (n - 1) / dof) if dof > 0 else None,
                                  base + 2 * k, base + k * math.log(n))],
                                "target string, log_target boolean, n_obs bigint, r_squared double, adj_r_squared double, aic double, bic double")
    return coefs, fit


def top_coefficients(coefs: DataFrame, n: int = 20, signed: bool = False) -> DataFrame:
    """Largest coefficients without the constant, by size or by signed value."""
    key = F.col("coef") if signed else F.abs("coef")
    return coefs.filter(F.col("feature") != "const").orderBy(F.desc(key), "feature").limit(n)


def partial_residuals(df: DataFrame, target: str, features: Sequence[str], feature: str, keep: Sequence[str] = (),
                      log_target: bool = False) -> DataFrame:
    """Residuals of target and feature on the other features, for every row.
    For a categorical feature the box statistics of y_resid per level."""
    others = [f for f in features if f != feature]
    is_cat = feature in label_columns(df)
    whole = df.dropna(subset=[target, *features]).withColumn("__f", col(feature))

    def residual(on: str, log: bool, extra: Sequence[str]) -> tuple[DataFrame, Column]:
        data, names = design(whole, on, others, log, extra)
        if not names:
            return data, F.col("label") - data.agg(F.avg("label")).scalar()
        m = LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(data)
        terms = sum((F.lit(float(b)) * F.col("__v")[i] for i, b in enumerate(m.coefficients)), F.lit(float(m.intercept)))
        return data, F.col("label") - terms

    data, y_res = residual(target, log_target, [*keep, "__f"])
    data = data.withColumn("__v", vector_to_array("features"))
    if is_cat:
        return box_stats(data.select(F.col("__f").alias(feature), y_res.alias("y_resid")), [feature], "y_resid")
    # Both residuals are linear in the same design row, so one pass gives both.
    _, x_res = residual("__f", False, [*keep])
    xr = data.select(
        *[col(k) for k in keep], y_res.alias("y_resid"), clean_double(F.col("__f")).alias("label"), "__v")
    return xr.select(*[col(k) for k in keep], x_res.alias("x_resid"), "y_resid")


def local_trend(df: DataFrame, x: str, y: str, points: int = 20, frac: float = 0.3) -> DataFrame:
    """Tricube-weighted local line at x quantiles: grid, x, trend, n.
    Each point reaches as far as the frac of the rows around its quantile."""
    d = df.select(clean_double(col(x)).alias("x"), clean_double(col(y)).alias("y")).dropna()
    return _lines(d, _reaches(d, points, frac), F.lit(1.0))


def _reaches(d: DataFrame, points: int, frac: float) -> Column:
    """Grid points as an array of structs: number, place, reach."""
    ps = [i / points for i in range(points + 1)]
    lo = [min(max(0.0, p - frac / 2), 1 - frac) for p in ps]
    q = quantiles_of(d, "x", [*ps, *lo, *[a + frac for a in lo]])
    m = len(ps)
    return F.array(*[
        F.struct(F.lit(i).alias("grid"), q[i].alias("g"), F.greatest(q[i] - q[m + i], q[2 * m + i] - q[i]).alias("h"))
        for i in range(m)
    ])


def _lines(d: DataFrame, grid: Column, weight: Column) -> DataFrame:
    """Weighted line around each grid point, at the point."""
    near = d.select("x", "y", weight.alias("v"), F.explode(grid).alias("t")).select("x", "y", "v", "t.*").filter(F.abs(F.col("x") - F.col("g")) < F.col("h"))
    u = F.abs(F.col("x") - F.col("g")) / F.col("h")
    w = F.pow(1 - F.pow(u, F.lit(3.0)), F.lit(3.0)) * F.col("v")
    dx = F.col("x") - F.col("g")
    s = near.groupBy("grid", "g").agg(
        F.count(F.lit(1)).alias("n"), F.sum(w).alias("w0"), F.sum(w * dx).alias("w1"), F.sum(w * dx * dx).alias("w2"),
        F.sum(w * F.col("y")).alias("v0"), F.sum(w * dx * F.col("y")).alias("v1"))
    det = F.col("w0") * F.col("w2") - F.col("w1") * F.col("w1")
    line = F.try_divide(F.col("w2") * F.col("v0") - F.col("w1") * F.col("v1"), det)
    return s.select("grid", F.col("g").alias("x"), F.coalesce(line, F.try_divide(F.col("v0"), F.col("w0"))).alias("trend"), "n")


TREND = "grid int, x double, trend double, n bigint"


def robust_trend(df: DataFrame, x: str, y: str, points: int = 20, frac: float = 0.3, rounds: int = 3) -> DataFrame:
    """local_trend without the pull of outliers: grid, x, trend, n.

    Each round takes the residuals of all rows from the trend (between grid
    points by straight lines), their exact median size, and bisquare weights of
    six medians, then fits the lines again. Ends early where the median is 0,
    so the trend meets half of the rows. The driver sees the grid alone.
    """
    spark = df.sparkSession
    d = df.select(clean_double(col(x)).alias("x"), clean_double(col(y)).alias("y")).dropna().persist()
    grid = _reaches(d, points, frac)
    rows = _lines(d, grid, F.lit(1.0)).orderBy("grid").collect()  # points + 1 rows at most
    for _ in range(rounds):
        size = F.abs(F.col("y") - _between([(r["x"], r["trend"]) for r in rows if r["trend"] is not None]))
        middle = quantiles_of(d.select(size.alias("r")), "r", [0.5])[0]
        reach = spark.range(1).select((middle * 6).alias("m")).first()["m"]
        if not reach:
            break
        part = size / reach
        rows = _lines(d, grid, F.when(part < 1, F.pow(1 - part * part, F.lit(2.0))).otherwise(0.0)).orderBy("grid").collect()
    d.unpersist()
    return spark.createDataFrame(rows, TREND)


def _between(marks: list[tuple[float, float]]) -> Column:
    """Straight lines between (x, value) marks, level beyond them."""
    marks = sorted(dict(marks).items())
    if not marks:
        return F.lit(None).cast("double")
    out = F.when(F.col("x") <= marks[0][0], marks[0][1])
    for (a, u), (b, v) in zip(marks, marks[1:]):
        out = out.when(F.col("x") <= b, u + (F.col("x") - a) * ((v - u) / (b - a)))
    return out.otherwise(marks[-1][1])
