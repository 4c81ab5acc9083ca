"""Categories with any number of levels.

A level is a row of a dictionary table (level, position), never a column or a
value on the driver. Linear models absorb the widest category: its block of the
normal equations is diagonal, so it is eliminated by means per level.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import clean_double, col, label_columns
from ..functions.frames import row_index, sized
from ..functions.special import t_quantile, t_two_sided

#: Levels up to which a category becomes indicator columns.
NARROW = 1_000
COEFS = "feature string, coef double, std_err double, t_stat double, p_value double, ci_lower double, ci_upper double"
FIT = "target string, log_target boolean, n_obs bigint, r_squared double, adj_r_squared double, aic double, bic double"


def is_wide(df: DataFrame, c: str) -> bool:
    return df.select(col(c)).filter(col(c).isNotNull()).distinct().limit(NARROW + 1).count() > NARROW


def level_index(df: DataFrame, c: str) -> DataFrame:
    """The dictionary of a column: level, position (1.. in sorted order)."""
    return row_index(df.select(col(c).alias("level")).filter("level is not null").distinct(), [], ["level"], "position")


def one_hot_vector(df: DataFrame, c: str, drop_first: bool = True, out: str | None = None) -> DataFrame:
    """Add a sparse indicator vector of a column with any number of levels.

    Element i stands for sorted level i (without the first one if
    ``drop_first``); null, and the dropped level, are all zeros.
    """
    index = level_index(df, c)
    levels = index.count()
    known = F.pmod(F.col("position") - 2, F.lit(max(levels, 1))) if drop_first else F.col("position") - 1
    size = levels if drop_first else levels + 1  # the last element is the one that is left out
    named = index.select(F.col("level").alias("__l"), known.cast("double").alias("__p"))
    joined = df.join(sized(named, df), col(c) == F.col("__l"), "left").withColumn("__p", F.coalesce("__p", F.lit(max(size - 1, 1) * 1.0)))
    # The encoder only needs the greatest index there can be.
    most = df.sparkSession.createDataFrame([(float(max(size - 1, 1)),)], "__p double")
    made = OneHotEncoder(inputCol="__p", outputCol="__v", dropLast=True).fit(most).transform(joined)
    return made.select(*[col(x) for x in df.columns], F.col("__v").alias(out or f"{c}_vector"))


def fit_absorbed(df: DataFrame, target: str, features: Sequence[str], wide: str, log_target: bool = False) -> tuple[DataFrame, DataFrame]:
    """Least squares with one wide category: (coefficients, fit statistics).

    Rows less the means of their level give the slopes (one aggregate to
    columns squared numbers); effects of levels follow from their means and
    stay a table. The smallest level is the base of the effects.
    """
    from .stats import design, gram, matrix  # they dispatch to this module

    spark, rest = df.sparkSession, [f for f in features if f != wide]
    narrow = [f for f in rest if f in set(label_columns(df))]
    if any(is_wide(df, f) for f in narrow):
        raise ValueError(f"more than one category above {NARROW} levels; group rare values of one first")
    full = df.dropna(subset=[target, *features]).withColumn("__g", col(wide).cast("string"))
    if rest:
        from pyspark.ml.functions import vector_to_array

        data, names = design(full, target, rest, log_target, ["__g"])
        flat = data.select("__g", F.col("label").alias("y"), vector_to_array("features").alias("x"))
        rows = flat.select("__g", "y", *[F.col("x")[i].alias(f"x{i}") for i in range(len(names))])
    else:
        y, names = clean_double(col(target)), []
        rows = full.select("__g", (F.when(y > -1, F.log1p(y)) if log_target else y).alias("y")).dropna()
    p, xs = len(names), [f"x{i}" for i in range(len(names))]
    means = sized(rows.groupBy("__g").agg(F.count(F.lit(1)).alias("m"), *[F.avg(c).alias(f"{c}_m") for c in ("y", *xs)]))
    near = rows.join(means, "__g").select(*[(F.col(c) - F.col(f"{c}_m")).alias(c) for c in (*xs, "y")])
    w = matrix(gram(near, [*xs, "y"]), p + 1, "g")
    whole = rows.agg(F.count(F.lit(1)).alias("n"), (F.var_pop("y") * F.count("y")).alias("sst")).first()
    base = means.orderBy("__g").first()
    levels, n = means.count(), whole["n"]
    if not n:
        return spark.createDataFrame([], COEFS), spark.createDataFrame([], FIT)
    scale = np.sqrt(np.where(np.diag(w)[:p] > 0, np.diag(w)[:p], 1.0))
    scaled = w[:p, :p] / np.outer(scale, scale)
    regular = not p or bool(np.linalg.cond(scaled) < 1e13)
    inv = np.linalg.pinv(scaled, hermitian=True) / np.outer(scale, scale) if p else np.zeros((0, 0))
    slope = inv @ w[:p, p]
    sse, dof = max(float(w[p, p] - slope @ w[:p, p]), 0.0), n - p - levels
    var = sse / dof if dof > 0 and regular else None
    reach = t_quantile(0.975, dof) if dof > 0 else math.nan
    origin = np.array([base[f"{c}_m"] for c in xs])
    first, base_n, base_y, base_g = base["__g"], base["m"], base["y_m"], base["__g"]

    def table(coef: np.ndarray, unscaled: np.ndarray) -> pd.DataFrame:
        """Inference from coefficients and their variances over the noise."""
        out = pd.DataFrame({"coef": coef})
        se = np.sqrt(unscaled * var) if var is not None else np.full(len(out), np.nan)
        t = np.divide(coef, se, out=np.full(len(out), np.nan), where=se > 0)
        out["std_err"], out["t_stat"] = se, t
        out["p_value"] = [t_two_sided(v, dof) if np.isfinite(v) else np.nan for v in t]
        out["ci_lower"], out["ci_upper"] = coef - reach * se, coef + reach * se
        return out

    @F.pandas_udf("coef double, std_err double, t_stat double, p_value double, ci_lower double, ci_upper double")
    def effect(g: pd.Series, m: pd.Series, y: pd.Series, x: pd.Series) -> pd.DataFrame:
        at = np.array(x.tolist(), float).reshape(len(g), p)
        own = (g == base_g).to_numpy()  # the base level gives the constant
        d = np.where(own[:, None], at, at - origin)
        coef = y.to_numpy() - at @ slope - np.where(own, 0.0, base_y - origin @ slope)
        return table(coef, 1 / m.to_numpy() + np.where(own, 0.0, 1 / base_n) + np.einsum("ij,jk,ik->i", d, inv, d))

    x = F.array(*[F.col(f"{c}_m") for c in xs]).cast("array<double>")
    named = F.when(F.col("__g") == first, "const").otherwise(F.concat(F.lit(f"{wide}_"), "__g")).alias("feature")
    effects = means.select(named, effect("__g", "m", "y_m", x).alias("e")).select("feature", "e.*")
    slopes = table(slope, np.diag(inv))
    slopes.insert(0, "feature", names)
    out = spark.createDataFrame(list(slopes.itertuples(index=False, name=None)), COEFS).unionByName(effects)
    out = out.select("feature", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in out.columns[1:]])
    k, sst = p + levels, whole["sst"] or 0.0
    r2 = 1 - sse / sst if sst > 0 else None
    least = n * (math.log(2 * math.pi) + math.log(sse / n) + 1) if sse > 0 else -math.inf
    adjusted = 1 - (1 - r2) * (n - 1) / dof if dof > 0 and r2 is not None else None
    return out, spark.createDataFrame([(target, log_target, n, r2, adjusted, least + 2 * k, least + k * math.log(n))], FIT)
