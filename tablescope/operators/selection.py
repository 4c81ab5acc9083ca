"""Staged feature selection, cheap to expensive.

Each stage is one aggregate over the surviving columns; the decisions are one
row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.exprs import clean_double, col, corr, numeric_columns, rnd, temporal_columns
from ..functions.frames import column_quantiles, per_column, unpivot_numeric, unpivot_text
from .profile import correlation_pairs, distinct_counts

MAX_CLASSES = 20


def stage1(df: DataFrame, target: str | None = None, missing: float = 0.7, deviation: float = 0.001, unique: float = 0.95) -> DataFrame:
    """Cheap pruning: column, kept, reason (first rule that fires)."""
    nums = numeric_columns(df)
    d = distinct_counts(df, df.columns)
    if nums:
        d = d.join(per_column(df, nums, {"std": F.stddev_samp("value")}).withColumn("num", F.lit(True)), "column", "left")
    else:
        d = d.select("*", F.lit(None).cast("double").alias("std"), F.lit(False).alias("num"))
    rows = F.greatest(F.col("row_count"), F.lit(1)).cast("double")
    miss, ratio = F.col("null_count") / rows, F.col("unique_count") / rows
    num = F.coalesce("num", F.lit(False))
    reason = (
        F.when(F.col("column") == F.lit(target), None)
        .when(miss > missing, F.format_string("missing %.0f%%", miss * 100))
        .when(num & (F.col("std") < deviation), F.format_string("near-zero variance (std=%.6f)", F.col("std")))
        .when(~num & (ratio > unique), F.format_string("ID-like column (unique ratio=%.2f)", ratio))
        .when(F.col("unique_count") <= 1, "constant (1 unique value)")
    )
    return d.select("column", reason.isNull().alias("kept"), reason.alias("reason"))


def average_linkage(dist: np.ndarray, cut: float) -> list[int]:
    """Group number per item; groups merge while their mean distance <= cut."""
    groups = [[i] for i in range(len(dist))]
    while len(groups) > 1:
        gaps = [(dist[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        gap, i, j = min(gaps)
        if gap > cut:
            break
        groups[i] += groups.pop(j)
    label = {m: n for n, g in enumerate(sorted(groups, key=min), 1) for m in g}
    return [label[i] for i in range(len(dist))]


def stage2(df: DataFrame, survivors: Sequence[str], threshold: float = 0.85, target: str | None = None) -> DataFrame:
    """One column per correlated group: column, cluster, kept, reason. A target
    is in no group: it stays and drops nothing."""
    nums = [c for c in survivors if c in set(numeric_columns(df)) and c != target]
    schema = "column string, cluster int, kept boolean, reason string"
    spark = df.sparkSession
    others = [(c, None, True, None) for c in survivors if c not in nums]
    if len(nums) <= 1:
        return spark.createDataFrame(others + [(c, None, True, None) for c in nums], schema)
    dist = np.ones((len(nums), len(nums)))
    np.fill_diagonal(dist, 0.0)
    for r in correlation_pairs(df, nums, digits=None).collect():  # one row per column pair
        dist[r["i"], r["j"]] = dist[r["j"], r["i"]] = 1 - abs(r["r"] or 0.0)
    labels = average_linkage(dist, 1 - threshold)
    v = F.col("value")
    stats = {r["column"]: r for r in per_column(df, nums, {
        "var": F.coalesce(F.var_samp(v), F.lit(0.0)), "miss": F.count_if(v.isNull()) / F.count(F.lit(1))}).collect()}
    best: dict[int, str] = {}
    # Falling: variance, completeness, brevity, name.
    rank = lambda c: (stats[c]["var"], -stats[c]["miss"], -len(c), c)
    for c, g in zip(nums, labels):
        if g not in best or rank(c) > rank(best[g]):
            best[g] = c
    rows = [(c, g, best[g] == c, None if best[g] == c else f"correlated with {best[g]} (cluster {g})") for c, g in zip(nums, labels)]
    return spark.createDataFrame(others + rows, schema)


def stage3(df: DataFrame, survivors: Sequence[str], target: str | None = None, threshold: float = 0.95, alpha: float = 1.0) -> DataFrame:
    """Redundancy: column, predictability_r2 (ridge on the others), kept, reason."""
    nums = [c for c in survivors if c in set(numeric_columns(df)) and c != target]
    rest = [(c, None, True, None) for c in survivors if c not in nums]
    schema = "column string, predictability_r2 double, kept boolean, reason string"
    if len(nums) <= 2:
        return df.sparkSession.createDataFrame(rest + [(c, None, True, None) for c in nums], schema)
    filled = df.select(*[F.coalesce(clean_double(col(c)), F.lit(0.0)).alias(c) for c in nums])
    n = filled.count()
    c = np.eye(len(nums))
    for r in correlation_pairs(filled, nums, digits=None).collect():
        c[r["i"], r["j"]] = c[r["j"], r["i"]] = r["r"] or 0.0
    rows = []
    for i, name in enumerate(nums):
        o = [j for j in range(len(nums)) if j != i]
        cx, cy = c[np.ix_(o, o)], c[o, i]
        b = np.linalg.solve(n * cx + alpha * np.eye(len(o)), n * cy)
        r2 = round(float(2 * b @ cy - b @ cx @ b), 4)
        gone = r2 > threshold
        rows.append((name, r2, not gone, f"redundant (R²={r2:.3f} from other features)" if gone else None))
    return df.sparkSession.createDataFrame(rest + rows, schema)


def _bin(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed quantile bin number for literal distinct edges."""
    n = sum((F.when(x > e, 1).otherwise(0) for e in sorted(set(edges))[:-1]), F.lit(0))
    return F.greatest(n, F.lit(1))


def is_classify(df: DataFrame, target: str) -> bool:
    return df.select(col(target)).filter(col(target).isNotNull()).distinct().limit(MAX_CLASSES + 1).count() <= MAX_CLASSES


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 10, classify: bool | None = None) -> DataFrame:
    """Plug-in mutual information (nats) of binned features with the target,
    nulls of a feature counted as zero: feature, mutual_info."""
    classify = is_classify(df, target) if classify is None else classify
    filled = df.filter(col(target).isNotNull()).select(
        *[F.coalesce(clean_double(col(f)), F.lit(0.0)).alias(f"f{i}") for i, f in enumerate(features)],
        col(target).cast("string" if classify else "double").alias("t"))
    cols = [f"f{i}" for i in range(len(features))]
    probs = [i / bins for i in range(bins + 1)]
    # bins + 1 numbers per column.
    edges = {r["column"]: r["q"] or [0.0] for r in column_quantiles(filled, cols + ([] if classify else ["t"]), probs).collect()}
    t = F.col("t") if classify else _bin(F.col("t"), edges["t"])
    binned = filled.select(t.cast("string").alias("t"), *[_bin(F.col(c), edges[c]).alias(c) for c in cols])
    joint = unpivot_text(binned, cols, ["t"]).groupBy("column", "value", "t").agg(F.count(F.lit(1)).alias("n"))
    # Windows over bins x classes counts.
    n = F.col("n").cast("double")
    nx = F.sum("n").over(Window.partitionBy("column", "value"))
    nt = F.sum("n").over(Window.partitionBy("column", "t"))
    all_ = F.sum("n").over(Window.partitionBy("column"))
    part = joint.select("column", (n / all_ * F.ln(n * all_ / (nx * nt))).alias("p"))
    names = F.array(*[F.lit(f) for f in features])
    return part.groupBy("column").agg(F.sum("p").alias("p")).select(
        F.element_at(names, F.substring("column", 2, 9).cast("int") + 1).alias("feature"), rnd(F.greatest(F.col("p"), F.lit(0.0)), 4).alias("mutual_info"))


def stage4(df: DataFrame, survivors: Sequence[str], target: str, drop_lowest: int = 0) -> DataFrame:
    """Scores: column, mutual_info, target_corr, kept. Only the drop_lowest
    numeric features by information are dropped; others get null scores."""
    spark = df.sparkSession
    nums = [c for c in survivors if c != target and c in set(numeric_columns(df))]
    others = [c for c in survivors if c not in nums and c != target]
    schema = "column string, mutual_info double, target_corr double, kept boolean"
    plain = spark.createDataFrame([(c, None, None, True) for c in others], schema)
    if not nums:
        return plain
    mi = mutual_information(df, nums, target).withColumnRenamed("feature", "column")
    y = clean_double(col(target)) if target in numeric_columns(df) else F.lit(None).cast("double")
    filled = df.select(y.alias("__y"), *[F.coalesce(clean_double(col(c)), F.lit(0.0)).alias(c) for c in nums])
    r = unpivot_numeric(filled, nums, ["__y"]).groupBy("column").agg(rnd(F.coalesce(F.abs(corr(F.col("__y"), F.col("value"))), F.lit(0.0)), 4).alias("target_corr"))
    scored = mi.join(r, "column")
    low = [x["column"] for x in scored.orderBy("mutual_info", "column").limit(drop_lowest).collect()] if drop_lowest else []
    return scored.select("column", "mutual_info", "target_corr", (~F.col("column").isin(low)).alias("kept") if low else F.lit(True).alias("kept")).unionByName(plain)


def stage6(df: DataFrame, survivors: Sequence[str]) -> DataFrame:
    """Columns kept for charts: column, reason."""
    times = [c for c in survivors if c in temporal_columns(df)]
    texts = [c for c in survivors if isinstance(df.schema[c].dataType, T.StringType)]
    d = distinct_counts(df, [*times, *texts]) if times or texts else df.sparkSession.createDataFrame([], "column string, unique_count bigint")
    is_time = F.col("column").isin(times) if times else F.lit(False)
    reason = F.when(is_time, "datetime — time series charts").when(
        F.col("unique_count").between(2, 30), F.format_string("categorical (%d values) — segmentation/faceting", F.col("unique_count")))
    return d.select("column", reason.alias("reason")).filter(F.col("reason").isNotNull())
