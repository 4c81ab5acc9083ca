"""Feature steps: derived columns and derived tables; originals are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import clean_double, col, corr, one, rnd, share
from ..functions.frames import group_quantiles, quantiles_of, running_totals, sized, top_values
from .profile import fences


def log1p(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """ln(1 + x); null for x <= -1."""
    return df.withColumn(out or f"log_{c}", F.when(col(c) > -1, F.log1p(clean_double(col(c)))))


def standardise(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population deviation; 0 where the column is constant."""
    stats = one(df, **{f"m{i}": F.avg(clean_double(col(c))) for i, c in enumerate(cols)},
                **{f"s{i}": F.stddev_pop(clean_double(col(c))) for i, c in enumerate(cols)})
    return df.select("*", *[
        ((clean_double(col(c)) - stats[f"m{i}"])
         / F.when(stats[f"s{i}"] > 0, stats[f"s{i}"]).otherwise(1.0)).alias(f"{c}{suffix}")
        for i, c in enumerate(cols)
    ])


def clip(df: DataFrame, c: str, lower: float | None = None, upper: float | None = None, out: str | None = None) -> DataFrame:
    """Clip to quantiles (lower, upper) or, without them, to the IQR fences."""
    if lower is None and upper is None:
        f = F.element_at(fences(df, [c]), F.lit(c))
        lo, hi = f["lo"], f["hi"]
    else:
        q = quantiles_of(df, c, [lower or 0.0, 1.0 if upper is None else upper])
        lo, hi = q[0], q[1]
    x = clean_double(col(c))
    return df.withColumn(out or f"{c}_clip", F.when(x.isNotNull(), F.greatest(F.least(x, hi), lo)))


def ratio(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    return df.withColumn(out, F.try_divide(col(a).cast("double"), col(b).cast("double")))


def edge_labels(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """labels[i] for edges[i] <= x < edges[i+1]; open at both ends."""
    expr = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        expr = F.when(x < edge, label).otherwise(expr)
    return F.when(x.isNotNull(), expr)


def width_bin(x: Column, lo: Column, hi: Column, bins) -> Column:
    """1-based equal-width bin, left-closed, last bin closed on both sides."""
    n = bins if isinstance(bins, Column) else F.lit(bins)
    raw = F.floor(F.try_divide(x - lo, hi - lo) * n) + 1
    return F.when(x.isNotNull(), F.coalesce(F.least(raw, n.cast("bigint")), F.lit(1).cast("bigint"))).cast("int")


def quantile_bin(x: Column, edges: Column, count: int) -> Column:
    """1-based bin between distinct edges, right-closed, lowest value included.
    ``edges`` is a sorted array of ``count`` values."""
    passed = F.lit(0)
    for i in range(count):
        new = F.lit(True) if i == 0 else edges[i] > edges[i - 1]
        passed = passed + F.when(new & (edges[i] < x), 1).otherwise(0)
    return F.when(x.isNotNull(), F.greatest(passed, F.lit(1)))


def bins(df: DataFrame, c: str, *, edges: Sequence[float] | None = None, labels: Sequence[str] | None = None,
         width: int | None = None, quantiles: int | None = None, out: str | None = None) -> DataFrame:
    x = clean_double(col(c))
    if edges is not None:
        return df.withColumn(out or f"{c}_bucket", edge_labels(x, edges, labels))
    if width is not None:
        s = one(df, lo=F.min(x), hi=F.max(x))
        return df.withColumn(out or f"{c}_bin", width_bin(x, s["lo"], s["hi"], width))
    e = quantiles_of(df, c, [i / quantiles for i in range(quantiles + 1)])
    return df.withColumn(out or f"{c}_qbin", quantile_bin(x, e, quantiles + 1))


def time_parts(df: DataFrame, c: str) -> DataFrame:
    d = col(c)
    return df.select("*", F.year(d).alias("year"), F.month(d).alias("month"),
                     F.quarter(d).alias("quarter"), F.weekday(d).alias("weekday"))


def interaction(df: DataFrame, a: str, b: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{a}_x_{b}", col(a).cast("double") * col(b).cast("double"))


def category_interactions(df: DataFrame, x: str, c: str, levels: Sequence[str]) -> DataFrame:
    return df.select("*", *[
        F.when(col(c) == v, col(x).cast("double")).otherwise(0.0).alias(f"{x}_x_{v}") for v in levels
    ])


def group_index(df: DataFrame, group: str, value: str, out: str = "group_index") -> DataFrame:
    """Group median over whole-table median, joined back to every row."""
    g = group_quantiles(df, [group], value, [0.5]).select(col(group).alias("__g"), F.col("q")[0].alias("__m"))
    overall = quantiles_of(df, value, [0.5])[0]
    return df.join(sized(g, df), col(group) == F.col("__g"), "left").select(
        *[col(c) for c in df.columns], F.try_divide(F.col("__m"), overall).alias(out)
    )


def flag_in(df: DataFrame, c: str, values: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(col(c).isin(*values), F.lit(False)).cast("int"))


def flag_contains(df: DataFrame, c: str, text: str, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.contains(col(c), F.lit(text)), F.lit(False)).cast("int"))


def levels_of(df: DataFrame, c: str, limit: int = 1000) -> list:
    """Sorted distinct values; refuses a column too wide to become columns."""
    found = [r[0] for r in df.select(col(c)).filter(col(c).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{c} has more than {limit} levels; group rare values first")
    return sorted(found)


def one_hot(df: DataFrame, c: str, drop_first: bool = True, keep: bool = True) -> DataFrame:
    levels = levels_of(df, c)[1 if drop_first else 0:]
    base = df if keep else df.drop(c)
    cols = [F.when(col(c) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in levels]
    return df.select(*[col(x) for x in base.columns], *cols)


def frequency(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    counts = df.groupBy(col(c).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return df.join(sized(counts, df), col(c) == F.col("__v"), "left").select(
        *[col(x) for x in df.columns], F.col("__n").alias(out or f"{c}_freq")
    )


def group_rare(df: DataFrame, c: str, keep: int, other: str = "(other)", out: str | None = None) -> DataFrame:
    """Values outside the ``keep`` most frequent ones become one value."""
    top = F.broadcast(top_values(df, c, keep).select(F.col("value").alias("__v")))  # at most ``keep`` rows
    named = F.when(col(c).isNull(), F.lit(None)).otherwise(F.coalesce(F.col("__v"), F.lit(other)))
    joined = df.join(top, col(c) == F.col("__v"), "left")
    rest = [x for x in df.columns if x != (out or c)]
    return joined.select(*[col(x) for x in rest], named.alias(out or c))


def segment_pivot(df: DataFrame, rows: str, columns: str, value: str, levels: Sequence | None = None) -> DataFrame:
    p = df.groupBy(rows).pivot(columns, list(levels)) if levels else df.groupBy(rows).pivot(columns)
    return p.agg(F.avg(value))


def merge_group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and deviation per group on every row, pre-aggregated then joined."""
    g = df.groupBy(col(group).alias("__g")).agg(
        F.avg(value).alias(f"{value}_mean"), F.stddev_samp(value).alias(f"{value}_std"))
    return df.join(sized(g, df), col(group) == F.col("__g"), "left").drop("__g")


def period_change(series: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Change to the previous period. ``series`` is aggregated: one row per period."""
    w = Window.partitionBy(*by, F.lit(1)).orderBy(period)
    prev = F.lag(value).over(w)
    return series.select(*by, period, value, prev.alias("previous"), (F.col(value) - prev).alias("change"),
                         F.try_divide(F.col(value) - prev, prev).alias("change_share"))


def seasonal_decompose(series: DataFrame, period: str, value: str, season: Column, length: int,
                       by: Sequence[str] = ()) -> DataFrame:
    """Additive trend (centred mean), seasonal part and remainder of an
    aggregated series. Trend is null where the centred frame is incomplete."""
    half = length // 2
    o = Window.partitionBy(*by, F.lit(1)).orderBy(period)
    wide = o.rowsBetween(-half, half)
    if length % 2:
        total, weight = F.sum(value).over(wide), float(length)
    else:
        # Even length: both ends count half.
        total = (F.sum(value).over(wide) + F.sum(value).over(o.rowsBetween(-half + 1, half - 1))) / 2
        weight = float(length)
    trend = F.when(F.count(F.lit(1)).over(wide) == 2 * half + 1, total / weight)
    t = series.select(*by, period, value, season.alias("season"), trend.alias("trend"))
    t = t.withColumn("__d", F.col(value) - F.col("trend"))
    t = t.withColumn("__s", F.avg("__d").over(Window.partitionBy(*by, "season")))
    # Seasonal means are centred over the seasons that occur.
    per_season = t.groupBy(*by, "season").agg(F.first("__s").alias("__s0"))
    centre = per_season.groupBy(*by).agg(F.avg("__s0").alias("__c")) if by else None
    if by:
        t = t.join(centre, list(by))
        mid = F.col("__c")
    else:
        mid = per_season.agg(F.avg("__s0").alias("c")).scalar()
    seasonal = F.col("__s") - mid
    return t.select(*by, period, value, "season", "trend", seasonal.alias("seasonal"),
                    (F.col("__d") - seasonal).alias("remainder"))


def corr_by_segment(df: DataFrame, segment: str, x: str, y: str) -> DataFrame:
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), corr(col(y), col(x)).alias("r"))


def ks_two_sample(df: DataFrame, segment: str, a, b, value: str, one_pass: bool | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance: n_a, n_b, ks."""
    v = clean_double(col(value))
    counts = (
        df.filter(col(segment).isin(a, b) & v.isNotNull()).groupBy(v.alias("v"))
        .agg(F.count_if(col(segment) == a).alias("ca"), F.count_if(col(segment) == b).alias("cb"))
    )
    run = running_totals(counts, "v", {"ra": "ca", "rb": "cb"}, one_pass=one_pass)
    gap = run.agg(F.sum("ca").alias("n_a"), F.sum("cb").alias("n_b"))
    sizes = one(counts, na=F.sum("ca"), nb=F.sum("cb"))
    d = F.abs(F.try_divide(F.col("ra").cast("double"), sizes["na"].cast("double"))
              - F.try_divide(F.col("rb").cast("double"), sizes["nb"].cast("double")))
    return run.agg(F.coalesce(F.sum("ca"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("cb"), F.lit(0)).alias("n_b"),
                   F.max(d).alias("ks"))


def class_imbalance(df: DataFrame, c: str) -> DataFrame:
    """Share per class, largest share and its severity flag."""
    counts = df.filter(col(c).isNotNull()).groupBy(col(c).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    s = one(counts, total=F.sum("n"), top=F.max("n"))
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    top = share(s["top"], rows)
    flag = F.when(top > 0.8, "severe_imbalance").when(top > 0.5, "moderate_imbalance").otherwise("balanced")
    return counts.select("class", "n", share(F.col("n"), s["total"], 6).alias("share"),
                         rnd(top, 6).alias("top_share"), flag.alias("flag"))
