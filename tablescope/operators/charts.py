"""The aggregate table behind each chart; drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exprs import clean_double, col, corr, numeric_columns, one, other_columns, rnd, share, skew_g1
from ..functions.frames import (
    column_quantiles, group_quantiles, keep_top, per_column, quantiles_of, sized, top_values, unpivot_numeric,
    unpivot_text, value_counts,
)
from .features import group_rare, quantile_bin, width_bin
from .profile import correlation_pairs, distinct_counts


def histogram(df: DataFrame, cols: Sequence[str], bins: Column | int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width counts per column (and group): left-closed bins, last one
    closed. Default bin number: n // 20 within 10 and 30. Empty bins are kept."""
    by = list(by)
    v = F.col("value")
    stats = per_column(df, cols, {"n_values": F.count(v), "mn": F.min(v), "mx": F.max(v)}, by)
    n_bins = F.lit(bins) if isinstance(bins, int) else F.least(
        F.lit(30), F.greatest(F.lit(10), F.floor(F.col("n_values") / 20))).cast("int")
    flat = F.col("mn") == F.col("mx")
    stats = stats.filter(F.col("n_values") > 0).select(
        *by, "column", "n_values", n_bins.alias("bins"),
        F.when(flat, F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(flat, F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"),
    )
    keys = [*by, "column"]
    stats = sized(stats, df)
    counts = (
        unpivot_numeric(df, cols, by).filter(v.isNotNull()).join(stats, keys)
        .groupBy(*keys, width_bin(v, F.col("lo"), F.col("hi"), F.col("bins")).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    frame = stats.select("*", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    return frame.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_lo"),
        (F.col("lo") + width * F.col("bin")).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "n_values",
    )


def histogram_data(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Histogram of each numeric column with its median and skewness."""
    cols = list(cols or numeric_columns(df))
    shape = per_column(df, cols, {"skew": skew_g1(F.col("value"))}).join(
        column_quantiles(df, cols, [0.5]).select("column", F.col("q")[0].alias("median")), "column")
    return histogram(df, cols).join(shape, "column").drop("n_values")


def category_bars(df: DataFrame, n: int = 8, cols: Sequence[str] | None = None) -> DataFrame:
    """Top n values of the columns with 2 to 200 distinct values."""
    cols = list(cols or other_columns(df))
    vc = value_counts(df, cols).filter(F.col("value").isNotNull())
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    top = vc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    width = vc.groupBy("column").agg(F.count(F.lit(1)).alias("k"))
    return top.join(width.filter(F.col("k").between(2, 200)), "column").select(
        "column", "rank", "value", F.col("n").alias("count"))


def category_cumsum(df: DataFrame, n: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """Share and running share of the top n values and '(k others)'."""
    cols = list(cols or other_columns(df))
    vc = value_counts(df, cols).filter(F.col("value").isNotNull())
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    top = vc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    whole = vc.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total")).filter(F.col("k") > 1)
    rest = (
        top.groupBy("column").agg(F.sum("n").alias("shown")).join(whole, "column").filter(F.col("k") > n)
        .select("column", F.lit(n + 1).alias("rank"), (F.col("total") - F.col("shown")).alias("n"),
                F.concat(F.lit("("), (F.col("k") - n).cast("string"), F.lit(" others)")).alias("label"))
    )
    rows = top.select("column", "rank", "n", F.substring("value", 1, 20).alias("label")).unionByName(rest)
    pct = F.try_divide(F.col("n") * 100.0, F.col("total"))
    # Windows over at most n + 1 rows per column.
    run = Window.partitionBy("column").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    whole_col = Window.partitionBy("column")
    return rows.join(whole, "column").select(
        "column", "rank", "label", F.col("n").alias("count"), F.col("k").alias("unique"),
        rnd(pct, 6).alias("pct"), rnd(F.sum(pct).over(run), 6).alias("cum_pct"),
        rnd(F.sum(F.when(F.col("rank") <= 1, pct)).over(whole_col), 6).alias("top1_pct"),
        rnd(F.sum(F.when(F.col("rank") <= 3, pct)).over(whole_col), 6).alias("top3_pct"),
    )


def hash_percent(*cols: str) -> Column:
    """0..99 from the row's identity: the same row always gets the same number."""
    text = F.concat_ws("|", *[col(c).cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def missing_map(df: DataFrame) -> DataFrame:
    """column, null_pct of every column."""
    v = F.col("value")
    s = per_column(df, df.columns, {"nulls": F.count_if(v.isNull()), "rows": F.count(F.lit(1))}, text=True)
    return s.select("column", share(F.col("nulls"), F.col("rows"), 1, 100).alias("null_pct"))


def missing_sample(df: DataFrame, id_cols: Sequence[str], percent: int = 15) -> DataFrame:
    """Null indicators of the 15 % row sample that the map draws; all rows
    of a table of at most 200."""
    small = df.agg(F.count(F.lit(1)).alias("n")).scalar() <= 200
    rest = [c for c in df.columns if c not in id_cols]
    return df.filter(small | (hash_percent(*id_cols) < percent)).select(
        *[col(c) for c in id_cols], *[col(c).isNull().alias(c) for c in rest])


def top_correlations(df: DataFrame, n: int = 5) -> DataFrame:
    return (
        correlation_pairs(df, digits=None).filter(F.col("r").isNotNull())
        .select("col_a", "col_b", rnd(F.col("r"), 6).alias("r"))
        .orderBy(F.desc(F.abs("r")), "col_a", "col_b").limit(n)
    )


def box_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """n, q1, median, q3 and whiskers (last value within 1.5 IQR) per group."""
    by = list(by)
    q = group_quantiles(df, by, value, [0.25, 0.5, 0.75])
    iqr = F.col("q")[2] - F.col("q")[0]
    q = q.select(*by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
                 (F.col("q")[0] - 1.5 * iqr).alias("__lo"), (F.col("q")[2] + 1.5 * iqr).alias("__hi"))
    v = clean_double(col(value))
    inside = v.between(F.col("__lo"), F.col("__hi"))
    keys = [*by, "n", "q1", "median", "q3"]
    # Combined per group before the shuffle, so a hot group costs no more.
    return df.select(*[col(b) for b in by], col(value)).join(sized(q, df), by).groupBy(*keys).agg(
        F.min(F.when(inside, v)).alias("__a"), F.max(F.when(inside, v)).alias("__b"),
    ).select(*keys, F.least("q1", "__a").alias("whisker_lo"), F.greatest("q3", "__b").alias("whisker_hi"))


def box_stats_by_category(df: DataFrame, value: str, category: str, n: int = 10) -> DataFrame:
    return box_stats(keep_top(df, category, n), [category], value)


def faceted_box(df: DataFrame, value: str, group: str, hue: str, groups: int = 10, hues: int = 5) -> DataFrame:
    both = keep_top(df, group, groups).join(
        F.broadcast(top_values(df, hue, hues).select(F.col("value").alias("__h"))), col(hue) == F.col("__h"), "left_semi")
    return box_stats(both, [group, hue], value)


def auto_box_target(df: DataFrame) -> DataFrame:
    """Numeric column of largest deviation, category with most groups (2..30)."""
    nums, cats = numeric_columns(df), other_columns(df)
    place = {c: i for i, c in enumerate(df.columns)}
    order = F.element_at(F.create_map(*[F.lit(x) for kv in place.items() for x in kv]), F.col("column"))
    std = per_column(df, nums, {"s": F.stddev_samp("value")})
    target = std.agg(F.max_by("column", F.when(F.col("s").isNotNull(), F.struct("s", (-order).alias("o")))).alias("t")).scalar()
    wide = distinct_counts(df, cats).filter(F.col("unique_count").between(2, 30))
    grouper = wide.agg(F.max_by("column", F.struct("unique_count", (-order).alias("o"))).alias("g")).scalar()
    return df.sparkSession.range(1).select(target.alias("target"), grouper.alias("grouper"))


def ts_by_category(df: DataFrame, date: str, value: str, category: str, agg: str = "mean", n: int = 10) -> DataFrame:
    top = keep_top(df, category, n)
    if agg == "median":
        return group_quantiles(top, [date, category], value, [0.5]).select(date, category, F.col("q")[0].alias("value"))
    return top.groupBy(date, category).agg(getattr(F, agg)(value).alias("value"))


def ts_monthly(df: DataFrame, date: str, value: str, category: str, agg: str = "median", n: int = 10) -> DataFrame:
    m = df.select(F.trunc(col(date), "month").alias("month"), col(category), col(value))
    return ts_by_category(m, "month", value, category, agg, n)


def seasonality_stats(df: DataFrame, date: str, value: str, period: str = "month") -> DataFrame:
    """Box statistics per true month (1..12), weekday (Mon = 0) or quarter."""
    part = {"month": F.month, "weekday": F.weekday}.get(period, F.quarter)(col(date))
    return box_stats(df.select(part.alias("period"), col(value)), ["period"], value)


def stacked_share(df: DataFrame, date: str, value: str, category: str, n: int = 8) -> DataFrame:
    """Count and share (%) per date of the top n categories, zero-filled."""
    cats = [r["value"] for r in top_values(df, category, n).collect()]  # at most n values
    counts = df.filter(col(category).isin(cats)).groupBy(col(date)).pivot(category, cats).agg(F.count(col(value)))
    zero = F.lit(0).cast("bigint")
    filled = counts.select(col(date), *[F.coalesce(col(str(c)), zero).alias(f"__{i}") for i, c in enumerate(cats)])
    total = sum((F.col(f"__{i}") for i in range(len(cats))), zero)
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"__{i}").alias("n")) for i, c in enumerate(cats)])
    return filled.select(col(date), total.alias("t"), F.explode(cells).alias("x")).select(
        date, F.col("x.c").alias(category), F.col("x.n").alias("n"), share(F.col("x.n"), F.col("t"), 6, 100).alias("share"))


def binned_scatter(df: DataFrame, x: str, y: str, n_bins: int = 25, min_count: int = 5) -> DataFrame:
    """median, mean, std and count of y in right-closed equal-width x bins."""
    both = df.select(clean_double(col(x)).alias("x"), clean_double(col(y)).alias("y")).dropna()
    s = one(both, lo=F.min("x"), hi=F.max("x"))
    width = (s["hi"] - s["lo"]) / n_bins
    bin_no = F.greatest(F.lit(1), F.least(F.lit(n_bins), F.coalesce(
        F.ceil(F.try_divide(F.col("x") - s["lo"], width)), F.lit(1)))).cast("int")
    b = both.select(bin_no.alias("bin"), "y")
    stats = b.groupBy("bin").agg(F.avg("y").alias("mean"), F.stddev_samp("y").alias("std"), F.count("y").alias("n"))
    med = group_quantiles(b, ["bin"], "y", [0.5]).select("bin", F.col("q")[0].alias("median"))
    return stats.filter(F.col("n") >= min_count).join(med, "bin").select(
        "bin", (s["lo"] + width * (F.col("bin") - 0.5)).alias("mid"), "median", "mean", "std", "n")


def range_gradient(df: DataFrame, label: str, value: str) -> DataFrame:
    """Median per range label with the leading number as sort key."""
    return group_quantiles(df, [label], value, [0.5]).select(
        label, F.split(col(label), " ")[0].try_cast("int").alias("sort_key"), F.col("q")[0].alias("median"), "n")


def variance_decomposition(df: DataFrame, target: str, factors: Sequence[str], bins: int = 10) -> DataFrame:
    """Share of the target's variance carried by the group means per factor;
    numeric factors are cut into quantile bins."""
    nums = set(numeric_columns(df))
    y = clean_double(col(target))
    probs, cuts = [i / bins for i in range(bins + 1)], [f for f in factors if f in nums]
    # The edges of all factors come from one job.
    found = {r["column"]: r["q"] for r in column_quantiles(df, cuts, probs).collect()} if cuts else {}
    edges = {f: F.array(*[F.lit(x).cast("double") for x in found.get(f) or [None] * len(probs)]) for f in cuts}
    cut = df.select(y.alias("__y"), *[
        quantile_bin(clean_double(col(f)), edges[f], bins + 1).alias(f)
        if f in nums else col(f) for f in factors
    ])
    g = (
        unpivot_text(cut, factors, ["__y"]).filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("m"))
        .filter(F.col("m").isNotNull())
    )
    s = one(cut, mu=F.avg("__y"), v=F.var_samp("__y"))
    d, n = F.col("m") - s["mu"], F.sum("n")
    between = (F.sum(F.col("n") * d * d) - F.sum(F.col("n") * d) * F.sum(F.col("n") * d) / n) / (n - 1)
    return g.groupBy("column").agg(F.least(F.lit(1.0), rnd(F.try_divide(between, s["v"]), 4)).alias("explained")).select(
        F.col("column").alias("factor"), "explained")


def cluster_histograms(df: DataFrame, cluster: str, cols: Sequence[str], bins: int = 40) -> DataFrame:
    """Histogram per cluster and feature, noise (negative label) left out."""
    return histogram(df.filter(col(cluster) >= 0), cols, bins, [cluster])


def cluster_radar(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Mean of the standardised features per cluster; needs three features."""
    if len(cols) < 3:
        return df.sparkSession.createDataFrame([], f"{cluster} int, column string, z_mean double")
    kept = df.filter(col(cluster) >= 0)
    v = F.col("value")
    whole = per_column(kept, cols, {"mu": F.avg(v), "sd": F.stddev_pop(v)})
    groups = per_column(kept, cols, {"m": F.avg(v)}, [cluster])
    scale = F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
    return groups.join(whole, "column").select(cluster, "column", rnd((F.col("m") - F.col("mu")) / scale, 6).alias("z_mean"))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.filter(col(cluster) >= 0).select(cluster, "n", share(F.col("n"), total, 6).alias("share"))


def target_corr_rank(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    long = unpivot_numeric(df, cols, [target])
    r = F.abs(corr(clean_double(col(target)), F.col("value")))
    return long.groupBy("column").agg(rnd(r, 6).alias("abs_r"))


def interaction_lines(df: DataFrame, x: str, y: str, group: str, n_groups: int = 4, log_target: bool = True,
                      max_bins: int = 20, min_rows: int = 30) -> DataFrame:
    """Median of (log) y over quantile bins of x, one line per group.

    A numeric group is cut into quantile bins, a category keeps its n_groups
    most frequent values. Groups under min_rows are left out; a group with
    fewer than max_bins distinct x gets that many bins.
    """
    d = df.select(col(x).alias("__x0"), col(y).alias("__y0"), col(group).alias("__g0")).dropna()
    if group in numeric_columns(df):
        e = quantiles_of(d, "__g0", [i / n_groups for i in range(n_groups + 1)])
        d = d.withColumn("grp", F.concat(F.lit("Q"), quantile_bin(clean_double(F.col("__g0")), e, n_groups + 1).cast("string")))
    else:
        d = group_rare(d, "__g0", n_groups, out="grp")
    xv, yv = clean_double(F.col("__x0")), clean_double(F.col("__y0"))
    d = d.select("grp", xv.alias("x"), (F.when(yv > -1, F.log1p(yv)) if log_target else yv).alias("y"))
    probs = [i / max_bins for i in range(max_bins + 1)]
    edges = group_quantiles(d, ["grp"], "x", probs).filter(F.col("n") >= min_rows)
    few = _few_value_edges(d, max_bins)
    edges = edges.join(few, "grp", "left").select("grp", F.coalesce("few", "q").alias("edges"))
    b = d.join(sized(edges, d), "grp")
    e = F.array_distinct("edges")
    bin_no = F.greatest(F.size(F.filter(e, lambda v: v < F.col("x"))), F.lit(1))
    b = b.select("grp", bin_no.alias("bin"), ((e[bin_no - 1] + F.try_element_at(e, bin_no + 1)) / 2).alias("x_mid"), "y")
    return group_quantiles(b, ["grp", "bin", "x_mid"], "y", [0.5]).select("grp", "bin", "x_mid", F.col("q")[0].alias("median_y"), "n")


def _few_value_edges(d: DataFrame, max_bins: int) -> DataFrame:
    """Quantile edges of the groups with fewer than max_bins distinct x."""
    vals = d.groupBy("grp", "x").agg(F.count(F.lit(1)).alias("m"))
    w = Window.partitionBy("grp").orderBy("x")
    # Only max_bins values per group leave each task.
    first = vals.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= max_bins)
    small = first.groupBy("grp").agg(
        F.count(F.lit(1)).alias("k"), F.sum("m").alias("n"),
        F.array_sort(F.collect_list(F.struct("x", "m"))).alias("v"),
    ).filter(F.col("k") < max_bins)
    cum = F.aggregate(
        "v", F.array().cast("array<struct<x:double,c:bigint>>"),
        lambda acc, s: F.array_append(acc, F.struct(s["x"].alias("x"), (
            s["m"] + F.coalesce(F.try_element_at(acc, F.lit(-1))["c"], F.lit(0).cast("bigint"))).alias("c"))),
    )
    s = small.select("grp", "k", "n", cum.alias("v"))
    at = lambda r: F.filter("v", lambda t: t["c"] > r)[0]["x"]
    pos = lambda i: i / F.col("k") * (F.col("n") - 1)
    edge = lambda i: at(F.floor(pos(i))) + (pos(i) - F.floor(pos(i))) * (
        at(F.least(F.floor(pos(i)) + 1, F.col("n") - 1)) - at(F.floor(pos(i))))
    return s.select("grp", F.transform(F.sequence(F.lit(0), F.col("k").cast("int")), edge).alias("few"))
