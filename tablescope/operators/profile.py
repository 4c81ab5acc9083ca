"""Whole-table and per-column profiling.

One fused aggregate covers all columns of a measure; distinct values are
pre-aggregated per (column, value) before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.exprs import (
    clean_double, col, corr, label_columns, numeric_columns, one, other_columns, rnd, share,
    skew_g1, type_name,
)
from ..functions.frames import (
    column_quantiles, fits_one_pass, names_frame, pair_fan, per_column, plain_cell, typed_counts, unpivot_text, value_counts,
)


def _dtype(df: DataFrame, column: Column) -> Column:
    pairs = [F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
    return F.element_at(F.create_map(*pairs), column)


def table_summary(df: DataFrame) -> DataFrame:
    """row_count, col_count, duplicate_rows, missing_total in one shuffle."""
    nulls = sum((F.when(col(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    groups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    total = F.coalesce(F.sum("__n"), F.lit(0))
    return groups.agg(
        total.alias("row_count"),
        F.lit(len(df.columns)).alias("col_count"),
        (total - F.count(F.lit(1))).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("__n") * nulls), F.lit(0)).alias("missing_total"),
    )


def _count_measures() -> list[Column]:
    """Measures of ``typed_counts`` per column."""
    known = F.col("known")
    return [
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count_if(known).alias("unique_count"), F.max(F.when(known, F.col("n"))).alias("top_count"), F.sum("n").alias("row_count"),
    ]


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, null_count, unique_count (null not counted), top_count, row_count."""
    counted = typed_counts(df, cols).groupBy("column").agg(*_count_measures())
    names = names_frame(df.sparkSession, cols)
    zero = F.lit(0).cast("bigint")
    return names.join(counted, "column", "left").select(
        "column",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("null_count", "unique_count")],
        "top_count",
        F.coalesce("row_count", zero).alias("row_count"),
    )


def _value_stats(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """distinct_counts plus, for numeric columns, quantiles q and the share of
    rows outside the 1.5-IQR fences (probs start and end with the quartiles).

    Small input reads everything off one table of value counts. Larger input
    counts the values once, takes quantiles in scans of their own, and outliers
    from the rows, so that the counts are shuffled once.
    """
    nums = [c for c in cols if c in set(numeric_columns(df))]
    vc = typed_counts(df, cols)
    aggs = _count_measures()
    number = F.col("number")
    one_pass = not nums or fits_one_pass(df.select(*[col(c) for c in nums]))
    if one_pass:
        aggs.append(F.percentile(number, F.array(*[F.lit(float(p)) for p in probs]), F.col("n")).alias("q"))
    s = vc.groupBy("column").agg(*aggs)
    last = len(probs) - 1
    reach = 1.5 * (F.col("q")[last] - F.col("q")[0])
    if one_pass:
        fence = s.filter(F.col("q").isNotNull()).select("column", (F.col("q")[0] - reach).alias("lo"), (F.col("q")[last] + reach).alias("hi"))
        # One fence per column, so the broadcast is as small as the schema.
        out = vc.join(F.broadcast(fence), "column").groupBy("column").agg(
            F.sum(F.when((number < F.col("lo")) | (number > F.col("hi")), F.col("n")).otherwise(0)).alias("outliers"))
    else:
        q = column_quantiles(df, nums, probs, one_pass=False)
        s = s.join(q, "column", "left")
        out = _outliers(df, q)
    whole = names_frame(df.sparkSession, cols).join(s, "column", "left").join(out, "column", "left")
    zero = F.lit(0).cast("bigint")
    is_num = F.col("column").isin(nums) if nums else F.lit(False)
    return whole.select(
        "column", is_num.alias("is_num"), *[F.coalesce(F.col(c), zero).alias(c) for c in ("null_count", "unique_count", "row_count")],
        "top_count", "q", share(F.coalesce("outliers", zero), F.col("row_count"), 1, 100).alias("outlier_pct"))


def column_profile(df: DataFrame) -> DataFrame:
    d = distinct_counts(df, df.columns)
    return d.select(
        "column",
        _dtype(df, F.col("column")).alias("dtype"),
        "null_count",
        share(F.col("null_count"), F.col("row_count"), 1, 100).alias("null_pct"),
        "unique_count",
    )


def _v() -> Column:
    return F.col("value")


def _numeric_stats(df: DataFrame, cols: Sequence[str], probs: Sequence[float], extra: dict | None = None) -> DataFrame:
    """min, max, mean, std and quantile array q per numeric column."""
    measures = {
        "min": F.min(_v()), "max": F.max(_v()), "mean": F.avg(_v()),
        "std": F.stddev_samp(_v()), **(extra or {}),
    }
    if fits_one_pass(df.select(*[col(c) for c in cols])):
        measures["q"] = F.percentile(_v(), F.array(*[F.lit(float(p)) for p in probs]))
        return per_column(df, cols, measures)
    return per_column(df, cols, measures).join(
        column_quantiles(df, cols, probs, one_pass=False), "column", "left"
    )


def numeric_profile(df: DataFrame) -> DataFrame:
    s = _numeric_stats(df, numeric_columns(df), [0.5])
    return s.select(
        "column", "min", "max", rnd(F.col("mean"), 4).alias("mean"),
        rnd(F.col("std"), 4).alias("std"), F.col("q")[0].alias("median"),
    )


def fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> Column:
    """Scalar map column -> struct(lo, hi) of the k-IQR fences."""
    q = column_quantiles(df, cols, [0.25, 0.75]).select(
        "column",
        (F.col("q")[0] - k * (F.col("q")[1] - F.col("q")[0])).alias("lo"),
        (F.col("q")[1] + k * (F.col("q")[1] - F.col("q")[0])).alias("hi"),
    )
    # One entry per column.
    entries = F.collect_list(F.struct("column", F.struct("lo", "hi").alias("f")))
    return q.agg(F.map_from_entries(entries).alias("m")).scalar()


def outlier_condition(value: Column, fence: Column) -> Column:
    return F.coalesce((value < fence["lo"]) | (value > fence["hi"]), F.lit(False))


def _outliers(df: DataFrame, quartiles: DataFrame, k: float = 1.5) -> DataFrame:
    """column, outliers, rows, given (column, q) whose first and last entries
    are the quartiles. Fences are literals, one pair a column, and each column
    is compared with its own before the columns become rows."""
    found = {r["column"]: r["q"] for r in quartiles.collect()}
    far = []
    for c, q in found.items():
        v, reach = clean_double(col(c)), k * (q[-1] - q[0]) if q else 0.0
        outside = (v < F.lit(q[0] - reach)) | (v > F.lit(q[-1] + reach)) if q else F.lit(False)
        far.append(F.coalesce(outside, F.lit(False)).cast("int").alias(c))
    return per_column(df.select(*far), list(found), {"outliers": F.count_if(_v() == 1), "rows": F.count(F.lit(1))})


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of all rows (nulls included) outside the 1.5-IQR fences, in %."""
    cols = list(cols or numeric_columns(df))
    counted = _outliers(df, column_quantiles(df, cols, [0.25, 0.75]))
    return counted.select("column", share(F.col("outliers"), F.col("rows"), 1, 100).alias("outlier_pct"))


def _ranked(vc: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    # The rank filter is pushed below the shuffle, n rows per column and task.
    return vc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_values(df: DataFrame, n: int = 5, cols: Sequence[str] | None = None) -> DataFrame:
    vc = value_counts(df, list(cols or other_columns(df))).filter(F.col("value").isNotNull())
    return _ranked(vc, n).select("column", "rank", "value", F.col("n").alias("count"))


def value_counts_report(df: DataFrame, n: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """Top n values per column, null shown as (Null), and a remainder row."""
    vc = value_counts(df, list(cols or other_columns(df))).withColumn(
        "value", F.coalesce("value", F.lit("(Null)"))
    )
    whole = vc.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"))
    top = _ranked(vc, n)
    rest = (
        top.groupBy("column").agg(F.sum("n").alias("shown"))
        .join(whole, "column")
        .filter(F.col("k") > n)
        .select(
            "column", F.lit(n + 1).alias("rank"),
            F.concat(F.lit("("), (F.col("k") - n).cast("string"), F.lit(" more)")).alias("value"),
            (F.col("total") - F.col("shown")).alias("n"), "total",
        )
    )
    rows = top.join(whole.select("column", "total"), "column").select(
        "column", "rank", "value", "n", "total"
    ).unionByName(rest)
    return rows.select(
        "column", "rank", "value", F.col("n").alias("count"),
        share(F.col("n"), F.col("total"), 1, 100).alias("pct"),
    )


def numeric_summary(df: DataFrame) -> DataFrame:
    cols = numeric_columns(df)
    moments = per_column(df, cols, {
        "min": F.min(_v()), "max": F.max(_v()), "mean": F.avg(_v()), "std": F.stddev_samp(_v()), "skew": skew_g1(_v())})
    skew = rnd(F.col("skew"), 2)
    return (
        moments.join(_value_stats(df, cols, [0.25, 0.5, 0.75]), "column")
        .select(
            "column", _dtype(df, F.col("column")).alias("dtype"),
            F.col("null_count").alias("nulls"),
            share(F.col("null_count"), F.col("row_count"), 1, 100).alias("null_pct"),
            F.col("unique_count").alias("unique"),
            "min", rnd(F.col("q")[0], 2).alias("q25"), F.col("q")[1].alias("median"),
            rnd(F.col("q")[2], 2).alias("q75"), "max",
            rnd(F.col("mean"), 4).alias("mean"), rnd(F.col("std"), 4).alias("std"),
            skew.alias("skew"), "outlier_pct",
            F.when(F.abs(skew) > 1.0, "yes").otherwise("").alias("needs_log"),
        )
    )


def correlation_pairs(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 3) -> DataFrame:
    """Pairwise-complete Pearson r of every column pair, one aggregate."""
    cols = list(cols or numeric_columns(df))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "i int, j int, col_a string, col_b string, r double")
    # Rows fan out to pairs inside the scan stage and are combined there, too:
    # one short aggregate per pair key instead of one wide aggregate per pair.
    names = F.array(*[F.lit(c) for c in cols])
    fan = pair_fan(df, [clean_double(col(c)) for c in cols], pairs)
    out = fan.groupBy("i", "j").agg(corr(F.col("y"), F.col("x")).alias("r")).select(
        "i", "j", names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"), "r"
    )
    return out if digits is None else out.withColumn("r", rnd(F.col("r"), digits))


def column_assessment(df: DataFrame) -> DataFrame:
    """Rule-based flags and strategies per column."""
    numeric = numeric_columns(df)
    base = _value_stats(df, df.columns, [0.25, 0.75]).withColumn(
        "null_pct", share(F.col("null_count"), F.col("row_count"), 1, 100)
    )
    if numeric:
        base = base.join(per_column(df, numeric, {"skew": skew_g1(_v())}), "column", "left")
    else:
        base = base.withColumn("skew", F.lit(None).cast("double"))
    num = F.col("is_num")
    null, uniq = F.col("null_pct"), F.col("unique_count")
    top = F.try_divide(F.col("top_count").cast("double"), F.col("row_count").cast("double"))
    rules = [
        (null > 50, "majority_missing", "consider_dropping"),
        ((null > 5) & (null <= 50) & num, "significant_missing", "impute_median"),
        ((null > 5) & (null <= 50) & ~num, "significant_missing", "impute_mode"),
        ((null > 0) & (null <= 5), "minor_missing", "impute_or_drop_rows"),
        (num & (F.abs("skew") > 1.5), "high_skew", "log_transform"),
        (num & (F.col("outlier_pct") > 5), "high_outliers", "clip_or_winsorize"),
        (num & (uniq == 1), "constant", "drop_column"),
        (num & (uniq != 1) & (uniq <= 10), "low_cardinality_numeric", "treat_as_categorical"),
        (~num & (uniq > 100), "high_cardinality", "group_rare_categories"),
        (~num & (uniq == 1), "constant", "drop_column"),
        (~num & (top > 0.8), "severe_imbalance", "stratified_sampling"),
        (~num & (top > 0.5) & (top <= 0.8), "moderate_imbalance", None),
        (uniq == F.col("row_count"), "all_unique", "likely_id_or_key"),
    ]

    def joined(pick: int, default: str) -> Column:
        parts = F.array_compact(F.array(*[
            F.when(cond, F.lit(texts[pick])) for cond, *texts in rules
        ]))
        return F.when(F.size(parts) == 0, default).otherwise(F.concat_ws("; ", parts))

    return base.select(
        "column", _dtype(df, F.col("column")).alias("dtype"), uniq.alias("unique"), null,
        joined(0, "clean").alias("flags"), joined(1, "none_needed").alias("suggested_strategy"),
    )


def column_classes(df: DataFrame, threshold: float = 0.2) -> DataFrame:
    """column, class (numeric / categorical / other), null_share, over_threshold."""
    nulls = per_column(df, df.columns, {
        "null_share": F.try_divide(
            F.count_if(_v().isNull()).cast("double"), F.count(F.lit(1)).cast("double")
        ),
    }, text=True)
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.ShortType, T.ByteType, T.DecimalType))]
    lab = label_columns(df)
    cls = F.when(F.col("column").isin(num), "numeric").when(F.col("column").isin(lab), "categorical").otherwise("other")
    return nulls.select(
        "column", cls.alias("class"), rnd(F.col("null_share"), 6).alias("null_share"),
        F.coalesce(F.col("null_share") > threshold, F.lit(False)).alias("over_threshold"),
    )


def correlated_columns(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """column, max_abs_r with any earlier column, dropped."""
    return (
        correlation_pairs(df, digits=None).groupBy(F.col("col_b").alias("column"))
        .agg(F.max(F.abs("r")).alias("m"))
        .select("column", rnd(F.col("m"), 6).alias("max_abs_r"), F.coalesce(F.col("m") > threshold, F.lit(False)).alias("dropped"))
    )


def drop_correlated(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Drop a column correlated above threshold with any earlier one."""
    # One row per column reaches the driver.
    gone = [r["column"] for r in correlated_columns(df, threshold).filter("dropped").collect()]
    return df.drop(*gone)


def constant_columns(df: DataFrame) -> DataFrame:
    """column, unique_count (null not counted) of columns of one value or none.
    A column has more exactly where its least and greatest value differ."""
    ends = []
    for c in df.columns:
        _, cell = plain_cell(df, c)
        least, most = F.min(cell), F.max(cell)
        ends.append(F.struct(F.lit(c).alias("column"), F.when(least.isNull(), 0).when(least == most, 1).otherwise(2).cast("bigint").alias("unique_count")))
    return df.agg(F.array(*ends).alias("e")).select(F.inline("e")).filter(F.col("unique_count") <= 1)


def drop_constant(df: DataFrame) -> DataFrame:
    gone = [r["column"] for r in constant_columns(df).collect()]
    return df.drop(*gone)


def table_snapshot(df: DataFrame, order_col: str, name: str, created_by: str = "", parent: str = "") -> DataFrame:
    """Registry entry of a table: one row per column with shape and lineage."""
    sample = (
        unpivot_text(df, df.columns, [order_col]).filter(_v().isNotNull())
        .groupBy("column").agg(F.min_by("value", order_col).alias("sample_val"))
    )
    return distinct_counts(df, df.columns).join(sample, "column", "left").select(
        F.lit(name).alias("name"), F.lit(parent).alias("parent"), F.lit(created_by).alias("created_by"),
        "row_count", F.lit(len(df.columns)).alias("col_count"), "column",
        _dtype(df, F.col("column")).alias("dtype"),
        F.col("unique_count").alias("n_unique"), F.col("null_count").alias("n_null"), "sample_val",
    )


def schema_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """column, status (original / added / removed), dtype, non-null rows after."""
    removed = [c for c in before.columns if c not in after.columns]
    filled = per_column(after, after.columns, {"non_null": F.count(_v())}, text=True)
    now = filled.select(
        "column",
        F.when(F.col("column").isin(before.columns), "original").otherwise("added").alias("status"),
        _dtype(after, F.col("column")).alias("dtype"), "non_null",
    )
    gone = before.sparkSession.createDataFrame(
        [(c, "removed", type_name(before, c), None) for c in removed],
        "column string, status string, dtype string, non_null bigint",
    )
    return now.unionByName(gone)


def describe_numeric(df: DataFrame) -> DataFrame:
    s = per_column(df, numeric_columns(df), {
        "count": F.count(_v()), "mean": F.avg(_v()), "std": F.stddev_samp(_v()),
        "min": F.min(_v()), "max": F.max(_v()),
    })
    return s.select("column", "count", rnd(F.col("mean"), 4).alias("mean"), rnd(F.col("std"), 4).alias("std"), "min", "max")
