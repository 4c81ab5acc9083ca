"""Cleaning steps: raw to typed, flagged data. Each step may be replayed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.exprs import clean_double, col, numeric_columns
from ..functions.frames import column_quantiles, per_column
from .profile import distinct_counts, fences, outlier_condition


def _text(df: DataFrame, c: str) -> Column | None:
    """The column when it still is text; typed columns pass steps unchanged."""
    return col(c) if isinstance(df.schema[c].dataType, T.StringType) else None


def to_numeric(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn(c, clean_double(F.expr(f"try_cast(`{c}` as double)")))


def comma_number(df: DataFrame, c: str) -> DataFrame:
    if _text(df, c) is None:
        return df
    return df.withColumn(c, F.regexp_replace(col(c), ",", "").try_cast("double"))


def range_midpoint(df: DataFrame, c: str) -> DataFrame:
    """'01 TO 03' becomes 2.0; text of another shape becomes null."""
    if _text(df, c) is None:
        return df
    part = lambda i: F.regexp_extract(col(c), r"^\s*(\d+)\s+TO\s+(\d+)\s*$", i).try_cast("double")
    return df.withColumn(c, (part(1) + part(2)) / 2)


def parse_date(df: DataFrame, c: str, fmt: str = "yyyy-MM") -> DataFrame:
    if _text(df, c) is None:
        return df
    return df.withColumn(c, F.try_to_timestamp(col(c), F.lit(fmt)).cast("date"))


def duration_years(df: DataFrame, c: str) -> DataFrame:
    """'61 years 04 months' becomes 61.333..; a missing part counts as zero."""
    if _text(df, c) is None:
        return df
    years = F.regexp_extract(col(c), r"(\d+)\s*year", 1).try_cast("double")
    months = F.regexp_extract(col(c), r"(\d+)\s*month", 1).try_cast("double")
    known = years.isNotNull() | months.isNotNull()
    zero = F.lit(0.0)
    return df.withColumn(c, F.when(known, F.coalesce(years, zero) + F.coalesce(months, zero) / 12))


def mode_of(df: DataFrame, c: str) -> Column:
    """Most frequent non-null value as a scalar; ties go to the smaller value."""
    counts = df.filter(col(c).isNotNull()).groupBy(col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.orderBy(F.desc("n"), F.asc("v")).limit(1).agg(F.max("v").alias("v"))
    return best.scalar()


def impute_missing(df: DataFrame, strategy: dict[str, str]) -> DataFrame:
    """Per column: impute_median, impute_mode, drop_rows or flag."""
    out, drop = df, []
    wanted = [c for c, how in strategy.items() if how == "impute_median"]
    # All medians come from one job; they are literals of the plan.
    medians = {r["column"]: r["q"][0] for r in column_quantiles(df, wanted, [0.5]).collect() if r["q"]} if wanted else {}
    for c, how in strategy.items():
        if how == "impute_median":
            out = out.withColumn(c, F.coalesce(col(c), F.lit(medians.get(c)).cast("double")))
        elif how == "impute_mode":
            out = out.withColumn(c, F.coalesce(col(c), mode_of(df, c)))
        elif how == "drop_rows":
            drop.append(c)
        elif how == "flag":
            out = out.withColumn(f"is_missing_{c}", col(c).isNull())
        else:
            raise ValueError(f"unknown strategy {how!r} for {c}")
    for c in drop:
        out = out.filter(col(c).isNotNull())
    return out


def drop_sparse(df: DataFrame, row_share: float = 0.9, col_share: float = 0.5) -> DataFrame:
    """Drop rows above row_share nulls, then columns above col_share nulls."""
    nulls = sum((F.when(col(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    rows = df.filter(nulls / F.lit(float(len(df.columns))) <= row_share)
    share = per_column(rows, df.columns, {
        "p": F.try_divide(F.count_if(F.col("value").isNull()).cast("double"), F.count(F.lit(1)).cast("double")),
    }, text=True)
    # One row per column reaches the driver.
    gone = [r["column"] for r in share.filter(F.col("p") > col_share).collect()]
    return rows.drop(*gone)


def flag_outliers(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Add is_outlier_X from the 1.5-IQR fences; existing flags stay."""
    cols = [c for c in (cols or numeric_columns(df)) if f"is_outlier_{c}" not in df.columns]
    if not cols:
        return df
    f = fences(df, cols)
    return df.select("*", *[
        outlier_condition(clean_double(col(c)), F.element_at(f, F.lit(c))).alias(f"is_outlier_{c}") for c in cols
    ])


def useless_columns(df: DataFrame) -> DataFrame:
    """Constant columns and pure ids: column, reason."""
    exact = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.IntegralType, T.StringType))]
    d = distinct_counts(df, df.columns)
    is_id = F.col("column").isin(exact) & (F.col("unique_count") == F.col("row_count")) & (F.col("row_count") > 1)
    reason = F.when(F.col("unique_count") <= 1, "constant").when(is_id, "id")
    return d.select("column", reason.alias("reason")).filter(F.col("reason").isNotNull())


def drop_useless(df: DataFrame) -> DataFrame:
    return df.drop(*[r["column"] for r in useless_columns(df).collect()])


def standard_text(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def standardise_categories(df: DataFrame, c: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Trim, squeeze blanks, lower-case, then merge values by the given map."""
    out = standard_text(col(c))
    if mapping:
        # A map written by hand: as many entries as its author listed.
        pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        out = F.coalesce(F.try_element_at(pairs, out), out)
    return df.withColumn(c, out)


#: Values up to this length meet by what is left of them after deletions.
SHORT = 48


def met_by_deletions(values: DataFrame, d: int) -> DataFrame:
    """(short, long): values that become the same by at most d deletions from
    each. What all values have in common (a prefix, a code's form) joins
    nothing by itself: a bucket holds values that differ in d places."""
    left = F.array("v")
    forms = left
    for _ in range(d):
        left = F.array_distinct(F.flatten(F.transform(left, lambda x: F.transform(
            F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))))))
        left = F.filter(left, lambda x: x.isNotNull())
        forms = F.array_union(forms, left)
    keyed = values.select("v", F.explode(F.transform(forms, lambda x: F.xxhash64(x))).alias("key")).distinct()
    other = keyed.select(F.col("v").alias("long"), "key")
    return keyed.join(other, "key").filter("v < long").select(F.col("v").alias("short"), "long")


def met_by_pieces(values: DataFrame, d: int) -> DataFrame:
    """(short, long): values of which a piece of the shorter one stands in the
    longer one, at most d places away."""
    start = lambda i, n: F.floor(i * n / F.lit(d + 1)).cast("int")
    size = F.length("v")
    cut = values.select(F.col("v").alias("short"), size.alias("n"), F.explode(F.sequence(F.lit(0), F.lit(d))).alias("i"))
    cut = cut.withColumn("piece", F.col("short").substr(start(F.col("i"), F.col("n")) + 1, start(F.col("i") + 1, F.col("n")) - start(F.col("i"), F.col("n"))))
    seek = values.select(F.col("v").alias("long"), size.alias("m"), F.explode(F.sequence(F.greatest(size - d, F.lit(0)), size)).alias("n"))
    seek = seek.select("*", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("i"))
    first, width = start(F.col("i"), F.col("n")), start(F.col("i") + 1, F.col("n")) - start(F.col("i"), F.col("n"))
    seek = seek.select("long", "m", "n", "i", first.alias("s"), width.alias("w"))
    seek = seek.filter("w <= m").select("long", "n", "i", "w", "m", "s", F.explode(F.sequence(F.lit(-d), F.lit(d))).alias("k"))
    seek = seek.filter("s + k >= 0 and s + k + w <= m")
    seek = seek.select("long", "n", "i", F.col("long").substr((F.col("s") + F.col("k") + 1).cast("int"), F.col("w")).alias("piece")).distinct()
    return cut.join(seek, ["n", "i", "piece"]).filter(F.col("short") != F.col("long")).select("short", "long")


def near_duplicate_categories(df: DataFrame, c: str, distance: int = 2) -> DataFrame:
    """Value pairs within an edit distance: value_a, value_b, distance.

    Two values within d edits have a form in common that each reaches by at
    most d deletions, so values meet on hashes of these forms. That makes a
    value of n characters some n ** d / 2 keys; values longer than SHORT meet
    on pieces instead: the shorter one of a pair is cut into distance + 1
    pieces, one of which stands in the longer one as it is, at most distance
    places away. Only values that meet are compared.
    """
    values = df.filter(col(c).isNotNull()).select(col(c).cast("string").alias("v")).distinct()
    size = F.length("v")
    met = met_by_deletions(values.filter(size <= SHORT), distance).union(met_by_pieces(values.filter(size > SHORT - distance), distance))
    pairs = met.select(F.least("short", "long").alias("value_a"), F.greatest("short", "long").alias("value_b")).distinct()
    return pairs.withColumn("distance", F.levenshtein("value_a", "value_b")).filter(F.col("distance") <= distance)


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
