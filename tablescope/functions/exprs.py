"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC_TYPES = (T.NumericType,)
TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def col(name: str) -> Column:
    """Column by literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def rnd(c: Column, digits: int) -> Column:
    """Half-even rounding, as pandas and numpy round.

    The inner rounding drops the last bits, which depend on the order in
    which partitions were summed, so that a tie is seen as a tie.
    """
    return F.bround(F.bround(c.cast("double"), digits + 4), digits)


def varies(c: Column) -> Column:
    """Aggregate: more than one value. Exact, unlike a variance above zero,
    which merging partitions leaves a trace away from zero."""
    return F.coalesce(F.min(c) < F.max(c), F.lit(False))


def corr(y: Column, x: Column) -> Column:
    """Pearson correlation over complete pairs; null on a constant column."""
    both = y.isNotNull() & x.isNotNull()
    r = F.try_divide(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))
    return F.when(varies(F.when(both, y)) & varies(F.when(both, x)), r)


def skew_g1(c: Column) -> Column:
    """Bias-corrected skewness; null below three values or without spread."""
    n = F.count(c).cast("double")
    g1 = F.skewness(c) * F.sqrt(n * (n - 1))
    return F.when((n > 2) & varies(c), F.try_divide(g1, n - 2))


def share(part: Column, whole: Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """part / whole * scale, null when whole is zero."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * scale
    return ratio if digits is None else rnd(ratio, digits)


def clean_double(c: Column) -> Column:
    """Double with NaN turned into null."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def label_columns(df: DataFrame) -> list[str]:
    """String and boolean columns."""
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))
    ]


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEMPORAL_TYPES)]


def type_name(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def one(df: DataFrame, **exprs: Column) -> Column:
    """Whole-table aggregates as one scalar-subquery struct column.

    Gives ``one(df, m=F.avg("x"))["m"]`` without a cross join or a collect.
    """
    return df.agg(F.struct(*[e.alias(n) for n, e in exprs.items()]).alias("s")).scalar()
