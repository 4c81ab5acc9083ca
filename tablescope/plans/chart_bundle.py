"""All closing charts of a dataset as one tidy table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import col
from ..operators import charts as G


def endgame(df: DataFrame, config: dict) -> DataFrame:
    """chart, series, position, value for every chart the config names.

    Keys: date_col, price_col, cat_cols, x_col, range_col, group_col, hue_col,
    factor_cols; charts whose columns are missing are left out.
    """
    price, out = config["price_col"], []
    has = lambda *keys: all(config.get(k) and config[k] in df.columns for k in keys)
    text = lambda c: col(c).cast("string") if isinstance(c, str) else c.cast("string")

    def add(chart: str, d: DataFrame, series: Column, position: Column, value: Column) -> None:
        out.append(d.select(F.lit(chart).alias("chart"), series.cast("string").alias("series"), position.cast("string").alias("position"), value.cast("double").alias("value")))

    for c in config.get("cat_cols", []):
        if has("date_col") and c in df.columns:
            d = G.ts_monthly(df, config["date_col"], price, c)
            add(f"ts_{price}_by_{c}", d, text(c), F.col("month"), F.col("value"))
    if has("x_col"):
        d = G.binned_scatter(df, config["x_col"], price)
        add(f"{price}_vs_{config['x_col']}", d, F.lit("median"), F.col("bin"), F.col("median"))
    if has("range_col"):
        d = G.range_gradient(df, config["range_col"], price)
        add(f"{price}_by_{config['range_col']}", d, text(config["range_col"]), F.col("sort_key"), F.col("median"))
    if has("group_col", "hue_col"):
        g, h = config["group_col"], config["hue_col"]
        d = G.faceted_box(df, price, g, h)
        stats = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in ("whisker_lo", "q1", "median", "q3", "whisker_hi")]))
        d = d.select(F.concat_ws(" / ", text(g), text(h)).alias("s"), stats.alias("x"))
        add(f"boxplot_{price}_by_{g}_{h}", d, F.col("s"), F.col("x.k"), F.col("x.v"))
    factors = [c for c in config.get("factor_cols", []) if c in df.columns]
    if factors:
        d = G.variance_decomposition(df, price, factors)
        add(f"variance_decomposition_{price}", d, F.col("factor"), F.lit("explained"), F.col("explained"))
    result = out[0]
    for d in out[1:]:
        result = result.unionByName(d)
    return result
