"""Normalising of mixed JSON fields and of answers with a fenced JSON block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Keys that name an object's main value, by preference.
MAIN_KEYS = ["value", "name", "label", "text", "result"]


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def _text(v: Column) -> Column:
    """Plain text of a scalar, JSON text of anything nested."""
    return F.when(_kind(v).isin("OBJECT", "ARRAY"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))


def _first_value(v: Column) -> Column:
    return F.get(F.map_values(F.try_variant_get(v, "$", "map<string,variant>")), F.lit(0))


def _keyed(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def json_to_string_list(c: Column, key: str = "feature") -> Column:
    """null, text, object or array of them as array<string>. An object gives
    the value under ``key``; inside an array it falls back to its first value."""
    v = F.try_parse_json(c)
    none = F.array().cast("array<string>")
    item = lambda x: F.when(
        _kind(x) == "OBJECT", F.coalesce(_text(_keyed(x, key)), _text(_first_value(x)), F.to_json(x))
    ).otherwise(_text(x))
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), item)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(v.isNull() | (_kind(v) == "VOID"), none)
        .when(_kind(v) == "STRING", F.when(F.trim(text) == "", none).otherwise(F.array(text)))
        .when(_kind(v) == "OBJECT", F.array(F.coalesce(_text(_keyed(v, key)), F.to_json(v))))
        .when(_kind(v) == "ARRAY", items)
        .otherwise(F.array(text))
    )


def json_to_string(c: Column, fallback: str = "") -> Column:
    """One text from a mixed field, an object giving its main value."""
    v = F.try_parse_json(c)
    named = F.coalesce(*[_text(_keyed(v, k)) for k in MAIN_KEYS], _text(_first_value(v)), F.lit(fallback))
    return (
        F.when(v.isNull() | (_kind(v) == "VOID"), fallback)
        .when(_kind(v) == "OBJECT", named)
        .otherwise(_text(v))
    )


def json_join_list(c: Column, key: str = "feature", sep: str = ", ") -> Column:
    return F.array_join(json_to_string_list(c, key), sep)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def split_response(df: DataFrame, c: str) -> DataFrame:
    """reasoning (text before the fence) and json_block (inside the fence)."""
    t = F.col(c)
    tagged, bare = F.contains(t, F.lit("```json")), F.contains(t, F.lit("```"))
    before = F.when(tagged, F.split(t, "```json")[0]).when(bare, F.split(t, "```")[0]).otherwise("")
    inside = (
        F.when(tagged, F.split(F.get(F.split(t, "```json"), F.lit(1)), "```")[0])
        .when(bare, F.get(F.split(t, "```"), F.lit(1))).otherwise(t)
    )
    return df.select("*", _strip(before).alias("reasoning"), _strip(inside).alias("json_block"))
