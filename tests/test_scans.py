"""Quantiles and value counts in few scans against the plain forms."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tablescope.functions import frames as fr
from tablescope.operators import profile as P

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def numbers(spark):
    i = F.col("id")
    return spark.range(0, 30_000, 1, 7).select(
        F.when(i % 5 > 0, F.sin(i.cast("double")) * 1000).alias("wide"), (i % 3).alias("few"), F.lit(None).cast("double").alias("none"),
        F.when(i % 1000 == 0, i.cast("double")).otherwise(7.0).alias("tied"), F.lit(2).alias("same"),
        F.when(i % 2 == 0, F.lit(float("nan"))).otherwise(F.when(i % 7 == 0, float("-inf")).otherwise(-F.col("id") / 3)).alias("odd.name"))


def by_name(frame):
    return {r["column"]: r["q"] for r in frame.collect()}


def test_column_quantiles_are_exact_without_the_grouped_way(numbers, monkeypatch):
    want = by_name(fr.column_quantiles(numbers, numbers.columns, PROBS, True))
    monkeypatch.setattr(fr, "group_quantiles", None)  # the long way is not taken
    monkeypatch.setattr(fr, "WIDE", 4)
    got = by_name(fr.column_quantiles(numbers, numbers.columns, PROBS, False))
    assert got.keys() == want.keys() and got["none"] is None
    for c, q in want.items():
        assert got[c] == (None if q is None else pytest.approx(q, rel=1e-12)), c


@pytest.mark.parametrize("spoil", ["bracket", "size"])
def test_missed_brackets_take_the_grouped_way(numbers, spoil, monkeypatch):
    want = by_name(fr.column_quantiles(numbers, ["wide", "few"], PROBS, True))
    if spoil == "size":
        monkeypatch.setattr(fr, "MAX_INSIDE", 3)
    else:
        monkeypatch.setattr(fr, "_disjoint", lambda b: [(900.0, 901.0)])
    got = by_name(fr.column_quantiles(numbers, ["wide", "few"], PROBS, False))
    assert all(got[c] == pytest.approx(q, rel=1e-12) for c, q in want.items())


@pytest.fixture(scope="module")
def kinds(spark):
    rows = [(0.0, 1, 2**53, "a", dt.date(2020, 1, 1), True, decimal.Decimal("1.10"), [1, 2], dt.datetime(2020, 1, 1), None),
            (-0.0, 1, 2**53 + 1, "A", dt.date(2020, 1, 1), None, decimal.Decimal("1.10"), [1, 2], dt.datetime(2020, 1, 2), None),
            (float("nan"), 1, None, "", None, True, None, None, None, None)]
    return spark.createDataFrame(rows, "d double, i int, l bigint, s string, day date, b boolean, m decimal(9,2), arr array<int>, t timestamp, none string")


def test_values_are_counted_as_they_are(kinds):
    d = {r["column"]: r[1:] for r in P.distinct_counts(kinds, kinds.columns).select("column", "null_count", "unique_count", "top_count", "row_count").collect()}
    assert d == {"d": (1, 1, 2, 3), "i": (0, 1, 3, 3), "l": (1, 2, 1, 3), "s": (0, 3, 1, 3), "day": (1, 1, 2, 3), "b": (1, 1, 2, 3),
                 "m": (1, 1, 2, 3), "arr": (1, 1, 2, 3), "t": (1, 2, 1, 3), "none": (3, 0, None, 3)}
    assert {r[0]: r[1] for r in P.constant_columns(kinds).collect()} == {c: u for c, (_, u, _, _) in d.items() if u <= 1}
    assert P.constant_columns(kinds.limit(0)).count() == len(kinds.columns)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_number_is_counted_as_text_and_constants_are_not_counted(kinds):
    plan = plan_of(P.distinct_counts(kinds.select("d", "i", "l"), ["d", "i", "l"]))
    assert "as string" not in plan
    assert "hashpartitioning" not in plan_of(P.constant_columns(kinds))


def test_summaries_are_those_of_the_one_pass_way(numbers, large_mode, spark):
    cols = [c for c in numbers.columns if c != "odd.name"]
    d = numbers.select(*cols)
    large = [sorted(map(str, f(d).collect())) for f in (P.numeric_summary, P.numeric_profile, P.iqr_outliers, P.column_assessment)]
    spark.conf.unset("spark.tablescope.onePassBytes")
    assert large == [sorted(map(str, f(d).collect())) for f in (P.numeric_summary, P.numeric_profile, P.iqr_outliers, P.column_assessment)]


def test_tasks_of_an_ordered_frame_do_not_grow_with_the_input(spark, monkeypatch):
    """Rows of the largest task, with one shuffle partition and ever more rows."""
    from tablescope.operators import models as L

    monkeypatch.setattr(fr, "BUCKET_ROWS", 100)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        d = spark.range(4000).select("id", (F.col("id") * 7919 % 4001).alias("o"), (F.col("id") % 11).cast("double").alias("v"))
        r = L.lag_features(d, ["o", "id"], "v", 3, block=100, one_pass=False)
        most = lambda f: max(x["count"] for x in f.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert most(r) <= 1000 and most(fr.row_index(d, [], ["o", "id"], one_pass=False)) <= 1000
        plain = L.lag_features(d, ["o", "id"], "v", 3, one_pass=True)
        assert sorted(map(str, r.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
