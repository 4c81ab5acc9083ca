"""Frame-level building blocks that stay distributed at any size.

* ``value_counts``   long (column, value, n): pre-aggregated before its shuffle
* ``group_quantiles`` exact interpolated quantiles per group without holding a
  group's values in one task
* ``running_totals`` prefix sums over an order without a one-task window
* ``row_index``      distributed 1..n numbering inside (possibly hot) groups
"""

from __future__ import annotations

import math
import tempfile
from collections import Counter
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .exprs import clean_double, col

# Below this estimated size one hash-aggregated pass with exact percentile()
# is cheaper and its buffers are bounded by the input itself.
ONE_PASS_BYTES_KEY = "spark.tablescope.onePassBytes"
ONE_PASS_BYTES = 64 * 1024 * 1024
SKETCH_ACCURACY = 10_000
#: Rows of a bucket of an ordered frame.
BUCKET_ROWS = 250_000
#: Values inside the bracket of a quantile that may be ranked in one task; wider
#: brackets are narrowed again, at most so many times.
MAX_INSIDE, ROUNDS, GRID = 1_000_000, 8, 500


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for the frame, None where it is unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (Py4JError, AttributeError, ValueError):
        return None


def fits_one_pass(df: DataFrame) -> bool:
    limit = int(_spark(df).conf.get(ONE_PASS_BYTES_KEY, str(ONE_PASS_BYTES)))
    size = plan_bytes(df)
    return size is not None and size <= limit


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir of the session. Only
    a local session, as in tests, falls back to a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder which all executors share")
    return tempfile.mkdtemp(prefix="tablescope-")


#: Whether Spark deletes the shuffle files of a query when it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def leaving_nothing(spark: SparkSession) -> Iterator[None]:
    """Frames made inside are run once: their shuffle files go with the end of
    the run, and not when the driver happens to collect its garbage."""
    old = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, old)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder of the cluster. What
    was shuffled for it is not read again and goes at once."""
    sc = _spark(df).sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(_spark(df)))
    with leaving_nothing(_spark(df)):
        return df.select("*").checkpoint(eager=True)


MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES = 10_000, 8 << 20


def sized(small: DataFrame, large: DataFrame | None = None) -> DataFrame:
    """A table of group figures, ready to be joined to a large table.

    It is written to the checkpoint folder and counted: up to
    MAX_BROADCAST_ROWS rows and MAX_BROADCAST_BYTES it is broadcast, so the large side stays where it
    is; beyond that both sides meet by key. Being written, its figures are
    the same for every task, also for one that runs again after a loss.
    A large side of one-pass size needs neither.
    """
    if large is not None and fits_one_pass(large):
        return small
    kept = checkpointed(small)
    with leaving_nothing(_spark(kept)):
        few = kept.limit(MAX_BROADCAST_ROWS + 1)
        s = few.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct("*")))).alias("b")).first()
    return F.broadcast(kept) if s["n"] <= MAX_BROADCAST_ROWS and (s["b"] or 0) <= MAX_BROADCAST_BYTES else kept


def text_of(df: DataFrame, name: str) -> Column:
    """Value as text, so that equal values stay equal and others differ."""
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        c = clean_double(c) + F.lit(0.0)
    return c.cast("string")


def names_frame(spark: SparkSession, cols: Sequence[str]) -> DataFrame:
    """One row per given name: column."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))


def _unpivot(df: DataFrame, cells: list[Column], cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    ids = [f"__by{i}" for i in range(len(by))]
    # A cell carries its column's name from the start: rows only get a literal.
    slim = df.select(*[col(b).alias(i) for b, i in zip(by, ids)], *[c.alias(n) for n, c in zip(cols, cells)])
    long = slim.unpivot(ids, [col(c) for c in cols], "__column", "__value")
    return long.select(*[F.col(i).alias(b) for b, i in zip(by, ids)], F.col("__column").alias("column"), F.col("__value").alias("value"))


def unpivot_text(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _unpivot(df, [text_of(df, c) for c in cols], cols, by)


def unpivot_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _unpivot(df, [clean_double(col(c)) for c in cols], cols, by)


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value, n), null kept as a value of its own."""
    return (
        unpivot_text(df, cols, by)
        .groupBy(*by, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


#: Types whose values are equal exactly where their texts are, so that they are
#: counted as they are.
PLAIN_TYPES = (T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, T.DecimalType)


def plain_cell(df: DataFrame, name: str) -> tuple[str, Column]:
    """(type, value) of a column such that equal values stay equal and others
    differ; types without such an equality become text."""
    kind, c = df.schema[name].dataType, col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double", clean_double(c) + F.lit(0.0)
    if isinstance(kind, T.IntegralType):
        return "bigint", c.cast("bigint")
    return (kind.simpleString(), c) if isinstance(kind, PLAIN_TYPES) else ("text", text_of(df, name))


def typed_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, known, number, n): one row per value of each column, as many as
    ``value_counts`` has; ``number`` is the value of a numeric column.

    Values are grouped as they are, columns of one type at a time.
    """
    kinds: dict[str, list[tuple[str, Column]]] = {}
    for c in cols:
        kind, cell = plain_cell(df, c)
        kinds.setdefault(kind, []).append((c, cell))
    out = None
    for kind, found in kinds.items():
        names, cells = zip(*found)
        number = F.col("value").cast("double") if kind in ("double", "bigint") or kind.startswith("decimal") else F.lit(None).cast("double")
        part = _unpivot(df, list(cells), names, ()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).select(
            "column", F.col("value").isNotNull().alias("known"), number.alias("number"), "n")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else _spark(df).createDataFrame([], "column string, known boolean, number double, n bigint")


def per_column(
    df: DataFrame, cols: Sequence[str], measures: dict[str, Column], by: Sequence[str] = (), text: bool = False
) -> DataFrame:
    """Aggregates of ``value`` for every column in one scan and one small shuffle.

    ``measures`` are expressions over ``value`` (and ``column``). The unpivot
    is a projection; rows are combined per column before they are shuffled.
    """
    long = (unpivot_text if text else unpivot_numeric)(df, cols, by)
    out = long.groupBy(*by, "column").agg(*[m.alias(n) for n, m in measures.items()])
    if by:
        return out
    return names_frame(_spark(df), cols).join(out, "column", "left")


def pair_fan(df: DataFrame, values: list[Column], pairs: list[tuple[int, int]]) -> DataFrame:
    """One row (i, j, x, y) per wanted pair of values of each row.

    The pairs are indexes into the row's value array: the generated code stays
    short enough to be compiled however many pairs there are.
    """
    index = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs])
    fan = df.select(F.array(*values).alias("v"), F.explode(index).alias("p"))
    return fan.select("p.i", "p.j", F.col("v")[F.col("p.i")].alias("x"), F.col("v")[F.col("p.j")].alias("y"))


def group_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    one_pass: bool | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles: by..., n, q array<double>.

    Small input: ``percentile`` in one pass. Larger input: a mergeable sketch
    brackets every wanted rank, a second pass counts the rows below and inside
    each bracket, a third one ranks only the distinct values inside the
    brackets. A bracket which misses its rank is widened to the whole group,
    so the answer is exact in every case; one that holds more than MAX_INSIDE
    values, and more than one different one, is narrowed by a sketch of its
    inside until it does not.
    """
    by = list(by)
    v = clean_double(col(value))
    src = df.select(*[col(b) for b in by], v.alias("__v")).filter(F.col("__v").isNotNull())
    if one_pass is None:
        one_pass = fits_one_pass(df)
    if one_pass:
        exact = F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs]))
        return src.groupBy(*by).agg(F.count("__v").alias("n"), exact.alias("q"))

    slack = 5.0 / SKETCH_ACCURACY
    marks: list[float] = []
    for p in probs:
        marks += [max(0.0, p - slack), min(1.0, p + slack)]
    sketch = src.groupBy(*by).agg(
        F.count("__v").alias("__n"),
        F.approx_percentile(
            "__v", F.array(*[F.lit(m) for m in marks]), F.lit(SKETCH_ACCURACY)
        ).alias("__s"),
    )
    # Second pass: the bracket travels with its counts, so both stay consistent.
    sketch = sized(sketch)
    both = src.join(sketch, by)
    counts = both.groupBy(*by, "__n", "__s").agg(
        F.array(*[
            F.struct(
                F.count_if(F.col("__v") < F.col("__s")[2 * i]).alias("below"),
                F.count_if(F.col("__v").between(F.col("__s")[2 * i], F.col("__s")[2 * i + 1])).alias("inside"),
            )
            for i in range(len(probs))
        ]).alias("__c")
    )
    targets = counts.select(
        *by, F.col("__n"), "__s", "__c",
        F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("__i", "__p"),
    )
    position = F.col("__p") * (F.col("__n") - 1)
    targets = targets.select(
        *by, "__n", "__i",
        F.floor(position).alias("__r"),
        (position - F.floor(position)).alias("__frac"),
        F.element_at("__s", 2 * F.col("__i") + 1).alias("__lo"),
        F.element_at("__s", 2 * F.col("__i") + 2).alias("__hi"),
        F.element_at("__c", F.col("__i") + 1).alias("__k"),
    )
    holds = (F.col("__k.below") <= F.col("__r")) & (
        F.least(F.col("__r") + 1, F.col("__n") - 1) < F.col("__k.below") + F.col("__k.inside")
    )
    targets = targets.select(
        *by, "__n", "__i", "__r", "__frac",
        F.when(holds, F.col("__lo")).otherwise(F.lit(float("-inf"))).alias("__lo"),
        F.when(holds, F.col("__hi")).otherwise(F.lit(float("inf"))).alias("__hi"),
        F.when(holds, F.col("__k.below")).otherwise(F.lit(0)).alias("__below"),
        F.when(holds, F.col("__k.inside")).otherwise(F.col("__n")).alias("__inside"),
    )
    targets = checkpointed(targets)
    wide = (F.col("__inside") > MAX_INSIDE) & (F.col("__lo") < F.col("__hi"))
    for _ in range(ROUNDS):
        large = targets.filter(wide)
        if large.isEmpty():
            break
        targets = checkpointed(targets.filter(~wide).unionByName(_narrowed(src, by, large)))
    # Third pass: only the values inside a bracket are grouped and ranked.
    tkey = [*by, "__i", "__n", "__r", "__frac", "__below"]
    inside = (
        src.join(sized(targets), by)
        .filter(F.col("__v").between(F.col("__lo"), F.col("__hi")))
        .groupBy(*tkey, "__v")
        .agg(F.count(F.lit(1)).alias("__m"))
    )
    w = Window.partitionBy(*by, "__i").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("__cum", F.col("__below") + F.sum("__m").over(w))
    upper = F.least(F.col("__r") + 1, F.col("__n") - 1)
    picked = ranked.groupBy(*by, "__i", "__n", "__frac").agg(
        F.min(F.when(F.col("__cum") > F.col("__r"), F.col("__v"))).alias("__a"),
        F.min(F.when(F.col("__cum") > upper, F.col("__v"))).alias("__b"),
    )
    value_at = (1 - F.col("__frac")) * F.col("__a") + F.col("__frac") * F.col("__b")
    packed = F.array_sort(F.collect_list(F.struct("__i", value_at.alias("v"))))
    # One entry per wanted quantile: the list is as long as ``probs``.
    return picked.groupBy(*by).agg(
        F.max("__n").alias("n"), F.transform(packed, lambda s: s["v"]).alias("q")
    )


def _narrowed(src: DataFrame, by: list[str], targets: DataFrame) -> DataFrame:
    """The targets with brackets of about 1 / GRID of the values inside them."""
    key = [*by, "__i"]
    inside = src.join(sized(targets), by).filter(F.col("__v").between(F.col("__lo"), F.col("__hi")))
    marks = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    sketch = inside.groupBy(*key).agg(F.approx_percentile("__v", marks, F.lit(SKETCH_ACCURACY)).alias("__g"))
    k = F.floor((F.col("__r") - F.col("__below")) / F.greatest(F.col("__inside") - 1, F.lit(1)) * GRID)
    slack = 1 + math.ceil(5 * GRID / SKETCH_ACCURACY)  # marks that the sketch may be off
    closer = targets.join(sized(sketch), key).select(
        *targets.columns,
        F.when(k >= slack, F.get("__g", k - slack)).otherwise(F.col("__lo")).alias("__lo2"),
        F.when(k + slack + 1 <= GRID, F.get("__g", k + slack + 1)).otherwise(F.col("__hi")).alias("__hi2"),
    )
    v = F.col("__v")
    counted = src.join(sized(closer), by).filter(v.between(F.col("__lo"), F.col("__hi"))).groupBy(*closer.columns).agg(
        F.count_if(v < F.col("__lo2")).alias("__b2"), F.count_if(v.between(F.col("__lo2"), F.col("__hi2"))).alias("__i2"))
    first = F.col("__below") + F.col("__b2")
    holds = (first <= F.col("__r")) & (F.least(F.col("__r") + 1, F.col("__n") - 1) < first + F.col("__i2"))
    pick = lambda new, old: F.when(holds, new).otherwise(F.col(old)).alias(old)
    new = {"__lo": F.col("__lo2"), "__hi": F.col("__hi2"), "__below": first, "__inside": F.col("__i2")}
    return counted.select(*[pick(new[c], c) if c in new else F.col(c) for c in targets.columns])


#: Columns whose quantiles are found by the same scans, values of a sorted run,
#: and the step at which it is read.
WIDE, PICK_RUN, PICK_STEP = 32, 524_288, 256


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], one_pass: bool | None = None
) -> DataFrame:
    """Exact quantiles per column: column, q array<double> (null if empty)."""
    cols = list(cols)
    if one_pass is None:
        one_pass = fits_one_pass(df.select(*[col(c) for c in cols]))
    if not one_pass:
        found = {}
        for at in range(0, len(cols), WIDE):
            found |= _wide_quantiles(df, cols[at : at + WIDE], [float(p) for p in probs])
        # len(probs) numbers a column.
        return _spark(df).createDataFrame([(c, found[c]) for c in cols], "column string, q array<double>")
    found = group_quantiles(unpivot_numeric(df, cols), ["column"], "value", probs, one_pass=one_pass)
    return names_frame(_spark(df), cols).join(found.select("column", "q"), "column", "left")


def _wide_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float] | None]:
    """Exact quantiles of each column in two scans of the rows as they are.

    The first scan brackets every wanted rank by regular picks of sorted runs.
    In the second, tasks count the values below, between and inside the
    brackets, and give the different values inside; only those are grouped and
    ranked. Where a rank is outside its bracket, or a bracket holds too many
    values for one task, the column takes the way of ``group_quantiles``.
    """
    spark = _spark(df)
    slim = df.select(*[clean_double(col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    picks = checkpointed(_picks(slim, len(cols)))
    size = {r["k"]: r for r in picks.filter("v is null").groupBy("k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("runs")).collect()}
    sketches, spans = [], {}
    for k, r in size.items():
        # A run's picks are off by up to half a step, and so is their number.
        slack = 5.0 / SKETCH_ACCURACY + PICK_STEP * (r["runs"] + 1) / r["n"]
        spans[k] = [(p - slack, p + slack) for p in probs]
        marks = F.array(*[F.lit(min(1.0, max(0.0, m))) for span in spans[k] for m in span])
        sketches.append(F.approx_percentile(F.when(F.col("k") == k, F.col("v")), marks, F.lit(SKETCH_ACCURACY)).alias(f"s{k}"))
    row = picks.agg(*sketches).first() if sketches else None
    brackets: list[list[tuple[float, float]]] = []
    for k in range(len(cols)):
        s = row[f"s{k}"] if k in size else None
        # Picks know nothing beyond the first and the last of them.
        brackets.append(_disjoint([
            (-math.inf if s is None or a <= 0 else s[2 * i], math.inf if s is None or b >= 1 else s[2 * i + 1])
            for i, (a, b) in enumerate(spans.get(k, ()))]))
    ends = [(np.array([a for a, _ in b]), np.array([b for _, b in b])) for b in brackets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside: Counter = Counter()
        shape = lambda k, zone, v, n: pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(zone, pa.int32()), pa.array(v, pa.float64()), pa.array(n, pa.int64())], names=["k", "zone", "v", "m"])
        for b in batches:
            for k, (lo, hi) in enumerate(ends):
                v = b.column(k).to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                # Odd inside a bracket, even below, between and above them.
                zone = np.searchsorted(lo, v, "right") + np.searchsorted(hi, v, "left")
                for z, n in enumerate(np.bincount(zone)):
                    if z % 2 == 0 and n:
                        outside[k, z] += int(n)
                inside, n = np.unique(v[zone % 2 == 1], return_counts=True)
                if len(inside):
                    at = np.searchsorted(lo, inside, "right") + np.searchsorted(hi, inside, "left")
                    yield shape(np.full(len(inside), k), at, inside, n)
        if outside:
            yield shape([k for k, _ in outside], [z for _, z in outside], [None] * len(outside), list(outside.values()))

    counts = checkpointed(slim.mapInArrow(run, "k int, zone int, v double, m long").groupBy("k", "zone", "v").agg(F.sum("m").alias("m")))
    # One row per column and zone.
    zones = counts.groupBy("k", "zone").agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("different")).orderBy("k", "zone").collect()
    totals = {k: sum(r["m"] for r in zones if r["k"] == k) for k in range(len(cols))}
    wanted, missed = [], set()
    for k, n in totals.items():
        for p in probs if n else ():
            r = math.floor(p * (n - 1))
            for rank in (r, min(r + 1, n - 1)):
                before = 0
                for z in (z for z in zones if z["k"] == k):
                    if before <= rank < before + z["m"]:
                        wanted.append((k, z["zone"], rank, rank - before))
                        if z["zone"] % 2 == 0 or z["different"] > MAX_INSIDE:
                            missed.add(k)
                        break
                    before += z["m"]
    found: dict[str, list[float] | None] = {cols[k]: None for k in totals}
    ranks = sorted({w for w in wanted if w[0] not in missed})
    at = {}
    if ranks:
        targets = spark.createDataFrame(ranks, "k int, zone int, rank long, inner_rank long")
        run_up = Window.partitionBy("k", "zone").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        near = counts.join(F.broadcast(targets.select("k", "zone").distinct()), ["k", "zone"], "left_semi").withColumn("cum", F.sum("m").over(run_up))
        hit = (F.col("cum") > F.col("inner_rank")) & (F.col("cum") - F.col("m") <= F.col("inner_rank"))
        at = {(r["k"], r["rank"]): r["v"] for r in near.join(F.broadcast(targets), ["k", "zone"]).filter(hit).select("k", "rank", "v").collect()}
    for k, n in totals.items():
        if n and k not in missed:
            q = []
            for p in probs:
                r = math.floor(p * (n - 1))
                frac = p * (n - 1) - r
                a, b = at[k, r], at[k, min(r + 1, n - 1)]
                q.append(a if frac == 0 or a == b else (1 - frac) * a + frac * b)
            found[cols[k]] = q
    if missed:
        left = [cols[k] for k in sorted(missed)]
        rest = group_quantiles(unpivot_numeric(df, left), ["column"], "value", probs, one_pass=False)
        found |= {r["column"]: r["q"] for r in rest.select("column", "q").collect()}
    return found


def _picks(slim: DataFrame, p: int) -> DataFrame:
    """(k, v, n): of every run of PICK_RUN values of column k that a task reads
    every PICK_STEP-th in order, and with v null the length of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(p)]
        sizes = [0] * p

        def close(k: int) -> pa.RecordBatch:
            v = np.sort(np.concatenate(held[k]))[PICK_STEP // 2 :: PICK_STEP]
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v) + 1, k), pa.int32()), pa.array([*v.tolist(), None], pa.float64()), pa.array([0] * len(v) + [sizes[k]], pa.int64())], names=["k", "v", "n"])
            held[k], sizes[k] = [], 0
            return out

        for b in batches:
            for k in range(p):
                v = b.column(k).to_numpy(zero_copy_only=False)
                held[k].append(v[~np.isnan(v)])
                sizes[k] += len(held[k][-1])
                if sizes[k] >= PICK_RUN:
                    yield close(k)
        for k in range(p):
            if sizes[k]:
                yield close(k)

    return slim.mapInArrow(run, "k int, v double, n long")


def _disjoint(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The brackets in order, those that share a value put together."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def quantiles_of(df: DataFrame, value: str, probs: Sequence[float], one_pass: bool | None = None) -> Column:
    """Exact whole-table quantiles of one column as a literal array.

    The len(probs) numbers are computed at once, so that an expression may
    use them many times without repeating the plan behind them.
    """
    q = column_quantiles(df.select(col(value)), [value], probs, one_pass).first()["q"] or [None] * len(probs)
    return F.array(*[F.lit(x).cast("double") for x in q])


def _buckets(df: DataFrame) -> int:
    """Number of buckets, from the rows."""
    return max(-(-df.count() // BUCKET_ROWS), int(_spark(df).conf.get("spark.sql.shuffle.partitions")))


def _placed(df: DataFrame, order: Sequence[str], count: int | None = None) -> DataFrame:
    """Add __b: one of ``count`` buckets that rises along ``order``, nulls first.

    Buckets are the partitions of a range partitioning by all of ``order``,
    whatever its types. Rows are written with their bucket to the shared
    folder, so that a task that runs again sees the same buckets.
    """
    placed = df.repartitionByRange(count or _buckets(df), *[col(o) for o in order])
    return checkpointed(placed.withColumn("__b", F.spark_partition_id()))


def _with_offsets(b: DataFrame, count: int, by: list[str], sums: dict[str, Column], sign: int = 1) -> DataFrame:
    """Join to every row the totals of the buckets before its own. Rows are
    dealt to as many tasks as there are buckets, so that a task holds a few
    buckets whatever the input."""
    totals = b.groupBy(*by, "__b").agg(*[F.sum(e).alias(f"__t_{o}") for o, e in sums.items()])
    before = Window.partitionBy(*by, F.lit(1)).orderBy(F.col("__b") * sign).rowsBetween(Window.unboundedPreceding, -1)
    off = totals.select(
        *[col(k).alias(f"__k_{k}") for k in by], F.col("__b").alias("__kb"),
        *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__o_{o}") for o in sums],
    )
    # Null-safe on the group keys so that a null group keeps its rows.
    off = sized(off)
    cond = b["__b"] == off["__kb"]
    for k in by:
        cond = cond & b[k].eqNullSafe(off[f"__k_{k}"])
    return b.join(off, cond).repartition(count, "__b")


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    by: Sequence[str] = (),
    one_pass: bool | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add inclusive prefix sums ``{output: input}`` along ``order`` per group.

    Rows are bucketed by ``order``; bucket totals give each bucket its offset
    and the window only runs inside a bucket, so a hot group is spread over
    as many tasks as there are buckets. (by, order) must be unique.
    """
    by = list(by)
    key = col(order).desc() if descending else col(order).asc()
    if one_pass is None:
        one_pass = fits_one_pass(df)
    if one_pass:
        whole = Window.partitionBy(*by, F.lit(1)).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(col(i)).over(whole).alias(o) for o, i in sums.items()])
    count = _buckets(df)
    b = _placed(df, [order, *by], count)
    joined = _with_offsets(b, count, by, {o: col(i) for o, i in sums.items()}, -1 if descending else 1)
    inner = Window.partitionBy(*by, "__b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *[col(c) for c in df.columns],
        *[(F.sum(col(i)).over(inner) + F.col(f"__o_{o}")).alias(o) for o, i in sums.items()],
    )


def row_index(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "row_index",
    one_pass: bool | None = None,
) -> DataFrame:
    """1-based row number per group along ``order``, bucket by bucket. The
    order must be total. Small input takes one plain window."""
    by = list(by)
    if one_pass is None:
        one_pass = fits_one_pass(df)
    if one_pass:
        whole = Window.partitionBy(*by, F.lit(1)).orderBy(*[col(o) for o in order])
        return df.select("*", F.row_number().over(whole).cast("bigint").alias(name))
    count = _buckets(df)
    b = _placed(df, [*order, *by], count)
    joined = _with_offsets(b, count, by, {"n": F.lit(1)})
    inner = Window.partitionBy(*by, "__b").orderBy(*[col(o) for o in order])
    return joined.select(
        *[col(c) for c in df.columns],
        (F.row_number().over(inner) + F.col("__o_n")).cast("bigint").alias(name),
    )


def top_values(df: DataFrame, name: str, n: int) -> DataFrame:
    """The n most frequent non-null values: value, n (count desc, value asc)."""
    return (
        df.filter(col(name).isNotNull())
        .groupBy(col(name).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
        .limit(n)
    )


def keep_top(df: DataFrame, name: str, n: int) -> DataFrame:
    """Rows whose value is among the n most frequent ones.

    The list is a limit(n), so its broadcast is bounded by n rows.
    """
    top = top_values(df, name, n).select(F.col("value").alias("__top"))
    return df.join(F.broadcast(top), col(name) == F.col("__top"), "left_semi")
