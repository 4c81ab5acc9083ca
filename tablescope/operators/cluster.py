"""Finding, scoring and describing clusters."""

from __future__ import annotations

import math
import warnings
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import clean_double, col, label_columns, numeric_columns, one, rnd
from ..functions.frames import checkpointed, row_index
from ..functions.graph import components
from . import mixture
from .features import levels_of, standardise
from .profile import distinct_counts
from .stats import anova_test, regime_tests

# Name parts of columns which are no cluster features.
NOT_FEATURES = ["_id", "_flag", "is_outlier", "index"]


def feature_pick(df: DataFrame, target: str | None = None) -> DataFrame:
    """Numeric columns fit for clustering: column, unique_count."""
    cols = [c for c in numeric_columns(df) if c != target and not any(p in c.lower() for p in NOT_FEATURES)]
    return distinct_counts(df, cols).filter(F.col("unique_count") > 1).select("column", "unique_count")


# Power transform

def _psi(x: Column, lam: Column) -> Column:
    """Yeo-Johnson transform of x."""
    near0, near2 = F.abs(lam) < 1e-9, F.abs(lam - 2) < 1e-9
    up = F.when(near0, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / F.when(near0, 1.0).otherwise(lam))
    down = F.when(near2, -F.log1p(-x)).otherwise(-(F.pow(1 - x, 2 - lam) - 1) / F.when(near2, 1.0).otherwise(2 - lam))
    return F.when(x >= 0, up).otherwise(down)


def _psi_values(x: np.ndarray, lam: float) -> np.ndarray:
    """The transform of numbers, in any order."""
    up, down = x[x >= 0], x[x < 0]
    a = np.log1p(up) if abs(lam) < 1e-9 else ((up + 1) ** lam - 1) / lam
    b = -np.log1p(-down) if abs(lam - 2) < 1e-9 else -((1 - down) ** (2 - lam) - 1) / (2 - lam)
    return np.concatenate([a, b])


def _psi_moments(df: DataFrame, cols: Sequence[str], grid: Sequence[Sequence[float]]) -> DataFrame:
    """(column, lam, n, v, j): count and variance of the transformed values of
    a column for each parameter of its grid, and the sum of their log slopes.

    A task keeps a count, a mean and a sum of squares for each column and
    parameter, whatever its rows; these are merged, one entry a task, as
    variances of parts are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, j = np.zeros(len(cols), np.int64), np.zeros(len(cols))
        mean, m2 = ([np.zeros(len(g)) for g in grid] for _ in range(2))
        with np.errstate(all="ignore"):
            for batch in batches:
                for c, lams in enumerate(grid):
                    x = batch.column(c).to_numpy(zero_copy_only=False)
                    x = x[~np.isnan(x)]
                    if not len(x):
                        continue
                    total = n[c] + len(x)
                    j[c] += (np.sign(x) * np.log1p(np.abs(x))).sum()
                    for i, lam in enumerate(lams):
                        psi = _psi_values(x, lam)
                        off = psi - psi[0]  # equal values have a variance of 0
                        middle = off.mean()
                        delta = psi[0] + middle - mean[c][i]
                        m2[c][i] += ((off - middle) ** 2).sum() + delta * (delta / total) * n[c] * len(x)
                        mean[c][i] += delta * (len(x) / total)
                    n[c] = total
        rows = [(cols[c], lam, int(n[c]), mean[c][i], m2[c][i], j[c]) for c, lams in enumerate(grid) if n[c] for i, lam in enumerate(lams)]
        names, kinds = ["column", "lam", "n", "mean", "m2", "j"], [pa.string(), pa.float64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    def merged(a: Column, b: Column) -> Column:
        n, delta = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + delta * (b["n"] / n)).alias("mean"), (a["m2"] + b["m2"] + delta * (delta / n) * a["n"] * b["n"]).alias("m2"))

    slim = df.select(*[clean_double(col(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    parts = slim.mapInArrow(run, "column string, lam double, n bigint, mean double, m2 double, j double")
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    held = parts.groupBy("column", "lam").agg(F.collect_list(F.struct("n", "mean", "m2")).alias("parts"), F.sum("j").alias("j"))
    whole = held.select("column", "lam", "j", F.aggregate("parts", zero, merged).alias("m"))
    return whole.select("column", "lam", F.col("m.n").alias("n"), (F.col("m.m2") / F.col("m.n")).alias("v"), "j")


def power_lambdas(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Maximum-likelihood Yeo-Johnson parameter per column: one scan for a
    grid of parameters, refined twice around the best one."""
    cols = list(cols)
    centre = {c: 0.0 for c in cols}
    for reach, count in ((5.0, 41), (0.25, 21), (0.025, 21)):
        steps = [-reach + 2 * reach * i / (count - 1) for i in range(count)]
        sums = _psi_moments(df, cols, [[round(centre[c] + s, 6) for s in steps] for c in cols])
        ll = -F.col("n") / 2 * F.ln("v") + (F.col("lam") - 1) * F.col("j")
        best = sums.withColumn("ll", F.when(F.col("v") > 1e-300, ll)).groupBy("column").agg(
            F.max_by("lam", F.when(F.col("ll").isNotNull(), F.struct("ll", (-F.abs("lam")).alias("a")))).alias("lam"))
        for r in best.collect():  # one number per column
            if r["lam"] is not None:
                centre[r["column"]] = r["lam"]
    return centre


def power_transform(df: DataFrame, cols: Sequence[str], lambdas: dict[str, float] | None = None) -> DataFrame:
    """Yeo-Johnson, then z-score, in place; null becomes 0 before."""
    lambdas = lambdas or power_lambdas(df, cols)
    out = df.select(*[
        _psi(F.coalesce(clean_double(col(c)), F.lit(0.0)), F.lit(lambdas[c])).alias(c) if c in cols else col(c) for c in df.columns
    ])
    return zscore(out, cols)


def zscore(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    filled = df.select(*[F.coalesce(clean_double(col(c)), F.lit(0.0)).alias(c) if c in cols else col(c) for c in df.columns])
    z = standardise(filled, cols, "__z")
    return z.select(*[F.col(f"`{c}__z`").alias(c) if c in cols else col(c) for c in df.columns])


def vectors(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    flat = df.select(*[col(k) for k in keep], *[F.coalesce(clean_double(col(c)), F.lit(0.0)).alias(f"__v{i}") for i, c in enumerate(cols)])
    return VectorAssembler(inputCols=[f"__v{i}" for i in range(len(cols))], outputCol="features").transform(flat).select(*[col(k) for k in keep], "features")


# Mixtures

def gmm_labels(df: DataFrame, id_col: str, cols: Sequence[str], k: int, form: str = "full") -> DataFrame:
    """Mixture labels: id, cluster (0 is the heaviest component). Null and
    non-finite values count as 0; an empty table gives no rows."""
    p = mixture.points(df, cols)
    models = mixture.fit(p, [k], form)
    p.release()
    if not models:
        return df.select(col(id_col), F.lit(0).alias("cluster")).limit(0)
    return df.select(col(id_col), models[k].label_of(cols).alias("cluster"))


COUNT_SCHEMA = "n_clusters int, bic double, aic double"


def cluster_count_scan(df: DataFrame, cols: Sequence[str], max_k: int = 8, form: str = "full") -> DataFrame:
    """n_clusters, bic, aic for 1..max_k components on unscaled columns."""
    p = mixture.points(df, cols)
    rows = [(k, *m.criteria(p.n)) for k, m in mixture.fit(p, range(1, max_k + 1), form).items()]
    p.release()
    return df.sparkSession.createDataFrame(rows, COUNT_SCHEMA)


# Silhouette

def silhouette(df: DataFrame, id_col: str, cols: Sequence[str], label: str, sample: int | None = None) -> DataFrame:
    """Mean silhouette, noise left out: n, k, silhouette.

    All points count, with squared Euclidean distances: the mean distance of a
    point to a cluster follows from the cluster's size, sum and sum of squares,
    so the work is linear in the rows and a cluster costs a few numbers. With
    ``sample`` the plain Euclidean form runs on that many points instead.
    """
    if sample is not None:
        return sampled_silhouette(df, id_col, cols, label, sample)
    known = df.filter(F.coalesce(col(label) >= 0, F.lit(False)))
    size = known.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(col(label)).alias("k")).first()
    value = None
    if size["k"] >= 2:
        points = vectors(known.withColumn("__label", col(label).cast("double")), cols, ["__label"])
        value = ClusteringEvaluator(predictionCol="__label", distanceMeasure="squaredEuclidean").evaluate(points)
    out = df.sparkSession.createDataFrame([(size["n"], size["k"], value)], "n bigint, k bigint, silhouette double")
    return out.withColumn("silhouette", rnd(F.col("silhouette"), 4))


def sampled_silhouette(df: DataFrame, id_col: str, cols: Sequence[str], label: str, sample: int) -> DataFrame:
    """Mean Euclidean silhouette of a bounded sample (as many points as the
    parameter says, picked by hash of the id), noise left out.

    The sample is a small matrix sent to every task; a task scores its own
    points against it in blocks, so no pair is ever a row.
    """
    spark = df.sparkSession
    known = df.filter(F.coalesce(col(label) >= 0, F.lit(False)))
    x = F.array(*[F.coalesce(clean_double(col(c)), F.lit(0.0)) for c in cols])
    pick = known.select(col(id_col).cast("string").alias("id"), x.alias("x"), col(label).cast("int").alias("label"))
    pick = pick.orderBy(F.md5(F.col("id").cast("binary")), "id").limit(sample)
    pdf = pick.toPandas()  # at most ``sample`` rows
    labels = sorted(set(pdf["label"]))
    if len(labels) < 2:
        return spark.createDataFrame([(len(pdf), len(labels), None)], "n bigint, k bigint, silhouette double")
    pts = np.array(pdf["x"].tolist())
    hot = (pdf["label"].to_numpy()[:, None] == np.array(labels)[None, :]).astype(float)
    shared = spark.sparkContext.broadcast((pts, hot, labels))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_pts, onehot, names = shared.value
        sizes = onehot.sum(axis=0)
        for b in batches:
            own = np.searchsorted(names, b["label"].to_numpy())
            mine = np.array(b["x"].tolist())
            out = []
            for start in range(0, len(mine), 256):
                a, o = mine[start:start + 256], own[start:start + 256]
                sq = np.zeros((len(a), len(all_pts)))
                for j in range(a.shape[1]):
                    sq += (a[:, j][:, None] - all_pts[:, j][None, :]) ** 2
                sums = np.sqrt(sq) @ onehot
                row = np.arange(len(a))
                inner = sums[row, o] / np.maximum(sizes[o] - 1, 1)
                other = sums / sizes
                other[row, o] = np.inf
                outer = other.min(axis=1)
                s = (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300)
                out.append(np.where(sizes[o] > 1, s, 0.0))
            yield pd.DataFrame({"s": np.concatenate(out) if out else np.array([])})

    points = spark.createDataFrame(pdf[["x", "label"]], "x array<double>, label int").repartition(spark.sparkContext.defaultParallelism)
    scored = points.mapInPandas(score, "s double")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.lit(len(labels)).cast("bigint").alias("k"), rnd(F.avg("s"), 4).alias("silhouette"))


def silhouette_scan(df: DataFrame, id_col: str, cols: Sequence[str], max_k: int = 8, form: str = "full") -> DataFrame:
    """n_clusters, silhouette, bic, aic for 2..max_k on standardised columns.
    All sizes are fitted and judged together: one scan a round, two for the
    silhouettes."""
    p = mixture.points(zscore(df.select(*[col(c) for c in cols]), cols), cols)
    models = mixture.fit(p, range(2, max_k + 1), form)
    judged, rows = mixture.silhouettes(p, models), []
    for k, m in models.items():
        bic, aic = m.criteria(p.n)
        rows.append((k, None if judged[k] is None else round(judged[k], 4), round(bic, 1), round(aic, 1)))
    p.release()
    return df.sparkSession.createDataFrame(rows, "n_clusters int, silhouette double, bic double, aic double")


# Mixed columns

#: Different (cluster, column, value) that a task holds before it sends them.
HELD_VALUES = 100_000


def _packed(base: DataFrame, nums: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """Blocks of rows: the numbers of each column, the different values of each
    category and the place of every row's value among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            xs = [batch.column(i).to_numpy(zero_copy_only=False).tobytes() for i in range(len(nums))]
            codes = [batch.column(len(nums) + i).dictionary_encode(null_encoding="encode") for i in range(len(cats))]
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.num_rows], pa.int32()), pa.array([xs], pa.list_(pa.binary())),
                pa.array([[c.dictionary.to_pylist() for c in codes]], pa.list_(pa.list_(pa.string()))),
                pa.array([[c.indices.to_numpy().astype(np.int32).tobytes() for c in codes]], pa.list_(pa.binary()))], names=["n", "x", "levels", "codes"])

    slim = base.select(*[col(c).alias(f"n{i}") for i, c in enumerate(nums)], *[col(c).alias(f"c{i}") for i, c in enumerate(cats)])
    return slim.mapInArrow(run, "n int, x array<binary>, levels array<array<string>>, codes array<binary>")


def _labelled_sums(centres: list[tuple[list[float], list[str | None]]], nums: int, cats: int, gamma: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's counts of (label, column, value) and, of numeric columns, sums."""
    k = len(centres)

    def nearest(n: int, xs: list[np.ndarray], places: list[dict], codes: list[np.ndarray]) -> np.ndarray:
        at, least = np.zeros(n, np.int64), None
        for i, (mu, mode) in enumerate(centres):
            d, other = np.zeros(n), np.zeros(n)
            for x, m in zip(xs, mu):
                d += (x - m) * (x - m)
            for c, place, v in zip(codes, places, mode):
                other += c != place.get(v, -1)
            d += gamma * other
            if least is None:
                least = d
                continue
            better = (d < least) | (np.isnan(least) & ~np.isnan(d))
            at[better], least[better] = i, d[better]
        return at

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["l", "column", "value", "n", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, held = np.zeros(k, np.int64), np.zeros((nums, k)), Counter()
        for batch in batches:
            for n, x, levels, codes in zip(*(batch.column(c) for c in ("n", "x", "levels", "codes"))):
                xs, codes, levels = [np.frombuffer(b) for b in x.as_py()], [np.frombuffer(b, np.int32) for b in codes.as_py()], levels.as_py()
                at = nearest(n.as_py(), xs, [{v: i for i, v in enumerate(own)} for own in levels], codes)
                counts += np.bincount(at, minlength=k)
                for j, own in enumerate(xs):
                    sums[j] += np.bincount(at, weights=own, minlength=k)
                for j, (own, code) in enumerate(zip(levels, codes)):
                    for key, m in zip(*(u.tolist() for u in np.unique(at * len(own) + code, return_counts=True))):
                        held[key // len(own), j, own[key % len(own)]] += m
                if len(held) >= HELD_VALUES:
                    yield sent([(i, f"c{j}", v, m, None) for (i, j, v), m in held.items()])
                    held.clear()
        rows = [(i, f"n{j}", None, int(counts[i]), float(sums[j, i])) for i in range(k) if counts[i] for j in range(nums)]
        yield sent(rows + [(i, f"c{j}", v, m, None) for (i, j, v), m in held.items()])

    return run


def kprototypes_labels(df: DataFrame, id_col: str, nums: Sequence[str], cats: Sequence[str], k: int,
                       gamma: float | None = None, max_iter: int = 100) -> DataFrame:
    """k-prototypes on standardised numeric and on category columns: id, cluster.

    Centres are k x columns numbers and texts; rows are packed once into
    blocks, and each round is one aggregate over the unchanged blocks, so
    lineage never grows. Means and most frequent values come from the same rows
    (label, column, value), which a task sends added up; numeric columns have
    one each. Warns when ``max_iter`` rounds leave centres that still move.
    """
    nums, cats = list(nums), list(cats)
    base = checkpointed(zscore(df.select(col(id_col), *[col(c) for c in nums], *[col(c).cast("string").alias(c) for c in cats]), nums))
    gamma = 0.5 if gamma is None else gamma  # half the deviation of standardised columns
    means = [F.avg(c).alias(c) for c in nums]
    start = base.groupBy(*cats).agg(F.count(F.lit(1)).alias("__n"), *means).orderBy(F.desc("__n"), *cats).limit(k).collect() if cats else []
    if len(start) < k:
        seen = {tuple(r[c] for c in nums) for r in start}
        more = base.orderBy(F.md5(col(id_col).cast("string").cast("binary"))).limit(4 * k).collect()
        start += [r for r in more if tuple(r[c] for c in nums) not in seen][: k - len(start)]
    centres = [([float(r[c]) for c in nums], [r[c] for c in cats]) for r in start]

    def label() -> Column:
        dist = []
        for i, (mu, mode) in enumerate(centres):
            d = sum(((col(c) - m) * (col(c) - m) for c, m in zip(nums, mu)), F.lit(0.0))
            d = d + gamma * sum((F.when(col(c).isNull() if v is None else col(c).eqNullSafe(F.lit(v)), 0.0).otherwise(1.0) for c, v in zip(cats, mode)), F.lit(0.0))
            dist.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
        return F.array_min(F.array(*dist))["i"]

    packed = checkpointed(_packed(base, nums, cats))
    for _ in range(max_iter):
        long = packed.mapInArrow(_labelled_sums(centres, len(nums), len(cats), gamma), "l int, column string, value string, n bigint, x double")
        counts = long.groupBy("l", "column", "value").agg(F.sum("n").alias("n"), (F.sum("x") / F.sum("n")).alias("x"))
        # Most frequent value, the smaller one on a tie.
        often = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("none"), "value"))
        found = {(r["l"], r["column"]): r for r in counts.groupBy("l", "column").agg(often["value"].alias("v"), F.max("x").alias("x")).collect()}
        part = lambda i, key, field, old: found[i, key][field] if (i, key) in found else old
        new = [([part(i, f"n{j}", "x", x) for j, x in enumerate(mu)], [part(i, f"c{j}", "v", v) for j, v in enumerate(mode)])
               for i, (mu, mode) in enumerate(centres)]
        # Sums of partitions come in any order, so their last bits do not count.
        still = all(a[1] == b[1] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[0], b[0])) for a, b in zip(new, centres))
        centres = new
        if still:
            break
    else:
        warnings.warn(f"k-prototypes: centres still move after {max_iter} rounds", RuntimeWarning, stacklevel=2)
    return base.select(col(id_col), label().alias("cluster"))


METHODS = ("auto", "kprototypes", "gmm")


def find_clusters(df: DataFrame, id_col: str, k: int, method: str = "auto", cols: Sequence[str] | None = None) -> DataFrame:
    """Cluster rows by the method that suits their columns: id, cluster.

    Numeric columns are power-transformed and standardised first. ``auto``
    takes k-prototypes where there are text or boolean columns, a mixture
    otherwise; the mixture leaves such columns out. Columns of other types
    (dates, arrays) take no part.
    """
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    used = [c for c in (cols or df.columns) if c != id_col]
    numeric, labels = set(numeric_columns(df)), set(label_columns(df))
    nums, cats = [c for c in used if c in numeric], [c for c in used if c in labels]
    even = power_transform(df.select(col(id_col), *[col(c) for c in (*nums, *cats)]), nums) if nums else df
    if method == "kprototypes" or method == "auto" and cats:
        return kprototypes_labels(even, id_col, nums, cats, k)
    if not nums:
        raise ValueError("a mixture needs numeric columns")
    return gmm_labels(even, id_col, nums, k)


# Embedding and density

def principal_space(df: DataFrame, id_col: str, cols: Sequence[str], components: int) -> DataFrame:
    """The first principal components of all columns: id, e0, e1, ..."""
    data = vectors(df, cols, [id_col]).persist()
    model = PCA(k=min(components, len(cols)), inputCol="features", outputCol="p").fit(data)
    data.unpersist()
    out = model.transform(vectors(df, cols, [id_col])).select(col(id_col), vector_to_array("p").alias("a"))
    return out.select(col(id_col), *[F.col("a")[i].alias(f"e{i}") for i in range(min(components, len(cols)))])


def mixed_embedding(df: DataFrame, id_col: str, nums: Sequence[str], cats: Sequence[str] = (), components: int = 2) -> DataFrame:
    """Linear embedding of mixed columns: id, e0, e1, ... Categories enter as
    indicators weighted by their share of the columns."""
    base = power_transform(df.select(col(id_col), *[col(c) for c in (*nums, *cats)]), nums)
    weight = math.sqrt(len(cats) / max(len(nums) + len(cats), 1))
    hot = [F.when(col(c) == v, weight).otherwise(0.0).alias(f"{c}={v}") for c in cats for v in levels_of(df, c)]
    wide = base.select(col(id_col), *[col(c) for c in nums], *hot)
    names = [c for c in wide.columns if c != id_col]
    data = vectors(wide, names, [id_col]).persist()
    model = PCA(k=min(components, len(names)), inputCol="features", outputCol="p").fit(data)
    data.unpersist()
    a = vector_to_array("p")
    out = model.transform(data).select(col(id_col), a.alias("a"))
    return out.select(col(id_col), *[F.col("a")[i].alias(f"e{i}") for i in range(min(components, len(names)))])


#: Width of a density cell as a part of each column's range.
CELL_SHARE = 1 / 16
MAX_DENSITY_COLUMNS = 8


def density_clusters(df: DataFrame, id_col: str, cols: Sequence[str], min_cluster_size: int = 50, cell_share: float = CELL_SHARE) -> tuple[DataFrame, dict]:
    """Density clusters on a grid of cells: (id, cluster) and an info dict.

    A cell is dense when it holds two points and it and its neighbours hold
    min_samples; touching dense cells form a cluster, other cells join a dense
    neighbour, the rest and clusters under min_cluster_size are noise (-1).
    Only cells with points exist, as rows: their neighbours are met by joins
    on the cell, clusters are connected components, and nothing but two
    numbers reaches the driver. The cell width is a parameter and does not
    depend on the number of rows. A cell has 3 ** columns neighbours, so more
    than MAX_DENSITY_COLUMNS columns have to be embedded first.
    """
    cols = list(cols)
    if len(cols) > MAX_DENSITY_COLUMNS:
        raise ValueError("too many columns for a grid; embed them first")
    min_samples, side = max(5, min_cluster_size // 5), max(2, round(1 / cell_share))
    x = {c: clean_double(col(c)) for c in cols}
    edge = df.agg(*[F.min(x[c]).alias(f"lo{i}") for i, c in enumerate(cols)], *[F.max(x[c]).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    place = []
    for i, c in enumerate(cols):
        lo, hi = edge[f"lo{i}"] or 0.0, edge[f"hi{i}"] or 0.0
        width = (hi - lo) / side or 1.0
        place.append(F.coalesce(F.least(F.floor((x[c] - lo) / width), F.lit(side - 1)), F.lit(0)).cast("int"))
    placed = df.select(col(id_col).alias("__id"), F.array(*place).alias("cell"))
    cells = checkpointed(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))
    steps = F.array(*[F.array(*[F.lit(s) for s in step]) for step in product((-1, 0, 1), repeat=len(cols))])

    def around(d: DataFrame) -> DataFrame:
        return d.select("*", F.explode(steps).alias("__s")).withColumn("near", F.zip_with("cell", "__s", lambda a, b: a + b)).drop("__s")

    held = around(cells).groupBy(F.col("near").alias("cell")).agg(F.sum("n").alias("held"))
    dense = checkpointed(cells.filter("n > 1").join(held.filter(F.col("held") >= min_samples), "cell").select("cell"))
    touching = around(dense).filter("near >= cell").join(dense.select(F.col("cell").alias("near")), "near").select("cell", "near")
    # A cell also touches itself, so that one alone is a component.
    parts = components(touching.filter("near > cell"), "cell", "near")
    group = dense.join(parts, dense.cell == parts.node, "left").select("cell", F.coalesce("component", "cell").alias("group"))
    joined = around(group.select(F.col("cell"), "group")).groupBy(F.col("near").alias("cell")).agg(F.min("group").alias("other"))
    named = cells.join(group, "cell", "left").join(joined, "cell", "left").select("cell", "n", F.coalesce("group", "other").alias("group"))
    sizes = named.filter("group is not null").groupBy("group").agg(F.sum("n").alias("size")).filter(F.col("size") >= min_cluster_size)
    order = row_index(sizes.withColumn("rank", -F.col("size")), [], ["rank", "group"], "cluster").select("group", (F.col("cluster") - 1).cast("int").alias("cluster"))
    numbered = checkpointed(named.join(order, "group", "left").select("cell", "n", F.coalesce("cluster", F.lit(-1)).alias("cluster")))
    labels = placed.join(numbered.select("cell", "cluster"), "cell").select(F.col("__id").alias(id_col), "cluster")
    s = numbered.agg(F.coalesce(F.max("cluster") + 1, F.lit(0)).alias("k"), F.sum(F.when(F.col("cluster") == -1, F.col("n"))).alias("noise"), F.sum("n").alias("n")).first()
    info = {"n_clusters": s["k"], "noise_pct": round((s["noise"] or 0) / max(s["n"] or 0, 1), 4), "min_cluster_size": min_cluster_size}
    return labels, info


# Description and verdict

def cluster_size_check(df: DataFrame, cluster: str, min_share: float = 0.05) -> DataFrame:
    """cluster, n, share, violation (below min_share), valid (no violation)."""
    g = df.filter(col(cluster).isNotNull()).groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    s = one(g, t=F.sum("n"), m=F.min("n"))
    part = lambda n: F.try_divide(n.cast("double"), s["t"].cast("double"))
    return g.select(cluster, "n", rnd(part(F.col("n")), 4).alias("share"), (part(F.col("n")) < min_share).alias("violation"),
                    (part(s["m"]) >= min_share).alias("valid"))


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or numeric_columns(df)) if c != cluster]
    return df.groupBy(cluster).agg(*[rnd(F.avg(clean_double(col(c))), 3).alias(c) for c in cols])


def label_names(df: DataFrame, cluster: str, names: dict[str, str] | None = None) -> DataFrame:
    """cluster_label as text: the given name or C<code>."""
    code = col(cluster).cast("string")
    plain = F.concat(F.lit("C"), code)
    if not names:
        return df.withColumn("cluster_label", plain)
    given = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return df.withColumn("cluster_label", F.coalesce(F.try_element_at(given, code), plain))


def attach_labels(df: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    return df.join(labels, id_col, "left")


def cluster_verdict(df: DataFrame, cluster: str, target: str, features: Sequence[str], silhouette_score: float | None = None) -> DataFrame:
    """pass / marginal / fail from sizes, silhouette, ANOVA and regimes."""
    sizes = cluster_size_check(df, cluster).agg(F.coalesce(F.bool_and("valid"), F.lit(True)).alias("v")).first()["v"]
    a = anova_test(df, target, cluster).first()
    regimes = regime_tests(df, target, features, cluster).collect()
    n = sum(1 for r in regimes if r["is_regime"])
    significant = a["p_value"] < 0.05
    good = silhouette_score is None or silhouette_score >= 0.3
    if sizes and good and significant and n > 0:
        verdict = "pass"
    elif sizes and (significant or n > 0):
        verdict = "marginal"
    else:
        verdict = "fail"
    row = (verdict, silhouette_score, bool(sizes), a["f_stat"], a["p_value"], a["eta_squared"], n, len(regimes))
    return df.sparkSession.createDataFrame([row], "verdict string, silhouette double, sizes_ok boolean, f_stat double, p_value double, "
                                           "eta_squared double, n_regime_features int, n_features_tested int")
