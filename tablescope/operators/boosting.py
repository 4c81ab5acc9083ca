"""Boosted trees by second-order histograms.

Rows are binned once into compact blocks (a byte per feature) in the shared
checkpoint folder. Where all combinations of bins are fewer than the rows, rows
of equal bins become one with their number and the sum of their labels, which
gives the same sums. A level of a tree is one Spark aggregate: every partition
gives an array of sums of gradient, hessian and rows per (class, node, feature,
bin), and the arrays are added in a tree of tasks; what reaches the driver has
the size of the model's grid, not of the data. There are hundreds of such small
jobs, so they run on the RDD of the blocks, without planning each as a query. A round grows one tree for a number or two classes, and one tree per
class (softmax) for more. Margins are kept in the blocks, renewed every few
rounds in memory and less often in the folder; in between, a task applies the
latest trees itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.frames import checkpointed

#: Bins of a feature, rows of a block, fewest and most rows of a task, and rounds
#: after which margins are renewed in the folder and in memory.
BINS, BLOCK_ROWS, LEAST_ROWS, MOST_ROWS, RENEW, RENEW_HELD = 64, 8_192, 16_384, 2_097_152, 20, 4
#: Classes up to which equal rows are put together, and bytes of sums that go
#: straight to the driver.
MOST_CLASSES, DIRECT_BYTES = 32, 16 << 20
#: Splits whose gains differ by less than this share are the same; the first wins.
TIE = 1e-9


@dataclass
class Tree:
    """Nodes as arrays; a leaf has feature -1. Left where x <= threshold."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, threshold: float, gain: float, values: tuple, covers: tuple) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.threshold[node], self.gain[node] = feature, cut, threshold, gain
        self.left[node], self.right[node] = at, at + 1
        for v, n in zip(values, covers):
            for name, x in (("feature", -1), ("cut", 0), ("threshold", 0.0), ("left", 0), ("right", 0), ("value", v), ("cover", n), ("gain", 0.0)):
                getattr(self, name).append(x)
        return at, at + 1

    def leaf(self, x: np.ndarray, limits: str = "threshold") -> np.ndarray:
        """The leaf of each row of values (or of bins, by ``cut``), given as
        features x rows."""
        feature, limit = np.array(self.feature), np.array(getattr(self, limits))
        own = np.arange(len(feature))
        # A leaf leads to itself, so that all rows take the same steps.
        child = np.stack([np.where(feature < 0, own, self.right), np.where(feature < 0, own, self.left)], axis=1).ravel()
        first, flat = np.maximum(feature, 0) * x.shape[1], x.ravel()
        at, rows = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
        while (feature.take(at) >= 0).any():
            at = child.take(2 * at + (flat.take(first.take(at) + rows) <= limit.take(at)))
        return at


@dataclass
class Boosted:
    """``rounds``: a list of trees (one for each output) per round."""

    base: np.ndarray
    rounds: list[list[Tree]]
    classes: int  # 0 for a number
    features: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        x = np.ascontiguousarray(x.T)
        for trees in self.rounds:
            add(out, trees, x, "threshold")
        return out

    def importances(self) -> np.ndarray:
        """Share of the gain of all splits by feature."""
        total = np.zeros(self.features)
        for trees in self.rounds:
            for t in trees:
                np.add.at(total, [f for f in t.feature if f >= 0], [g for f, g in zip(t.feature, t.gain) if f >= 0])
        return total / total.sum() if total.sum() else total

    def transform(self, df: DataFrame, xs: list[Column]) -> DataFrame:
        """Adds ``margin`` (array), ``prediction`` (a number or class number)
        and ``probability`` (array, empty for a number)."""
        model = self

        @F.pandas_udf("array<double>")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(list(model.margins(np.array(x.tolist(), float).reshape(len(x), model.features))), dtype=object)

        out = df.withColumn("margin", margin(F.array(*xs)))
        if not self.classes:
            return out.withColumns({"prediction": F.col("margin")[0], "probability": F.array().cast("array<double>")})
        if self.classes == 2:
            p = 1 / (1 + F.exp(-F.col("margin")[0]))
            return out.withColumn("probability", F.array(1 - p, p)).withColumn("prediction", (F.col("margin")[0] > 0).cast("double"))
        top = F.array_max("margin")
        raw = F.transform("margin", lambda m: F.exp(m - top))
        share = F.transform(raw, lambda r: r / F.aggregate(raw, F.lit(0.0), lambda a, v: a + v))
        return out.withColumns({"probability": share, "prediction": (F.array_position("margin", top) - 1).cast("double")})


def add(margins: np.ndarray, trees: list[Tree], x: np.ndarray, limits: str) -> None:
    for k, t in enumerate(trees):
        margins[:, k] += np.array(t.value)[t.leaf(x, limits)]


def derivatives(y: np.ndarray, margins: np.ndarray, classes: int, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian, rows x outputs, of squared or logistic loss. A row
    that stands for ``n`` rows has the sums of their labels, or of their
    indicators of each class, as ``y``: rows x outputs."""
    if n is not None:
        n = n[:, None]
        if not classes:
            return n * margins - y, np.tile(n, (1, margins.shape[1]))
        if classes == 2:
            p = 1 / (1 + np.exp(-margins))
        else:
            p = np.exp(margins - margins.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
        return n * p - y, n * p * (1 - p)
    if not classes:
        return margins - y[:, None], np.ones_like(margins)
    if classes == 2:
        p = 1 / (1 + np.exp(-margins))
        return p - y[:, None], p * (1 - p)
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p - (y[:, None] == np.arange(classes)), p * (1 - p)


def edges_of(df: DataFrame, xs: list[Column], bins: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last, from quantiles of a mergeable
    sketch; a feature of few values has a bin for each."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(x, F.array(*map(F.lit, shares)), 10_000).alias(f"q{i}") for i, x in enumerate(xs)]).first()
    return [np.unique(np.array(q if q is not None else [], float)) for q in row]


BLOCK = "y binary, n binary, bins binary, margins binary"


def packed(y: np.ndarray, n: np.ndarray | None, bins: np.ndarray, base: np.ndarray) -> pa.RecordBatch:
    margins = np.tile(base, (bins.shape[1], 1)).astype("<f8")
    parts = (y.astype("<f8"), np.zeros(0) if n is None else n.astype("<f8"), np.ascontiguousarray(bins), margins)
    return pa.RecordBatch.from_arrays([pa.array([z.tobytes()]) for z in parts], names=["y", "n", "bins", "margins"])


def binned(b: pa.RecordBatch, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of the columns after the first, features x rows."""
    return np.stack([np.searchsorted(e, b.column(i + 1).to_numpy(zero_copy_only=False), "left") for i, e in enumerate(edges)]).astype(np.uint8)


def blocks_of(flat: DataFrame, edges: list[np.ndarray], base: np.ndarray) -> DataFrame:
    """Blocks of rows (y, x0, ...) as binary values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                yield packed(part.column(0).to_numpy(zero_copy_only=False), None, binned(part, edges), base)

    return flat.mapInArrow(run, BLOCK)


def equal_rows(flat: DataFrame, edges: list[np.ndarray], classes: int) -> DataFrame:
    """(bins, n, s0, ...): one row per combination of bins, with the number of
    its rows and the sums of their labels, or of their indicators of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.ascontiguousarray(binned(b, edges).T)
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), key], names=["y", "bins"])

    y = F.col("y")
    sums = [F.sum(y)] if classes <= 2 else [F.count_if(y == k).cast("double") for k in range(classes)]
    return flat.mapInArrow(run, "y double, bins binary").groupBy("bins").agg(
        F.count(F.lit(1)).cast("double").alias("n"), *[s.alias(f"s{k}") for k, s in enumerate(sums)])


def blocks_of_equal(cells: DataFrame, base: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                bins, n, *sums = [c.to_numpy(zero_copy_only=False) for c in b.slice(at, BLOCK_ROWS).columns]
                x = np.frombuffer(b"".join(bins), np.uint8).reshape(len(n), -1).T
                yield packed(np.stack(sums, axis=1), n, x, base)

    return cells.mapInArrow(run, BLOCK)


def arrays(block: tuple, p: int, outputs: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    y, n, bins, margins = block
    y = np.frombuffer(y, "<f8")
    n = np.frombuffer(n, "<f8") if n else None
    return y if n is None else y.reshape(-1, outputs), n, np.frombuffer(bins, np.uint8).reshape(p, -1), np.frombuffer(margins, "<f8").reshape(-1, outputs).copy()


def moved(block: tuple, recent: list[list[Tree]], p: int, outputs: int) -> tuple:
    """The block with margins that include the recent trees."""
    _, _, x, margins = arrays(block, p, outputs)
    for trees in recent:
        add(margins, trees, x, "cut")
    return (*block[:3], margins.tobytes())


def renewed(blocks: DataFrame, recent: list[list[Tree]], p: int, outputs: int) -> DataFrame:
    """The blocks with margins that include the recent trees, written anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in zip(*[b.column(i).to_pylist() for i in range(4)]):
                yield pa.RecordBatch.from_arrays([pa.array([z]) for z in moved(block, recent, p, outputs)], names=["y", "n", "bins", "margins"])

    return checkpointed(blocks.mapInArrow(run, BLOCK))


def in_memory(blocks: DataFrame) -> RDD:
    return blocks.rdd.map(lambda r: tuple(bytes(z) for z in r)).persist(StorageLevel.MEMORY_AND_DISK)


def level_sums(blocks: RDD, recent: list[list[Tree]], growing: list[Tree], open_nodes: list[list[int]], p: int, bins: int, classes: int) -> np.ndarray:
    """Sums (gradient, hessian, rows) as (output, open node, feature, bin, 3)."""
    outputs = len(growing)
    most = max(map(len, open_nodes))

    def run(rows: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((3, outputs, most, p, bins))
        for block in rows:
            y, n, x, margins = arrays(block, p, outputs)
            for trees in recent:
                add(margins, trees, x, "cut")
            g, h = derivatives(y, margins, classes, n)
            for k, t in enumerate(growing):
                place = np.full(len(t.feature), -1)
                place[open_nodes[k]] = np.arange(len(open_nodes[k]))
                at = place.take(t.leaf(x, "cut"))
                inside = at >= 0
                every = inside.all()
                mine = [w if every or w is None else w[inside] for w in (g[:, k], h[:, k] if classes else None, n)]
                first = (at if every else at[inside]) * bins
                for f in range(p):
                    cell = first + (x[f] if every else x[f][inside])
                    for s, w in enumerate(mine):
                        if s != 1 or classes:
                            total[s, k, :, f] += np.bincount(cell, w, most * bins).reshape(most, bins)
        if not classes:
            total[1] = total[2]  # the hessian of squared loss is the number of rows
        yield total

    size = 24 * outputs * most * p * bins * blocks.getNumPartitions()
    return np.moveaxis(blocks.mapPartitions(run).treeReduce(np.add, 1 if size <= DIRECT_BYTES else 2), 0, -1)


def best_split(sums: np.ndarray, reg: float, least_rows: int) -> tuple | None:
    """(gain, feature, bin, left sums, right sums) of one node's sums
    (feature, bin, 3); None where no split gains."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    whole = sums[0].sum(axis=0)
    right = whole - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + reg)
    gain = score(left) + score(right) - score(whole)
    ok = (left[..., 2] >= least_rows) & (right[..., 2] >= least_rows)
    gain = np.where(ok, gain, -np.inf)
    top = gain.max() if gain.size else -np.inf
    if not top > TIE * max(1.0, score(whole)):
        return None
    f, b = np.unravel_index(np.flatnonzero(gain.ravel() >= top * (1 - TIE))[0], gain.shape)
    return float(gain[f, b]), int(f), int(b), left[f, b], right[f, b]


def fit(df: DataFrame, label: str, xs: list[str], classes: int = 0, trees: int = 100, depth: int = 4, rate: float = 0.1,
        leaves: int = 31, reg: float = 1.0, least_rows: int = 20, bins: int = BINS) -> Boosted:
    """Boosted trees of complete rows: ``label`` is a number (``classes`` 0) or
    a class number below ``classes``; one class, or no row, gives no tree.

    Trees grow level by level; where a level would pass ``leaves``, the splits
    of highest gain are made. ``least_rows`` rows stay on each side.
    """
    p, cols = len(xs), [F.col(x).cast("double") for x in xs]
    y = F.col(label).cast("double")
    outputs = classes if classes > 2 else 1
    if classes:
        counts = {int(r[0]): r[1] for r in df.groupBy(y.alias("k")).agg(F.count(F.lit(1))).collect()}
        n = sum(counts.values())
        prior = np.array([(counts.get(k, 0) + 1e-6) / (n + 1e-6 * classes) for k in range(classes)]) if n else np.full(classes, 1 / classes)
        base = np.log(prior) if classes > 2 else np.array([np.log(prior[1] / prior[0])]) if classes == 2 else np.zeros(1)
        idle = classes < 2 or len(counts) < 2
    else:
        row = df.agg(F.avg(y), F.count(F.lit(1))).first()
        base, n = np.array([row[0] or 0.0]), row[1]
        idle = not n
    model = Boosted(base, [], classes, p)
    if idle or not p:
        return model
    edges = edges_of(df, cols, bins)
    flat = df.select(y.alias("y"), *[x.alias(f"x{i}") for i, x in enumerate(cols)])
    if math.prod(len(e) + 1 for e in edges) < n and classes <= MOST_CLASSES:
        cells = checkpointed(equal_rows(flat, edges, classes))
        n, blocks = cells.count(), blocks_of_equal(cells, base)
    else:
        blocks = blocks_of(flat, edges, base)
    # Each level is a job of its own: few rows should not be many tasks. Blocks
    # are dealt out evenly, however the rows were read.
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-n // LEAST_ROWS), max(3 * cores, -(-n // MOST_ROWS)))
    blocks = checkpointed(blocks.repartition(tasks))
    held = in_memory(blocks)
    older: RDD | None = None
    recent: list[list[Tree]] = []  # not in ``held``
    unsaved: list[list[Tree]] = []  # not in ``blocks``
    for _ in range(trees):
        if len(unsaved) == RENEW:
            blocks, recent, unsaved = renewed(blocks, unsaved, p, outputs), [], []
            for old in filter(None, (older, held)):
                old.unpersist()
            held, older = in_memory(blocks), None
        elif len(recent) == RENEW_HELD:
            if older:
                older.unpersist()
            held, older, recent = held.map(lambda block, late=recent: moved(block, late, p, outputs)).persist(StorageLevel.MEMORY_AND_DISK), held, []
        growing = [Tree() for _ in range(outputs)]
        nodes = [[0] for _ in range(outputs)]
        for level in range(depth):
            if not any(nodes):
                break
            sums = level_sums(held, recent, growing, nodes, p, bins, classes)
            for k, t in enumerate(growing):
                if not level:
                    t.cover[0] = float(sums[k, 0, 0, :, 2].sum())
                found = [(s, node) for i, node in enumerate(nodes[k]) if (s := best_split(sums[k, i], reg, least_rows))]
                room = leaves - sum(f < 0 for f in t.feature)
                found.sort(key=lambda x: -x[0][0])
                nodes[k] = []
                for (gain, f, b, left, right), node in sorted(found[: max(room, 0)], key=lambda x: x[1]):
                    value = lambda s: float(-rate * s[0] / (s[1] + reg))
                    limit = float(edges[f][b]) if b < len(edges[f]) else float("inf")
                    nodes[k] += t.split(node, f, b, limit, gain, (value(left), value(right)), (float(left[2]), float(right[2])))
        if not any(t.feature[0] >= 0 for t in growing):
            break
        model.rounds.append(growing)
        recent.append(growing)
        unsaved.append(growing)
    for old in filter(None, (older, held)):
        old.unpersist()
    return model
