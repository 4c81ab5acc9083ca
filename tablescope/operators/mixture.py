"""Gaussian mixtures of several sizes fitted together.

Rows are packed once into blocks of numbers. A round of expectation and
maximisation is one aggregate for every size that still moves: each task adds up
the responsibilities, first and second moments of its rows per (size,
component), and the sums are added in a tree of tasks. What reaches the driver
does not grow with the rows: (components x dimensions squared) numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import clean_double, col

#: Least eigenvalue of a covariance, for every number of components.
FLOOR = 1e-6
#: Rows of a block, and of a partition that is read in many rounds.
BLOCK_ROWS, PARTITION_ROWS = 2_048, 50_000
FORMS = ("full", "shared", "diagonal")


def numbers(cols: Sequence[str]) -> Column:
    """The columns as one array; null and non-finite values count as 0."""
    clean = [clean_double(col(c)) for c in cols]
    return F.array(*[F.coalesce(F.when(F.abs(c) < float("inf"), c), F.lit(0.0)) for c in clean])


@dataclass
class Points:
    """Blocks of rows (each less the mean), kept for many rounds."""

    blocks: RDD
    n: int
    mean: np.ndarray

    def over(self, run: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of run(block) over all blocks."""
        mean = self.mean

        def part(blocks: Iterator[bytes]) -> Iterator[np.ndarray]:
            total = None
            for b in blocks:
                s = run(np.frombuffer(b).reshape(-1, len(mean)) - mean)
                total = s if total is None else total + s
            return iter(() if total is None else (total,))

        return self.blocks.mapPartitions(part).treeReduce(np.add)

    def release(self) -> None:
        self.blocks.unpersist()


def points(df: DataFrame, cols: Sequence[str]) -> Points:
    """Pack the columns of a table. An empty table has n = 0."""
    d = len(cols)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            parts = [x[i : i + BLOCK_ROWS].tobytes() for i in range(0, len(x), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], ["b"])

    flat = df.select(numbers(cols).alias("x")).mapInArrow(pack, "b binary")
    blocks = flat.rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
    out = Points(blocks, 0, np.zeros(d))
    if blocks.isEmpty():
        return out
    s = out.over(lambda x: np.append(x.sum(axis=0), len(x)))
    out.n, out.mean = int(s[-1]), s[:-1] / s[-1]
    few = -(-out.n // PARTITION_ROWS)
    if few < blocks.getNumPartitions():  # a round is not the start of many empty tasks
        out.blocks = blocks.coalesce(few).persist(StorageLevel.MEMORY_AND_DISK)
        out.blocks.count()
        blocks.unpersist()
    return out


def free_parameters(d: int, k: int, form: str = "full") -> int:
    spread = {"full": k * d * (d + 1) // 2, "shared": d * (d + 1) // 2, "diagonal": k * d}[form]
    return k * d + spread + k - 1


@dataclass
class Mixture:
    """Components over the numbers less ``centre``. ``covs``: (k, d, d), for
    the diagonal form (k, d). ``history``: log-likelihood by round."""

    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    form: str
    centre: np.ndarray
    history: list[float] = field(default_factory=list)
    converged: bool = False
    hard: bool = False  # first round: rows belong to the nearest mean alone
    scales: np.ndarray | None = None

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def loglik(self) -> float:
        return self.history[-1]

    def prepare(self) -> Mixture:
        """Inverse square roots of the covariances, for the densities."""
        if self.form == "diagonal":
            self.scales = 1 / np.sqrt(self.covs)
        else:
            w, v = np.linalg.eigh(self.covs)
            self.scales = v / np.sqrt(np.maximum(w, FLOOR))[:, None, :]
        return self

    def joint(self, x: np.ndarray) -> np.ndarray:
        """log(weight x density), rows x components."""
        d = x.shape[1]
        out = np.empty((len(x), self.k))
        for j in range(self.k):
            if self.weights[j] <= 0:
                out[:, j] = -np.inf
                continue
            s = self.scales[j]
            y = (x - self.means[j]) * s if self.form == "diagonal" else (x - self.means[j]) @ s
            logdet = np.log(s).sum() if self.form == "diagonal" else np.linalg.slogdet(s)[1]
            out[:, j] = math.log(self.weights[j]) - 0.5 * d * math.log(2 * math.pi) + logdet - 0.5 * (y * y).sum(axis=1)
        return out

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Most likely component of each row (of x less the centre)."""
        return self.joint(x).argmax(axis=1)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood, then per component its share of the rows, first and
        second moments around its present mean."""
        if self.hard:
            far = np.stack([((x - m) ** 2).sum(axis=1) for m in self.means], axis=1)
            r, ll = (far.argmin(axis=1)[:, None] == np.arange(self.k)).astype(float), 0.0
        else:
            p = self.joint(x)
            top = p.max(axis=1, keepdims=True)
            r = np.exp(p - top)
            whole = r.sum(axis=1, keepdims=True)
            ll = float((np.log(whole) + top).sum())
            r /= whole
        out = [np.array([ll]), r.sum(axis=0)]
        for j in range(self.k):
            c = x - self.means[j]
            rc = c * r[:, j : j + 1]
            out += [rc.sum(axis=0), ((rc * c).sum(axis=0) if self.form == "diagonal" else rc.T @ c).ravel()]
        return np.concatenate(out)

    def width(self) -> int:
        d = self.means.shape[1]
        return 1 + self.k * (1 + d + (d if self.form == "diagonal" else d * d))

    def step(self, s: np.ndarray, n: int) -> Mixture:
        """Maximisation. Eigenvalues are raised to FLOOR, which is the maximum
        under that bound, so that the log-likelihood still never falls."""
        k, d = self.means.shape
        rows = s[1 : 1 + k]
        rest = s[1 + k :].reshape(k, -1)
        means, covs = self.means.copy(), self.covs.copy()
        pooled = np.zeros_like(covs[0])
        for j in np.flatnonzero(rows > 1e-9):
            shift = rest[j, :d] / rows[j]
            means[j] += shift
            second = rest[j, d:].reshape(covs.shape[1:]) / rows[j]
            covs[j] = second - (shift * shift if self.form == "diagonal" else np.outer(shift, shift))
            pooled += rows[j] * covs[j]
        if self.form == "shared":
            covs[:] = pooled / n
        weights = np.where(rows > 1e-9, rows, 0.0)
        return Mixture(weights / weights.sum(), means, raised(covs, self.form), self.form, self.centre, self.history).prepare()

    def ordered(self) -> Mixture:
        """Components by falling weight, then by mean, so that a label has a meaning."""
        o = np.lexsort((*self.means.T[::-1], -np.round(self.weights, 9)))
        return Mixture(self.weights[o], self.means[o], self.covs[o], self.form, self.centre, self.history, self.converged).prepare()

    def label_of(self, cols: Sequence[str]) -> Column:
        """Component number of a row."""
        model = self

        @F.pandas_udf("int")
        def label(x: pd.Series) -> pd.Series:
            return pd.Series(model.labels(np.stack(x.to_numpy()) - model.centre) if len(x) else [], dtype="int32")

        return label(numbers(cols))

    def criteria(self, n: int) -> tuple[float, float]:
        """(bic, aic)."""
        free = free_parameters(self.means.shape[1], self.k, self.form)
        return free * math.log(n) - 2 * self.loglik, 2 * free - 2 * self.loglik


def raised(covs: np.ndarray, form: str) -> np.ndarray:
    if form == "diagonal":
        return np.maximum(covs, FLOOR)
    w, v = np.linalg.eigh((covs + covs.transpose(0, 2, 1)) / 2)
    return (v * np.maximum(w, FLOOR)[:, None, :]) @ v.transpose(0, 2, 1)


# Seeds

def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centre."""
    far = np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)
    at = far.argmin(axis=1)
    return at, far[np.arange(len(x)), at]


def oversampled(p: Points, wanted: int, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate centres and the rows nearest to each.

    A round takes ``wanted`` rows, drawn by their squared distance to the
    candidates so far: each row gets the key log(u) / distance, and the greatest
    keys are merged along a tree, so no task holds more than ``wanted`` rows.
    """
    mean, found = p.mean, np.empty((0, len(p.mean)))

    def best(a: tuple, b: tuple) -> tuple:
        keys, rows = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
        o = np.argsort(-keys, kind="stable")[:wanted]
        return keys[o], rows[o]

    for r in range(rounds):
        centres = found if len(found) else np.zeros((1, len(mean)))

        def draw(part: int, blocks: Iterator[bytes]) -> Iterator[tuple]:
            rng = np.random.default_rng([seed, r, part])
            top = (np.empty(0), np.empty((0, len(mean))))
            for b in blocks:
                x = np.frombuffer(b).reshape(-1, len(mean)) - mean
                far = nearest(x, centres)[1]
                u = rng.random(len(x))
                some = far > 0
                top = best(top, (np.log(np.maximum(u[some], 1e-300)) / far[some], x[some]))
            yield top

        rows = p.blocks.mapPartitionsWithIndex(draw).treeReduce(best)[1]
        found = np.unique(np.concatenate([found, rows]), axis=0)
    if not len(found):  # all rows are alike
        return np.zeros((1, len(mean))), np.array([float(p.n)])
    count = lambda x: np.bincount(nearest(x, found)[0], minlength=len(found)).astype(float)
    return found, p.over(count)


def chosen(candidates: np.ndarray, rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centres of the weighted candidates: spread first, then moved to the
    means of what is nearest to them. Fewer candidates repeat the last one."""
    rng = np.random.default_rng([seed, k])
    centres = candidates[[int(np.argmax(rows))]]
    while len(centres) < k:
        weight = nearest(candidates, centres)[1] * rows
        pick = rng.choice(len(candidates), p=weight / weight.sum()) if weight.sum() > 0 else 0
        centres = np.vstack([centres, candidates[pick]])
    for _ in range(20):
        at = nearest(candidates, centres)[0]
        mass = np.bincount(at, weights=rows, minlength=k)
        moved = np.stack([np.bincount(at, weights=rows * c, minlength=k) for c in candidates.T], axis=1)
        centres = np.where(mass[:, None] > 0, moved / np.maximum(mass, 1e-300)[:, None], centres)
    return centres


def fit(p: Points, ks: Sequence[int], form: str = "full", seed: int = 42, max_rounds: int = 100, tol: float = 1e-3) -> dict[int, Mixture]:
    """A mixture for each k, all from one scan a round.

    A size stops when its log-likelihood per row gains less than ``tol``; one
    that still moves after ``max_rounds`` says so in ``converged``.
    """
    if form not in FORMS:
        raise ValueError(f"form is one of {FORMS}")
    ks = sorted(set(ks))
    if not p.n or not ks:
        return {}
    d, top = len(p.mean), max(ks)
    seeds = oversampled(p, 2 * top, 5, seed) if top > 1 else (np.zeros((1, d)), np.array([float(p.n)]))
    shape = (d,) if form == "diagonal" else (d, d)
    unit = np.ones(d) if form == "diagonal" else np.eye(d)
    moving = {}
    for k in ks:
        means = chosen(*seeds, k, seed) if k > 1 else np.zeros((1, d))
        moving[k] = Mixture(np.full(k, 1 / k), means, np.broadcast_to(unit, (k, *shape)).copy(), form, p.mean, hard=True)
    done: dict[int, Mixture] = {}
    for r in range(max_rounds + 1):
        models = list(moving.values())
        s = p.over(lambda x: np.concatenate([m.sums(x) for m in models]))
        at = 0
        for k, m in list(moving.items()):
            own, at = s[at : at + m.width()], at + m.width()
            if not m.hard:
                m.history.append(float(own[0]))
                m.converged = k == 1 or len(m.history) > 1 and m.history[-1] - m.history[-2] < tol * p.n
                if m.converged or r == max_rounds:
                    done[k] = moving.pop(k).ordered()
                    continue
            moving[k] = m.step(own, p.n)
        if not moving:
            break
    return {k: done[k] for k in ks}


def silhouettes(p: Points, models: dict[int, Mixture]) -> dict[int, float | None]:
    """Mean silhouette by squared Euclidean distance of each model's labels, in
    two scans for all models: distances to a cluster follow from its sums."""
    d, fits = len(p.mean), list(models.values())
    if not fits or not p.n:
        return {}
    starts = np.cumsum([0, *[m.k for m in fits]])

    def totals(x: np.ndarray) -> np.ndarray:
        full = np.column_stack([np.ones(len(x)), (x * x).sum(axis=1), x])
        return np.concatenate([(m.labels(x)[:, None] == np.arange(m.k)).T.astype(float) @ full for m in fits]).ravel()

    sums = p.over(totals).reshape(-1, 2 + d)

    def scores(x: np.ndarray) -> np.ndarray:
        out, sq, row = [], (x * x).sum(axis=1), np.arange(len(x))
        for m, a, b in zip(fits, starts, starts[1:]):
            n, psi, y = sums[a:b, 0], sums[a:b, 1], sums[a:b, 2:]
            own = m.labels(x)
            far = np.maximum(sq[:, None] * n + psi - 2 * x @ y.T, 0.0)
            inner = far[row, own] / np.maximum(n[own] - 1, 1)
            other = np.where(n > 0, far / np.maximum(n, 1), np.inf)
            other[row, own] = np.inf
            outer = other.min(axis=1)
            with np.errstate(invalid="ignore"):
                s = (outer - inner) / np.maximum(np.maximum(inner, outer), 1e-300)
            out.append(np.where((n[own] > 1) & np.isfinite(outer), s, 0.0).sum())
        return np.array(out)

    found = p.over(scores) / p.n
    return {k: float(s) if (sums[a:b, 0] > 0).sum() > 1 else None for k, s, a, b in zip(models, found, starts, starts[1:])}
