"""Toxic spans by a linear-chain conditional random field, and document scores.

Token tags are taken from the labelled documents: a token of a toxic document
is toxic if one of its features occurs in far more toxic documents than chance
gives. The field learns weights for words and their proper prefixes and for tag
steps; its forward-backward marginals give the offending offsets, and their
largest value and sum a calibrated score of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import gather
from .common import map_arrow, slices, table
from .crf import Chain, blocks, logistic, marginals, train
from .samples import PER_CLASS, labelled_sample, not_held_out

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
PREFIXES = range(3, 9)
LEAST_DOCS, LEAST_Z = 4, 4.0
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def features(chunk: str) -> list[str]:
    """The word of a chunk, and its proper prefixes."""
    w = chunk.strip(STRIP).lower()
    return ["=" + w, *["^" + w[:n] for n in PREFIXES if n < len(w)]] if w else []


@dataclass
class ToxicModel:
    weights: dict[str, float]
    bias: float
    chain: Chain
    score: np.ndarray

    def odds(self, chunk: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(chunk))


def summary(p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per document: largest marginal, second largest, log of 1 + their sum."""
    out = np.zeros((len(n), 3))
    full = np.flatnonzero(n)
    if len(full):
        start = (np.cumsum(n) - n)[full]
        top = np.maximum.reduceat(p, start)
        owner = np.repeat(np.arange(len(full)), n[full])
        # The second largest: without the first place of the largest.
        place = np.flatnonzero(p == top[owner])
        once = place[np.unique(owner[place], return_index=True)[1]]
        rest = p.copy()
        rest[once] = 0
        out[full] = np.c_[top, np.maximum.reduceat(rest, start), np.log1p(np.add.reduceat(p, start))]
    return out


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray) -> ToxicModel:
    """On a bounded sample, on the driver."""
    items: dict[str, int] = {}
    docs = [np.array([items.setdefault(c, len(items)) for c in t.split()], np.int64) for t in texts]
    names: dict[str, int] = {}
    per = [[names.setdefault(f, len(names)) for f in features(c)] for c in items]
    width = np.fromiter(map(len, per), np.int64, len(per))
    cols = np.fromiter((f for fs in per for f in fs), np.int64, int(width.sum()))
    del per
    start = np.cumsum(width) - width
    # Documents, and toxic ones, that show each feature; one document at a time.
    df, pos = np.zeros(len(names)), np.zeros(len(names))
    for d, label in zip(docs, y.tolist()):
        own = np.unique(d)
        seen = np.unique(gather(cols, start, width, own))
        df[seen] += 1
        pos[seen] += label
    rows = np.repeat(np.arange(len(items)), width)
    used = np.flatnonzero(df >= LEAST_DOCS)
    place = np.full(len(names), -1)
    place[used] = np.arange(len(used))
    rows, cols = rows[place[cols] >= 0], place[cols[place[cols] >= 0]]
    share = float(y.mean()) if len(y) else 0.0
    n, k = df[used], pos[used]
    z = (k - n * share) / np.sqrt(n * share * (1 - share) + 1)
    strong = np.zeros(len(items), bool)
    strong[rows[z[cols] >= LEAST_Z]] = True
    lens = np.array([len(d) for d in docs], np.int64)
    token = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(docs)), lens)
    tags = (strong[token] & (y[owner] == 1)).astype(np.int64) if len(token) else token
    if not len(token) or not tags.any() or not len(used):
        base = float(np.average(y, weights=weight)) if len(y) else 0.0
        return ToxicModel({}, -8.0, Chain(), np.array([0, 0, 0, np.log((base + 1e-3) / (1 - base + 1e-3))]))
    first = np.r_[True, owner[1:] != owner[:-1]]
    w, bias, chain = train(rows, cols, token, first, tags, len(items), len(used))
    odds = (np.bincount(rows, weights=w[cols], minlength=len(items)) + bias)[token]
    s = summary(np.concatenate([marginals(odds[a:b], first[a:b], chain) for a, b in blocks(first)]), lens)
    listed = list(names)
    weights = {listed[f]: float(v) for f, v in zip(used.tolist(), w.tolist()) if abs(v) > 1e-3}
    return ToxicModel(weights, bias, chain, logistic(s, y.astype(float), weight))


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD, text: str = "text", id_col: str = "doc_id", cache: int = 300_000) -> DataFrame:
    """One row per row of ``docs``: id, ``score``, ``predicted``, ``n_spans``
    and ``spans``, the code point offsets start:end (end exclusive, comma
    joined) of runs of tokens whose marginal is one half or more.

    A null or empty text has no token and gets the score of none. Repeated rows
    get equal scores; null ids stay null; further columns are ignored. One
    scan, no shuffle; the model (weights of a bounded sample) goes with the
    task, and the store of known words is emptied beyond ``cache``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for part, texts in slices(batches, text, 1 << 20):
            docs_ = [t.decode("utf-8", "replace") for t in texts]
            chunks = [d.split() for d in docs_]
            n = np.fromiter(map(len, chunks), np.int64, len(chunks))
            flat = [c for d in chunks for c in d]
            if len(known) > cache:
                known.clear()
            for c in set(flat).difference(known):
                known[c] = model.odds(c)
            odds = np.fromiter(map(known.__getitem__, flat), float, len(flat))
            first = np.zeros(len(odds), bool)
            first[(np.cumsum(n) - n)[n > 0]] = True
            p = marginals(odds, first, model.chain)
            s = summary(p, n)
            value = 1 / (1 + np.exp(-np.clip(s @ model.score[:-1] + model.score[-1], -30, 30)))
            start = np.cumsum(n) - n
            spans = [""] * len(chunks)
            for i in np.flatnonzero(s[:, 0] >= 0.5).tolist():
                hot, at, runs = p[start[i] : start[i] + n[i]] >= 0.5, 0, []
                for c, h in zip(chunks[i], hot.tolist()):
                    a = docs_[i].index(c, at)
                    at = a + len(c)
                    if h:
                        if runs and runs[-1][2]:
                            runs[-1][1] = at
                        else:
                            runs.append([a, at, True])
                    elif runs:
                        runs[-1][2] = False
                spans[i] = ",".join(f"{a}:{b}" for a, b, _ in runs)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(value), pa.array((value >= threshold).astype(np.int32)), pa.array([x.count(":") for x in spans], pa.int64()), pa.array(spans, pa.string())],
                names=[id_col, "score", "predicted", "n_spans", "spans"],
            )

    return map_arrow(docs.select(id_col, text), run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, predicted int, n_spans bigint, spans string")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(*labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", FOLDS, HELD_OUT, PER_CLASS))
    held = F.coalesce(~not_held_out("doc_id", FOLDS, HELD_OUT), F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "n_spans", "spans")
