"""Near-duplicate vectors by spherical-cap filters with random product codes.

A filter is a direction; a vector passes it when their inner product reaches
the height of a cap. The directions of one code are all concatenations of one
code word for each half of the (randomly rotated) space, so ``WORDS`` words a
half make WORDS**2 filters, and the filters that a vector passes are decoded
from two short lists of inner products. Vectors are joined on their filters,
and pairs that meet are verified with their exact cosine. Several independent
codes make a miss unlikely; recall is measured in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.frames import checkpointed, sized
from ..functions.graph import components
from .common import map_arrow, table

LEAST_COSINE = 0.95
CODES, WORDS, MEAN_FILTERS, SEED = 12, 256, 4.0, 20240229
#: Vectors of one side of a comparison at most; larger buckets are cut into blocks.
BLOCK = 1024


@lru_cache(maxsize=8)
def codes(dim: int, n: int = CODES, words: int = WORDS, mean: float = MEAN_FILTERS, seed: int = SEED):
    """[(left, right, height)] for each code: matrices from the space to the
    inner products with the words of each half. The height lets a random
    direction pass ``mean`` filters on average; it depends on dim alone."""
    rng = np.random.default_rng([seed, dim])
    probe = rng.normal(size=(2048, dim))
    probe /= np.linalg.norm(probe, axis=1, keepdims=True)
    half, out = max(1, dim // 2), []
    for _ in range(n):
        turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        sides = []
        for a, b in ((0, half), (half, dim)):
            w = rng.normal(size=(words, b - a))
            w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
            sides.append(turn[:, a:b] @ w.T / np.sqrt(2))
        p, q = probe @ sides[0], probe @ sides[1]
        tops = np.sort((np.sort(p, axis=1)[:, -64:, None] + np.sort(q, axis=1)[:, None, -64:]).ravel())
        out.append((*sides, float(tops[-int(mean * len(probe))])))
    return out


def decode(x: np.ndarray, code) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) for all filters that unit vectors pass, and for the
    best filter of each, sorted by vector and filter."""
    left, right, height = code
    p, q = x @ left, x @ right
    v, i = np.nonzero(p >= height - q.max(axis=1)[:, None])
    vs, fs = [np.arange(len(x))], [p.argmax(axis=1) * q.shape[1] + q.argmax(axis=1)]
    for a in range(0, len(v), 1 << 14):
        k, j = np.nonzero(q[v[a : a + (1 << 14)]] >= (height - p[v[a : a + (1 << 14)], i[a : a + (1 << 14)]])[:, None])
        vs.append(v[a : a + (1 << 14)][k]), fs.append(i[a : a + (1 << 14)][k] * q.shape[1] + j)
    pair = np.unique(np.concatenate(vs) * (len(left[0]) * q.shape[1]) + np.concatenate(fs))
    return np.divmod(pair, len(left[0]) * q.shape[1])


def local_parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number reachable from each of 0..n-1 over the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(vectors: np.ndarray, lists: list[np.ndarray], block: np.ndarray, number: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, is first) of the pairs i < j of a bucket that reach the cosine:
    in one block all pairs, of two blocks those across. A pair is first in the
    smallest filter that both passed, and counts only there."""
    x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = np.triu(x @ x.T >= cosine, 1)
    if block[0] != block[-1] or len(set(block.tolist())) > 1:
        hit &= block[:, None] != block
    i, j = np.nonzero(hit)
    if len(i) <= 4 * len(x):
        early = [set(f[f < number].tolist()) for f in lists]
        return i, j, np.array([early[a].isdisjoint(early[b]) for a, b in zip(i.tolist(), j.tolist())], bool)
    owner = np.repeat(np.arange(len(x)), [len(f) for f in lists])
    flat = np.concatenate(lists)
    owner, flat = owner[flat < number], flat[flat < number]
    _, place, many = np.unique(flat, return_inverse=True, return_counts=True)
    owner, place = owner[many[place] > 1], place[many[place] > 1]
    _, place = np.unique(place, return_inverse=True)
    before = np.zeros((len(x), len(x)), bool)
    for a in range(0, int(place.max(initial=-1)) + 1, 2048):
        part = (place >= a) & (place < a + 2048)
        m = np.zeros((len(x), 2048), np.float32)
        m[owner[part], place[part] - a] = 1
        before |= m @ m.T > 0
    return i, j, ~before[i, j]


def near_vectors(vecs: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cosine: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vecs``: id, ``n_links`` (other rows linked
    directly), ``component_id`` (the smallest id reachable) and ``kept``.

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing; so do rows without an id, whose component is null and
    which are not kept. Only vectors of one dimension are compared. Equal
    vectors are one class with a count: copies and repeated rows link with each
    other. Further columns are ignored; an empty table gives none. A class sends
    its vector to each filter it passes (about CODES * MEAN_FILTERS). Buckets
    above ``block`` vectors are cut into blocks, every two of which meet in a
    task of their own, so no task holds a whole dense cluster; pairs are
    counted where they are found and never leave the task.
    """
    v = F.col(vector)
    good = F.coalesce(F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vecs.select(F.col(id_col).alias("id"), F.when(good, v.cast("array<double>")).alias("v"))
    classes = checkpointed(rows.filter("v is not null").groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies")))

    def pass_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                raw = batch.column("v").to_pylist()
                dims: dict[int, list[int]] = {}
                for i, x in enumerate(raw):
                    dims.setdefault(len(x), []).append(i)
                for dim, own in dims.items():
                    x = np.array([raw[i] for i in own])
                    unit = x / np.abs(x).max(axis=1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    who, filters = [], []
                    for k, code in enumerate(codes(dim)):
                        w, f = decode(unit, code)
                        who.append(w), filters.append(f + k * WORDS * WORDS)
                    who, filters = np.concatenate(who), np.concatenate(filters).astype(np.int32)
                    order = np.lexsort((filters, who))
                    who, filters = who[order], filters[order]
                    cuts = np.searchsorted(who, np.arange(len(own) + 1))
                    lists = [filters[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                    body = [y.tobytes() for y in (x.astype(np.float32) if (x.astype(np.float32) == x).all() else x)]
                    take = pa.array(who)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim] * len(who), pa.int32()), pa.array(filters), batch.column("node").take(pa.array(own)).take(take), batch.column("copies").take(pa.array(own)).take(take), pa.array(body, pa.binary()).take(take), pa.array(lists, pa.binary()).take(take)],
                        names=["dim", "filter", "node", "copies", "body", "filters"],
                    )

    node_type = classes.schema["node"].dataType.simpleString()
    met = map_arrow(classes.select("v", "node", "copies"), pass_filters, f"dim int, filter int, node {node_type}, copies bigint, body binary, filters binary")
    # Buckets to be cut are few; without one the vectors are dealt once.
    hot = checkpointed(met.groupBy("dim", "filter").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1"))
    if hot.isEmpty():
        dealt = met.withColumns({"own": F.lit(0), "other": F.lit(0)})
    else:
        cut = met.join(sized(hot), ["dim", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(0).cast("int")
        dealt = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("dim", "filter", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"), "own", "node", "copies", "body", "filters")
    keys = ["dim", "filter", "s", "t"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[tuple]):
            dim, number = rows[0][0], rows[0][1]
            x = np.stack([np.frombuffer(r[6], np.float32 if len(r[6]) == 4 * dim else np.float64) for r in rows]).astype(np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)
            own = np.array([r[4] for r in rows])
            if rows[0][2] != rows[0][3] and own.min() == own.max():
                return []
            i, j, first = compare(x, [np.frombuffer(r[7], np.int32) for r in rows], own, number, cosine)
            if not len(i):
                return []
            copies = np.array([r[8] for r in rows], np.int64)
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, i[first], copies[j[first]])
            np.add.at(links, j[first], copies[i[first]])
            part = local_parts(len(rows), i, j)
            return [(rows[k][5], rows[int(part[k])][5], int(links[k])) for k in np.unique(np.r_[i, j]).tolist()]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((id_type, id_type, pa.int64()))], names=["node", "root", "links"])

        held, last, ready, id_type = [], None, [], None
        for batch in batches:
            id_type = batch.schema.field("node").type
            for row in zip(*(batch.column(c).to_pylist() for c in (*keys, "own", "node", "body", "filters", "copies"))):
                if row[:4] != last:
                    if len(held) > 1:
                        ready += found(held)
                    held, last = [], row[:4]
                    if len(ready) > 8192:
                        yield out(ready)
                        ready = []
                held.append(row)
        if len(held) > 1:
            ready += found(held)
        if ready:
            yield out(ready)

    linked = checkpointed(map_arrow(dealt.repartition(*keys).sortWithinPartitions(*keys), verify, f"node {node_type}, root {node_type}, links bigint"))
    parts = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("node").agg(F.sum("links").alias("near"))
    named = classes.join(counts, "node", "left").join(parts, "node", "left").select("v", "near", "copies", F.coalesce("component", "node").alias("part"))
    all_rows = rows.join(named, "v", "left")
    component = F.coalesce("part", "id")
    return all_rows.select(
        F.col("id").alias(id_col), F.coalesce(F.coalesce("near", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def op3_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
