"""Near-copies by the similarity of word-shingle sets.

Texts are near-copies when the Jaccard similarity of their sets of word
shingles reaches a threshold. Banded minima of the sets find candidates: at
similarity 0.8 all bands of a pair differ with probability
(1 - 0.8^BAND_ROWS)^BANDS, 3 in a million. Every candidate is verified on its
whole sets, so no link is wrong.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..functions.frames import checkpointed, leaving_nothing, sized
from ..functions.graph import components
from .common import map_arrow, slices
from .simhash import shingle_hashes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 32, 5
#: Rounds in which a member is compared with one centre, before what is still
#: apart in a bucket is compared within tasks of so many sets of each side. So
#: few members are compared in full at once; the links are the same.
CENTRE_ROUNDS, LEFT, RIGHT, FEW = 3, 512, 4096, 10_000

MIX = np.random.default_rng(5).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The different shingle hashes of a lower-cased text, in order."""
    low = text.decode("utf-8", "replace").lower().encode()
    parts = list(shingle_hashes(low, size))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes(), 7)


def band_keys(s: np.ndarray) -> list[int]:
    """One number for each band, from the minima of its rows; none without a shingle."""
    if not len(s):
        return []
    least = np.full(MIX.shape[1], np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 1024):
        h = (s[a : a + 1024, None] ^ MIX[0]) * MIX[1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(least, h.min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(least[i * BAND_ROWS : (i + 1) * BAND_ROWS].tobytes(), i) for i in range(BANDS)]


def marks(docs: DataFrame, text: str, id_col: str, size: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, the columns of ``keep``, key, n, bands): the key of the set, its
    size and its band keys."""
    types = {x.name: x.dataType.simpleString() for x in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text):
            sets = [shingle_set(t, size) for t in texts]
            keys = np.array([set_key(s) for s in sets], np.uint64).view(np.int64)
            bands = [np.array(band_keys(s), np.uint64).view(np.int64).tolist() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in (id_col, *keep)], pa.array(keys), pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=[id_col, *keep, "key", "n", "bands"],
            )

    return map_arrow(docs.select(id_col, text, *keep), run, ", ".join(f"`{c}` {types[c]}" for c in (id_col, *keep)) + ", key bigint, n bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame, text: str, size: int = SHINGLE) -> DataFrame:
    """(key, hashes): the whole set of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, text, 1 << 19):
            sets = [shingle_set(t, size) for t in texts]
            keys = np.array([set_key(s) for s in sets], np.uint64).view(np.int64)
            ends = np.cumsum([0, *map(len, sets)])
            values = np.concatenate(sets).view(np.int64)
            lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys), lists], names=["key", "hashes"])

    return map_arrow(docs.select(text), run, "key bigint, hashes array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. Native, so that the
    two sets of a pair are never copied to a worker."""
    one, two = (sets.select(F.col("key").alias(c), F.col("hashes").alias(f"h{c}")) for c in "ab")
    both = F.size(F.array_intersect("ha", "hb"))
    counted = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("ha") + F.size("hb")).alias("all"))
    return counted.filter(F.col("both") / (F.col("all") - F.col("both")) >= similarity).select("a", "b")


def linked_within(rows: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) between parts of one block: every set of the left side
    against every set of the right side of another part, but for parts that
    are connected already. At most one link fewer than parts."""
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    keys, parts = rows.column("key").to_numpy(), rows.column("part").to_numpy()
    sets = [np.sort(x.values.to_numpy()) for x in rows.column("hashes")]
    left = np.flatnonzero(rows.column("li").to_numpy() == i)
    right = np.flatnonzero(rows.column("rj").to_numpy() == j)
    sizes = np.array([len(sets[k]) for k in right], np.int64)
    flat, first = np.concatenate([np.zeros(0, np.int64), *[sets[k] for k in right]]), (np.cumsum(sizes) - sizes)
    _, root = np.unique(parts, return_inverse=True)
    links = []
    for x in left.tolist() if len(right) else []:
        own = sets[x]
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        both = np.add.reduceat(own[at] == flat, first, dtype=np.int64)
        near = both / (len(own) + sizes - both) >= similarity
        for y in right[near & (root[right] != root[x])].tolist():
            if root[y] != root[x]:
                root[root == root[y]] = root[x]
                links.append((min(keys[x], keys[y]), max(keys[x], keys[y])))
    return pa.table([pa.array([k for k, _ in links], pa.int64()), pa.array([k for _, k in links], pa.int64())], names=["a", "b"])


def blocks(live: DataFrame, mixed: DataFrame) -> DataFrame:
    """(bucket, i, j, key, part, li, rj): members of mixed buckets in blocks.
    All but those of a bucket's largest part are dealt to left blocks, all to
    right blocks; block (i, j) holds left block i and right block j."""
    by_part = live.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("m"))
    main = by_part.groupBy("bucket").agg(F.max_by("part", F.struct("m", "part")).alias("main"), F.sum("m").alias("m"), F.max("m").alias("most")).join(mixed, "bucket", "left_semi")
    met = live.join(main, "bucket").withColumn("ni", F.ceil((F.col("m") - F.col("most")) / LEFT)).withColumn("nj", F.ceil(F.col("m") / RIGHT))
    deal = lambda n, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.col(n)).cast("int")
    met = met.withColumn("li", F.when(F.col("part") != F.col("main"), deal("ni", 1)).otherwise(-1)).withColumn("rj", deal("nj", 2))
    upto = lambda n: F.sequence(F.lit(0), (F.col(n) - 1).cast("int"))
    as_left = F.when(F.col("li") >= 0, F.transform(upto("nj"), lambda j: F.struct(F.col("li").alias("i"), j.alias("j")))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    as_right = F.transform(upto("ni"), lambda i: F.struct(i.alias("i"), F.col("rj").alias("j")))
    return met.select("bucket", "key", "part", "li", "rj", F.explode(F.array_distinct(F.concat(as_left, as_right))).alias("at")).select("bucket", "at.*", "key", "part", "li", "rj")


def near_sets(docs: DataFrame, text: str = "text", id_col: str = "doc_id", size: int = SHINGLE, similarity: float = SIMILARITY, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, the columns of ``keep`` and ``part``,
    equal for rows reachable over pairs of at least the similarity.

    Texts of equal sets are one class; null texts and texts without a word are
    one too, and texts shorter than a shingle are one shingle. Classes meet in
    buckets of one band; buckets of equal members count once. In each of a few
    rounds every member of a bucket that is not yet one part is compared with
    one centre, the one it shares most buckets with, so a large group of
    near-copies costs about its size. What is still apart then is compared in
    full inside tasks, with one copy of a set per bucket and block: no pair
    that shares a bucket is left out, and none becomes a row unless it links.
    """
    own = checkpointed(marks(docs, text, id_col, size, keep))
    classes = own.groupBy("key").agg(F.min(id_col).alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    in_bands = classes.select("key", "n", F.explode("bands").alias("bucket"))
    # What a bucket holds, as count and two sums of hashes: equal ones are one.
    held = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), *[F.bit_xor(F.xxhash64("key", F.lit(s))).alias(f"x{s}") for s in (1, 2)]).filter("m > 1")
    one = held.groupBy("m", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket")
    met = checkpointed(in_bands.join(one, "bucket"))
    ids = classes.join(met.select("key").distinct(), "key", "left_semi").select(F.col("least").alias(id_col)).distinct()
    sets = shingle_sets(docs.select(id_col, text).join(sized(ids), id_col, "left_semi"), text, size)
    sets = checkpointed(sets.groupBy("key").agg(F.first("hashes").alias("hashes")))
    parts = edges = tested = None
    for turn in range(CENTRE_ROUNDS + 1):
        live = met.withColumn("part", F.col("key")) if parts is None else met.join(parts, "key", "left").withColumn("part", F.coalesce("part", "key"))
        live = checkpointed(live)
        mixed = live.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("bucket")
        met = live = checkpointed(live.join(mixed, "bucket", "left_semi"))
        met = met.drop("part")
        with leaving_nothing(docs.sparkSession):
            n = live.count()
        if not n:
            break
        last = turn == CENTRE_ROUNDS or n <= FEW
        if last:
            names = ["bucket", "i", "j", "key", "part", "li", "rj"]
            full = blocks(live, live.select("bucket").distinct()).join(sets, "key").select(*names, "hashes")
            found = checkpointed(full.groupBy("bucket", "i", "j").applyInArrow(lambda rows: linked_within(rows, similarity), "a bigint, b bigint").distinct())
        else:
            # The order of centres is another one in every round, and the same in all buckets.
            centre = F.min_by(F.struct("key", "n", "part"), F.xxhash64("key", F.lit(turn)))
            other = live.groupBy("bucket").agg(centre.alias("c")).select("bucket", *[F.col(f"c.{c}").alias(f"o_{c}") for c in ("key", "n", "part")])
            pairs = live.join(other, "bucket").filter("part <> o_part").filter(F.least("n", "o_n") >= similarity * F.greatest("n", "o_n") - 0.001)
            pairs = pairs.groupBy("key", "o_key").agg(F.count(F.lit(1)).alias("m"))
            pairs = pairs.select("key", "o_key", "m", F.least("key", "o_key").alias("a"), F.greatest("key", "o_key").alias("b"))
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = pairs.groupBy("key").agg(F.max_by(F.struct("a", "b"), F.struct("m", "o_key")).alias("p")).select("p.a", "p.b").distinct()
            pairs = checkpointed(pairs)
            found = checkpointed(verified(pairs, sets, similarity))
            tested = pairs if tested is None else checkpointed(tested.union(pairs))
        edges = found if edges is None else checkpointed(edges.union(found))
        parts = components(edges).select(F.col("node").alias("key"), F.col("component").alias("part"))
        if last:
            break
    named = own.select(id_col, *keep, "key")
    return named.withColumnRenamed("key", "part") if parts is None else named.join(parts, "key", "left").select(id_col, *keep, F.coalesce("part", "key").alias("part"))
