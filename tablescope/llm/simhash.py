"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint gets a vector m(i) of r + 1 bits, none of them zero. For
each nonzero vector v of r + 1 bits there is one table, whose mask keeps the
bits with an odd number of common ones of m(i) and v. The vectors of any r
differing bits span at most r dimensions, so some v is orthogonal to all of
them: in that table the two fingerprints look the same. No pair within the
radius is missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.frames import checkpointed
from ..functions.graph import components
from .common import map_arrow, slices, table

SHINGLE, SEED, RADIUS = 3, 42, 2
SPACE = re.compile(rb"[ \t-\r]")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The kept bits of each table, as unsigned 64-bit numbers."""
    top = 1 << (radius + 1)
    own = [1 + i % (top - 1) for i in range(64)]
    return [sum(1 << i for i in range(64) if (own[i] & v).bit_count() % 2) for v in range(1, top)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text of any length, some MB at a time."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def shingle_hashes(text: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles of a text, in blocks."""
    tail: list[bytes] = []
    short = True
    for words in word_blocks(text.lower()):
        words = tail + words
        if len(words) >= size:
            short = False
            joined = b" ".join(words)
            lens = np.fromiter(map(len, words), np.int64, len(words))
            start = np.cumsum(lens + 1) - lens - 1
            n = len(words) - size + 1
            yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start[:n].tolist(), (start + lens)[size - 1 :].tolist())], np.uint64)
        tail = words[-(size - 1) :] if size > 1 else []
    if short and tail:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)


def simhash(text: bytes) -> int:
    """Majority of every bit over all shingles; zero without a word."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text):
        for a in range(0, len(h), 65536):
            part = h[a : a + 65536]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number; null text: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text):
            fps = np.array([simhash(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(fps)], names=[id_col, "fp"])

    return map_arrow(docs.select(id_col, text), run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp bigint")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join all different fingerprints within the radius.

    Fingerprints meet in the tables of the masks; those alone in all their
    buckets leave. Inside a bucket the differing bits lie outside the mask, so
    a fingerprint takes every centre reached by flipping up to radius / 2 of
    those bits. Fingerprints of one centre are within the radius of each other,
    at most 65 for radius 2, and are linked to the smallest; two fingerprints
    within the radius have a common centre. So no bucket is ever compared pair
    by pair, however many fingerprints it holds.
    """
    if radius != 2:
        raise ValueError("the centres are written for radius 2")
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for v, m in enumerate(masks)]))
    in_tables = fps.select("fp", tables.alias("t")).select("fp", "t.v", "t.key")
    shared = in_tables.groupBy("v", "key").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).filter("first < last").select("v", "key")
    flips = F.array(*[F.array(*[F.lit(0).cast("bigint"), *[F.lit(signed(1 << i)) for i in range(64) if not m >> i & 1]]) for m in masks])
    met = in_tables.join(shared, ["v", "key"])
    centres = met.select("fp", F.explode(F.get(flips, F.col("v"))).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    stars = centres.groupBy("centre").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return stars.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` and ``component_id``, the
    smallest id reachable over links.

    Null and empty texts have fingerprint zero and are linked like any other.
    Equal texts and repeated rows share a fingerprint and a component. Null ids
    take part, but are no component's smallest id unless nothing else is in it
    (then it is null). Further columns are ignored; an empty table gives none.
    """
    own = checkpointed(fingerprints(docs, text, id_col))
    classes = own.groupBy("fp").agg(F.min(id_col).alias("least"))
    parts = components(links(classes.select("fp")))
    named = classes.join(parts, classes.fp == parts.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("part"))
    smallest = named.groupBy("part").agg(F.min("least").alias("component_id"))
    of_class = named.join(smallest, "part").select("fp", "component_id")
    return own.join(of_class, "fp").select(id_col, "fp", "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
