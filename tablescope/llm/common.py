"""Small helpers of the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task holds as Python objects at a time.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column) -> list[bytes]:
    """The values of an Arrow string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut record batches so that each part holds about ``limit`` bytes of
    text; one longer text is a part of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lens) // limit)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                part = batch.slice(a, b - a)
                yield part, text_bytes(part.column(text))


def release() -> None:
    """Give memory that a task has freed back to the system: a Python worker
    serves many tasks, and what it only holds counts against its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release()

    return df.mapInArrow(run, schema)
