"""Packing by power-of-two decomposition.

The ids of a document are cut into pieces whose lengths are the powers of two
of its length, longest first: pieces of 4096 as often as they fit, then the
binary digits of the rest. Pieces of one length form a bucket; every piece is a
sequence of its own, so no sequence crosses documents, no sequence is padded,
and a batch of a bucket is a full rectangle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_arrow, slices, table
from .tokenizer_files import WORD_BPE
from .tokens import encoder, vocabulary

MAX_LENGTH = 4096
END_ID = 2


def piece_lengths(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, length) of all pieces, in order, of documents of n ids."""
    bits = longest.bit_length() - 1
    digits = [((n >> k) & 1) for k in range(bits - 1, -1, -1)]
    counts = np.stack([n >> bits, *digits], axis=1)
    lengths = np.tile(np.r_[longest, 1 << np.arange(bits - 1, -1, -1)], (len(n), 1))
    return np.repeat(np.arange(len(n)), counts.sum(axis=1)), np.repeat(lengths.ravel(), counts.ravel())


def pack_power_of_two(docs: DataFrame, path: str = WORD_BPE, text: str = "text", id_col: str = "doc_id", longest: int = MAX_LENGTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``bucket`` (log2 of the length), ``sequence_id``,
    ``offset`` (always 0), and with ``keep_ids`` the ``ids`` themselves.

    A null or empty text is the end id alone: one piece of length 1. Equal
    rows are packed each for itself; null ids stay null; further columns are
    ignored; an empty table gives no piece. ``longest`` must be a power of
    two. One scan, no shuffle. Sequence numbers are unique over all partitions
    (partition number and place in it); which number a piece gets has no
    meaning beyond that. Writing ``partitionBy("bucket")`` gives equal lengths
    in a file.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    v, id_type = vocabulary(path), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(v, path)
        for part, texts in slices(batches, text):
            ids, per = enc.ids(texts)
            ends = np.cumsum(per)
            ids, n = np.insert(ids.astype("<u4"), ends, end_id), per + 1
            doc, length = piece_lengths(n, longest)
            stop = np.cumsum(length)
            first = stop - length
            start = first - (np.cumsum(n) - n)[doc]
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(first.tolist(), stop.tolist())]
            out = [
                part.column(id_col).take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                pa.array(n[doc], pa.int64()), pa.array(np.log2(length).astype(np.int32), pa.int32()),
            ]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "bucket"]
            if keep_ids:
                cuts = np.r_[0, stop].astype(np.int32)
                out, names = [*out, pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32)))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"`{id_col}` {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, bucket int" + ", ids array<int>" * keep_ids
    return map_arrow(docs.select(id_col, text), run, schema).withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_power_of_two(table(spark, sf_dir, "documents"))
