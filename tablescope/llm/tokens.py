"""BPE encoding and decoding of whole texts, by batched numpy merge rounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import Encoder, Vocabulary
from .common import map_arrow, slices, table
from .tokenizer_files import WORD_BPE


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Decoder:
    """Text of ids: the tokens joined by one space, as a tokenizer without a
    decoder joins them; unknown ids are left out."""

    def __init__(self, v: Vocabulary):
        self.token = [v.tokens.get(i, "").encode() for i in range(v.size)]

    def text(self, ids: list[int]) -> bytes:
        return b" ".join([self.token[i] for i in ids])


_ENCODERS: dict[str, Encoder] = {}


def encoder(v: Vocabulary, key: str) -> Encoder:
    """One encoder for a worker process, kept from task to task."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(v)
    return _ENCODERS[key]


def encode_decode(docs: DataFrame, path: str = WORD_BPE, text: str = "text", id_col: str = "doc_id", keep_tokens: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256``; with ``keep_tokens`` also ``ids`` and ``decoded``.

    A null or empty text has no ids, its digests are those of the empty
    string. Repeated rows and equal texts give equal rows; null ids stay null;
    further columns are ignored. The vocabulary is read on the driver and sent
    with the task (a few MB, fixed by the file). One scan, no shuffle: a task
    holds one slice of its texts at a time.
    """
    v, id_type = vocabulary(path), docs.schema[id_col].dataType.simpleString()
    decimal = [str(i).encode() for i in range(v.size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, dec = encoder(v, path), Decoder(v)
        for part, texts in slices(batches, text):
            ids, per = enc.ids(texts)
            ids, ends = ids.tolist(), np.cumsum(per).tolist()
            hashes, back, kept, texts_back = [], [], [], []
            for a, b in zip([0, *ends], ends):
                own = ids[a:b]
                decoded = dec.text(own)
                hashes.append(hashlib.sha256(b" ".join([decimal[i] for i in own])).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
                if keep_tokens:
                    kept.append(own), texts_back.append(decoded.decode())
            out = [part.column(id_col), pa.array(per, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_tokens:
                out, names = [*out, pa.array(kept, pa.list_(pa.int32())), pa.array(texts_back, pa.string())], [*names, "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = f"`{id_col}` {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_tokens
    return map_arrow(docs.select(id_col, text), run, schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
