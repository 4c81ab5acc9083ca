"""Quality rules with a line sequence labeller.

Plain rules fail texts that are too short or repeat themselves. For the others
a linear-chain conditional random field tags each line as content or
boilerplate by Viterbi decoding, and the share of word characters in content
lines decides. The field learns from documents labelled good or bad; the lines
of a bad document count as boilerplate, those of a good one as content.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, slices, table
from .crf import Chain, train, viterbi
from .samples import PER_CLASS, labelled_sample

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Content share that keeps a document.
LEAST_CONTENT = 0.5
#: No document is held out from fitting: the verdict is a filter, not a forecast.
FOLDS, HELD_OUT = 1, -1
SPACE = b" \t\n\v\f\r"
FEATURES = 24


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    c = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    pair = c[:-1] * len(codes) + c[1:]
    _, pair = np.unique(pair, return_inverse=True)
    _, inverse, count = np.unique(pair[:-1] * len(codes) + c[2:], return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : n + k] |= twice
    return int(hit.sum())


def char_count(b: bytes) -> int:
    return len(b) if b.isascii() else len(b.decode("utf-8", "replace"))


def line_features(line: bytes, words: list[bytes], repeated: bool) -> list[int]:
    """Numbers of the features that a line shows."""
    n = len(words)
    chars = sum(map(len, words)) or 1
    symbols = chars - len(line.translate(None, SYMBOLS + SPACE))
    bang = line.count(b"!!")
    upper = sum(w.isupper() for w in words)
    digits = chars - len(line.translate(None, b"0123456789" + SPACE))
    same = sum(a == b for a, b in zip(words, words[1:]))
    out = [0 if n <= 2 else 1 if n <= 6 else 2 if n <= 20 else 3]
    out.append(4 + min(3, 10 * symbols // chars))
    out.append(8 + min(2, 4 * upper // n))
    out.append(11 + min(2, 4 * bang // n))
    out.append(14 + min(2, 6 * digits // chars))
    out.append(17 + min(2, 6 * same // n))
    out.append(20 if repeated else 21)
    out.append(22 if line.rstrip()[-1:] in (b".", b"!", b"?") else 23)
    return out


def lines_of(text: bytes) -> tuple[list[list[int]], list[int], int]:
    """(features of each line with a word, its word characters, lines that
    equal an earlier one)."""
    seen: set[bytes] = set()
    rows, sizes, dup = [], [], 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again = line in seen
        dup += again
        seen.add(line)
        rows.append(line_features(line, words, again))
        sizes.append(char_count(b"".join(words)))
    return rows, sizes, dup


@dataclass
class LineModel:
    weights: np.ndarray
    bias: float
    chain: Chain

    def content(self, docs: list[list[list[int]]]) -> np.ndarray:
        """Viterbi tag of each line of all documents: 1 content, 0 boilerplate."""
        n = np.fromiter(map(len, docs), np.int64, len(docs))
        flat = [r for d in docs for r in d]
        odds = self.weights[np.array(flat, np.int64).reshape(len(flat), -1)].sum(axis=1) + self.bias if flat else np.zeros(0)
        first = np.zeros(len(flat), bool)
        first[(np.cumsum(n) - n)[n > 0]] = True
        return viterbi(odds, first, self.chain)


def fit(texts: list[str], y: np.ndarray, weight: np.ndarray) -> LineModel:
    """On a bounded sample, on the driver. Without bad examples every line is content."""
    docs = [lines_of(t.encode())[0] for t in texts]
    n = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = np.array([r for d in docs for r in d], np.int64)
    owner = np.repeat(np.arange(len(docs)), n)
    if not len(flat) or len(set(y[owner].tolist())) < 2:
        return LineModel(np.zeros(FEATURES), 1.0, Chain())
    first = np.r_[True, owner[1:] != owner[:-1]]
    item, token = np.unique(flat, axis=0, return_inverse=True)
    rows = np.repeat(np.arange(len(item)), item.shape[1])
    return LineModel(*train(rows, item.ravel(), token.ravel(), first, y[owner], len(item), FEATURES, rounds=80))


def assess(docs: DataFrame, model: LineModel, text: str = "text", id_col: str = "doc_id", least_content: float = LEAST_CONTENT) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``content_share`` and ``kept``.

    A null or empty text has no word and fails. Repeated rows give equal rows;
    null ids stay null; further columns are ignored; an empty table gives none.
    Whole texts are read, in one scan without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text):
            words = [t.split() for t in texts]
            lines = [lines_of(t) for t in texts]
            tags = model.content([x[0] for x in lines])
            size = np.array([s for x in lines for s in x[1]], np.int64)
            owner = np.repeat(np.arange(len(texts)), [len(x[0]) for x in lines])
            total = np.bincount(owner, weights=size, minlength=len(texts))
            share = np.bincount(owner, weights=size * tags, minlength=len(texts)) / np.maximum(total, 1)
            n = np.fromiter(map(len, words), np.int64, len(texts))
            repeat = np.fromiter(map(repeated_words, words), np.int64, len(texts))
            failed = (n < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * n)
            symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(n), pa.array(total.astype(np.int64)), pa.array(symbols, pa.int64()), pa.array([x[2] for x in lines], pa.int64()), pa.array(repeat), pa.array(failed), pa.array(share), pa.array(~failed & (share >= least_content))],
                names=[id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"],
            )

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, content_share double, kept boolean"
    return map_arrow(docs.select(id_col, text), run, schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return assess(docs, fit(*labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", FOLDS, HELD_OUT, PER_CLASS)))
