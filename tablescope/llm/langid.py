"""Language by bit-sliced Bloom filters of character n-grams.

All languages share one table of slots; bit l of a slot belongs to language l
(a slot is a word of 8 to 64 bits, beyond 64 languages several words). The AND of the slots of an n-gram is the mask of all languages that contain it.
Per document the masks are counted for each language, the counts are corrected
for the filter's measured rate of false positives, and the language with the
largest share of known n-grams decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.frames import sized
from .common import map_arrow, slices, table
from .samples import LONGEST, bounded, not_held_out

FOLDS, HELD_OUT = 3, 1
GRAM, HASHES = 4, 3
#: Documents of each language that the filters are filled from, their bytes at
#: most (the first aside), and occurrences that an n-gram needs among them.
PER_LANGUAGE, LEAST_COUNT = 1500, 3
LANGUAGE_BYTES = PER_LANGUAGE * LONGEST
#: Documents of the whole sample: more than SAMPLE / PER_LANGUAGE languages share
#: them alike, each with one document at least.
SAMPLE = 64 * PER_LANGUAGE
#: Slots for each n-gram of the largest language, up to so many slots and beyond.
ROOMY, ROOMY_TOP, TIGHT = 16, 1 << 21, 4
#: Characters that are hashed at a time, and hashes held until they are counted.
PIECE, PENDING = 1 << 18, 1 << 22
UNKNOWN = "und"
#: Odd multipliers, one for each hash function.
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document) of all n-grams that hold two letters or more, and the
    number of letters of each document. Other characters than letters read as
    a space; texts are lower-cased and padded with spaces."""
    low = [t.lower() for t in texts]
    pad = " " * (GRAM // 2)
    cps = np.frombuffer((pad + pad.join(low) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, low), np.int64, len(low)) + len(pad)
    owner = np.repeat(np.arange(len(low)), lens)
    is_letter = letters()[cps]
    c = np.where(is_letter, cps, 32).astype(np.uint64)
    n = len(owner) - GRAM + 1 + len(pad)
    if not texts or n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    count = np.bincount(owner, weights=is_letter[: len(owner)], minlength=len(low)).astype(np.int64)
    h = c[:n].copy()
    some = is_letter[:n].astype(np.int8)
    for k in range(1, GRAM):
        h *= np.uint64(0x100000001B3)
        h += c[k : n + k]
        some += is_letter[k : n + k]
    # A gram belongs to the document its last padding space belongs to; those
    # that reach into the next document's letters are left out.
    doc = owner[np.minimum(np.arange(n), len(owner) - 1)]
    end = np.minimum(np.arange(n) + GRAM - 1 - len(pad), len(owner) - 1)
    keep = (some >= 2) & ((owner[np.maximum(end, 0)] == doc) | (end < 0))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h[keep], doc[keep], count


@dataclass
class LanguageFilter:
    names: list[str]
    slots: np.ndarray  # words x slots
    false_rate: np.ndarray

    def places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        """One slot for each hash function."""
        shift = np.uint64(64 - (self.slots.shape[1] - 1).bit_length())
        for k in range(HASHES):
            yield ((h * ODD[k]) >> shift).astype(np.int64)

    def bits(self, words: np.ndarray, k: int) -> np.ndarray:
        """Bit of language k, of words x anything."""
        word, bit = divmod(k, 8 * self.slots.itemsize)
        return (words[word] >> np.array(bit, words.dtype)) & np.array(1, words.dtype)

    def masks(self, h: np.ndarray) -> np.ndarray:
        out = None
        for p in self.places(h):
            out = self.slots[:, p] if out is None else out & self.slots[:, p]
        return out

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(corrected share of known n-grams per document and language, letters)."""
        h, doc, count = gram_hashes(texts)
        total = np.bincount(doc, minlength=len(texts)).astype(float)
        out = np.zeros((len(texts), len(self.names)))
        if len(h) and self.names:
            m = self.masks(h)
            for k in range(len(self.names)):
                hits = np.bincount(doc, weights=self.bits(m, k), minlength=len(texts))
                out[:, k] = np.clip((hits / np.maximum(total, 1) - self.false_rate[k]) / (1 - self.false_rate[k]), 0, 1)
        return out, count


def pieces(texts: list[str], size: int = PIECE) -> Iterator[list[str]]:
    """The texts in lists of about ``size`` characters; longer ones are cut
    behind a character that is no letter, where there is one."""
    own, held = [], 0
    for t in texts:
        at = 0
        while at < len(t):
            end = min(len(t), at + size)
            if end < len(t):
                end = next((e for e in range(end, max(at, end - 1000), -1) if not t[e - 1].isalpha()), end)
            own.append(t[at:end])
            held, at = held + end - at, end
            if held >= size:
                yield own
                own, held = [], 0
    if own:
        yield own


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, occurrences) of the different n-grams of the texts."""
    values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []

    def counted():
        new, n = np.unique(np.concatenate(waiting), return_counts=True)
        both, place = np.unique(np.concatenate([values, new]), return_inverse=True)
        return both, np.bincount(place, weights=np.concatenate([counts, n]), minlength=len(both)).astype(np.int64)

    for part in pieces(texts):
        waiting.append(gram_hashes(part)[0])
        if sum(map(len, waiting)) >= PENDING:
            values, counts = counted()
            waiting = []
    return counted() if waiting else (values, counts)


def common_grams(texts: list[str], least: int = LEAST_COUNT) -> np.ndarray:
    """The n-grams that occur ``least`` times, or all if none does."""
    values, counts = gram_counts(texts)
    common = values[counts >= least]
    return common if len(common) else values


def fill(sets: dict[str, np.ndarray]) -> LanguageFilter:
    """The filter of n-gram hashes by language. The slots follow from the
    largest set, so that no language fills more than about half of its bits."""
    names = sorted(sets)
    most, size = max([1, *map(len, sets.values())]), 1 << 12
    while size < min(ROOMY * most, ROOMY_TOP) or size < TIGHT * most:
        size *= 2
    kind = next((k for k, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(names) <= bits), np.uint64)
    width = 8 * np.dtype(kind).itemsize
    f = LanguageFilter(names, np.zeros((-(-max(len(names), 1) // width), size), kind), np.zeros(len(names)))
    for k, name in enumerate(names):
        for p in f.places(sets[name]):
            np.bitwise_or.at(f.slots[k // width], p, np.array(1 << k % width, kind))
    f.false_rate = np.array([float(f.bits(f.slots, k).mean()) ** HASHES for k in range(len(names))])
    return f


def build(samples: dict[str, list[str]], least: int = LEAST_COUNT) -> LanguageFilter:
    """Fill the filter from texts by language (a bounded sample, on the driver)."""
    return fill({name: common_grams(texts, least) for name, texts in samples.items()})


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, text: str = "text", lang: str = "lang", id_col: str = "doc_id", language_bytes: int = LANGUAGE_BYTES,
          sample: int = SAMPLE, longest: int = LONGEST) -> LanguageFilter:
    """From at most ``per_language`` documents and ``language_bytes`` bytes of
    each language that are not held out, in order of a hash of their id; texts
    above ``longest`` bytes fill up what shorter ones leave. Any number of
    languages: where there are more than ``sample / per_language``, they share
    ``sample`` documents and their bytes alike. The driver holds the sample."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(id_col).isNotNull() & F.col(text).isNotNull() & not_held_out(id_col, FOLDS, HELD_OUT))
    known = known.select(F.col(id_col).alias("i"), F.col(lang).alias("l"), F.octet_length(text).alias("b"), F.col(text).alias("t"))
    languages = known.select("l").distinct().count()
    own = max(1, min(per_language, sample // max(languages, 1)))
    ids = bounded(known.select("i", "l", "b"), "l", "i", "b", own, language_bytes * own // per_language, longest).distinct()
    rows = known.join(sized(ids), ["i", "l", "b"]).select("l", "t").distinct()
    samples: dict[str, list[str]] = {}
    for r in rows.toLocalIterator():
        samples.setdefault(r["l"], []).append(r["t"])
    return build(samples)


def predict(docs: DataFrame, f: LanguageFilter, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, the columns of ``keep``, ``lang_pred``,
    ``score`` (the winner's part of all corrected shares) and ``coverage`` (its
    share of known n-grams).

    Null texts and texts without a letter are ``und`` with score 0. Of equal
    shares the first name wins, also if no n-gram is known. Repeated rows get
    equal answers; null ids stay null; an empty table gives none. Whole texts
    are read, in one scan without a shuffle.
    """
    types = {x.name: x.dataType.simpleString() for x in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text, 1 << 19):
            share, count = f.shares([t.decode("utf-8", "replace") for t in texts])
            if f.names:
                best = share.argmax(axis=1)
                top = share[np.arange(len(best)), best]
            else:
                best, top = np.zeros(len(texts), int), np.zeros(len(texts))
            known = (count > 0) & bool(f.names)
            total = share.sum(axis=1)
            score = np.where(known & (total > 0), top / np.where(total > 0, total, 1), 0.0)
            names = [f.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in (id_col, *keep)], pa.array(names, pa.string()), pa.array(score), pa.array(np.where(known, top, 0.0))],
                names=[id_col, *keep, "lang_pred", "score", "coverage"],
            )

    return map_arrow(docs.select(*dict.fromkeys((id_col, text, *keep))), run, ", ".join(f"`{c}` {types[c]}" for c in (id_col, *keep)) + ", lang_pred string, score double, coverage double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(~not_held_out("doc_id", FOLDS, HELD_OUT), F.lit(False))
    return predict(docs, learn(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score", "coverage")
