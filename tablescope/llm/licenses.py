"""License scans by fuzzy short-notice search.

A text is reduced to its lower-cased words, one space between. A notice that
occurs with at most k edits keeps one of any k+1 pieces of it unharmed
(pigeonhole), so exact search for all pieces of all notices finds every place
where one can stand. There the regex library's bounded-error matching counts
the edits. Base phrases are notices without edits that must stand as whole
words.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_arrow, slices, table

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Words of usual notices and their labels.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this software is provided as is without any express or implied warranty", "zlib"),
    ("boost software license version 1 0", "boost"),
    ("eclipse public license version 2 0", "epl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("cc0 1 0 universal public domain dedication", "cc0"),
)
#: One edit is allowed for each so many characters of a notice.
CHARS_PER_EDIT = 12

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Match:
    """A place in the words of a text: code points [start, end)."""

    start: int
    end: int
    edits: int
    notice: int


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of nearly equal length, with their places."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Searcher:
    """Notices with their allowed edits; those of ``whole`` must stand as whole words."""

    def __init__(self, notices: tuple[tuple[str, str], ...], base: tuple[tuple[str, str], ...], chars_per_edit: int):
        self.text = [t for t, _ in (*base, *notices)]
        self.label = [x for _, x in (*base, *notices)]
        self.base = len(base)
        self.edits = [0 if k < self.base else len(t) // chars_per_edit for k, t in enumerate(self.text)]
        self.pattern = [regex.compile(f"(?e)(?:{regex.escape(t)}){{e<={e}}}") for t, e in zip(self.text, self.edits)]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, t in enumerate(self.text):
            for at, piece in pieces(t, self.edits[k]):
                seeds.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def windows(self, words: str) -> dict[int, list[list[int]]]:
        """Notice -> places where it can stand, those that touch made one."""
        out: dict[int, list[list[int]]] = {}
        for last, (size, uses) in self.automaton.iter(words):
            for k, at in uses:
                e = self.edits[k]
                a = last + 1 - size - at
                out.setdefault(k, []).append([max(0, a - e), min(len(words), a + len(self.text[k]) + e)])
        for k, found in out.items():
            if k >= self.base:
                found.sort()
                one = [found[0]]
                for a, b in found[1:]:
                    if a <= one[-1][1]:
                        one[-1][1] = max(b, one[-1][1])
                    else:
                        one.append([a, b])
                out[k] = one
        return out

    def matches(self, words: str) -> list[Match]:
        """All base places and verified notices, by start."""
        out = []
        for k, found in self.windows(words).items():
            for a, b in found:
                if k < self.base:
                    if (a == 0 or words[a - 1] == " ") and (b == len(words) or words[b] == " "):
                        out.append(Match(a, b, 0, k))
                else:
                    out += [Match(m.start(), m.end(), sum(m.fuzzy_counts), k) for m in self.pattern[k].finditer(words, a, b)]
        return sorted(out, key=lambda m: (m.start, m.end, m.notice))

    def settled(self, found: list[Match]) -> list[Match]:
        """The base places, and of notices that overlap the one of fewest
        edits for its length, then the longest, the first, the first listed."""
        notices = sorted((m for m in found if m.notice >= self.base), key=lambda m: (m.edits / len(self.text[m.notice]), m.start - m.end, m.start, m.notice))
        starts: list[int] = []
        kept: list[Match] = []
        for m in notices:
            i = bisect.bisect_left(starts, m.start)
            if (i and kept[i - 1].end > m.start) or (i < len(kept) and kept[i].start < m.end):
                continue
            starts.insert(i, m.start), kept.insert(i, m)
        return sorted([m for m in found if m.notice < self.base] + kept, key=lambda m: (m.start, m.end, m.notice))

    def likeness(self, m: Match) -> float:
        return 1 - m.edits / len(self.text[m.notice])


@lru_cache(maxsize=8)
def searcher(notices: tuple, base: tuple, chars_per_edit: int) -> Searcher:
    return Searcher(notices, base, chars_per_edit)


def places(text: bytes, words: bytes, found: list[Match]) -> list[tuple[int, int, int]]:
    """(first word, start, end) of each match: its first word's number and
    code points of the text as it was."""
    raw, own = np.frombuffer(text, np.uint8), np.frombuffer(words, np.uint8)
    chars = np.flatnonzero((own & 0xC0) != 0x80)
    number = np.cumsum(own == 32)
    # The k-th byte of all words is the k-th byte of the text that is in a word.
    solid = np.flatnonzero(np.frombuffer(text.translate(_TO_WORDS), np.uint8) != 32)
    rank = np.arange(len(own)) - number
    point = np.cumsum((raw & 0xC0) != 0x80) - 1
    out = []
    for m in found:
        a, b = chars[m.start], chars[m.end - 1]
        a, b = a + (own[a] == 32), b - (own[b] == 32)
        out.append((int(number[a]), int(point[solid[rank[a]]]), int(point[solid[rank[b]]]) + 1))
    return out


def scan(docs: DataFrame, text: str = "text", id_col: str = "doc_id", notices=NOTICES, base=BASE, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_base`` (places of
    base phrases), ``first_word`` and ``last_word`` (their smallest and
    largest start in words from 0, else null), ``base_labels``, ``labels``
    (sorted, comma-joined), ``score`` (likeness of the best match, 1 for a base
    phrase, 0 without one) and ``spans``: label, start, end (code points of
    the text, end exclusive), edits and notice of every match.

    A null or empty text has no word: zeros, nulls and empty strings. Equal
    rows give equal rows; null ids stay null; further columns are ignored; an
    empty table gives no row. One scan, no shuffle; the whole of each text is
    searched, and every notice within its edits is found.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("notice", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = searcher(notices, base, chars_per_edit)
        for part, texts in slices(batches, text):
            rows = []
            for t in texts:
                words = t.translate(_TO_WORDS).split()
                joined = b" ".join(words)
                found = s.settled(s.matches(joined.decode("utf-8", "replace")))
                at = places(t, joined, found) if found else []
                own = [w for m, (w, _, _) in zip(found, at) if m.notice < s.base]
                labels = [s.label[m.notice] for m in found]
                rows.append((
                    len(words), len(own), min(own, default=None), max(own, default=None),
                    ",".join(sorted({x for m, x in zip(found, labels) if m.notice < s.base})), ",".join(sorted(set(labels))), max(map(s.likeness, found), default=0.0),
                    [{"label": x, "start": a, "end": b, "edits": m.edits, "notice": s.text[m.notice]} for m, x, (_, a, b) in zip(found, labels, at)],
                ))
            types = [*[pa.int64()] * 4, *[pa.string()] * 2, pa.float64(), span]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([part.column(id_col), *[pa.array(c, k) for c, k in zip(zip(*rows), types)]], names=[id_col, *names])

    schema = f"`{id_col}` {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,edits:int,notice:string>>"
    return map_arrow(docs.select(id_col, text), run, schema)


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["label"], x["start"], x["end"], x["edits"]))
    return found.withColumn("spans", F.array_join(spans, ","))
