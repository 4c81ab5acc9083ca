"""Suffix-array dedup: byte strings of a set length that occur twice.

Where a text starts to repeat is found in four steps, each a Spark job step.

1. Every window of ``width`` bytes picks the anchor of smallest hash among its
   ``GRAM``-byte grams (the leftmost of equals). Equal windows pick equal
   anchors, so they can only meet in the group of one anchor. Neighbouring
   starts with one anchor hash form a segment: the text they cover.
2. Anchor hashes are counted; segments whose anchor occurs once leave. Equal
   segments of a group are counted, and one copy of each fetches its text.
3. The segments of a group meet in one task, which builds the suffix array of
   their starts (sorted by a name of the first ``width`` bytes, then byte by
   byte), the array of longest common prefixes, and scans it with a stack:
   every interval of the common-prefix tree whose occurrences have different bytes to their left is a
   maximal repeat, given as its length and a range of the suffix array.
   A group of more than ``HOT_GROUP`` occurrences is dealt out instead: its
   different segments send the digest of each window, which are counted with
   map-side combine, so that no task holds a passage that very many documents
   share.
4. The starts go back to the documents, which remove what they cover.

Equal texts are one text with a count until the last step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_arrow, table

WIDTH, GRAM = 200, 32
#: Starts that a scan handles at a time, and bytes of segments of one suffix array.
SCAN_STARTS, ARRAY_BYTES = 1 << 16, 1 << 20
#: Starts of a segment at most: only periodic text has longer runs of one anchor.
LONGEST_RUN = 1024
HOT_GROUP = 50_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def block_names(buf: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name for each block of ``length`` bytes, equal for equal blocks."""
    h, n, parts = (buf.astype(np.uint64) + np.uint64(1)) * MIX, 1, []
    h ^= h >> np.uint64(31)
    at, left = 0, length
    while left:
        if left & n:
            parts.append((at, h))
            at, left = at + n, left - n
        if left:
            if len(h) <= n:
                return h[:0]
            h = h[:-n] * MIX + h[n:]
            h ^= h >> np.uint64(29)
            n *= 2
    out = parts[0][1][: max(0, len(buf) - length + 1)].copy()
    for at, h in parts[1:]:
        out *= MIX
        out += h[at : at + len(out)]
        out ^= out >> np.uint64(29)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if n < width else x


def segments(buf: np.ndarray, ends: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start in buf, number of starts, anchor hash, places of the anchor) of
    the segments of the texts that end at ``ends`` of ``buf``. Periodic text
    has several places of one anchor in a segment."""
    none = np.zeros(0, np.int64)
    if len(buf) < width:
        return none, none, none.view(np.uint64), none
    name = block_names(buf, gram)
    low = np.uint64((1 << 24) - 1)
    least = sliding_min((name & ~low) | np.arange(len(name), dtype=np.uint64), width - gram + 1)
    place = (least & low).astype(np.int32)
    text = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(np.r_[0, ends]))
    n = len(place)
    valid = text[:n] == text[width - 1 : width - 1 + n]
    # Runs of one place first, then neighbours with one hash are joined.
    run = np.r_[0, np.flatnonzero((place[1:] != place[:-1]) | (text[1:n] != text[: n - 1]) | (valid[1:] != valid[:-1])) + 1]
    key, own, good = name[place[run]], text[run], valid[run]
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]) | ~good[:-1]] & good)
    if not len(new):
        return none, none, none.view(np.uint64), none
    first, key = run[new], key[new]
    count = np.add.reduceat(np.where(good, np.diff(np.r_[run, n]), 0), new)
    places = np.add.reduceat(good.astype(np.int64), new)
    if count.max() > LONGEST_RUN:
        parts = -(-count // LONGEST_RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, count = np.repeat(first, parts) + nth * LONGEST_RUN, np.minimum(np.repeat(count, parts) - nth * LONGEST_RUN, LONGEST_RUN)
        key, places = np.repeat(key, parts), np.repeat(places, parts)
    return first, count, key, places


def scan_pieces(texts: list[bytes], width: int) -> Iterator[tuple[list[int], list[int], bytes, np.ndarray]]:
    """Texts cut into pieces of at most SCAN_STARTS starts, gathered to about
    that size: (text numbers, offsets in their texts, bytes, ends)."""
    which, offset, parts, size = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(0, len(t) - width + 1), SCAN_STARTS):
            piece = t[a : a + SCAN_STARTS + width - 1]
            which.append(i), offset.append(a), parts.append(piece)
            size += len(piece)
            if size >= SCAN_STARTS:
                yield which, offset, b"".join(parts), np.cumsum([len(p) for p in parts])
                which, offset, parts, size = [], [], [], 0
    if parts:
        yield which, offset, b"".join(parts), np.cumsum([len(p) for p in parts])


def equal_windows(name: np.ndarray) -> np.ndarray:
    """Order of those starts whose name another one has too, equal names side
    by side."""
    order = np.argsort(name, kind="stable")
    same = name[order][1:] == name[order][:-1]
    return order[np.r_[False, same] | np.r_[same, False]]


def suffix_order(buf: np.ndarray, s: np.ndarray, limit: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Order of suffixes by group and then by their bytes behind ``width``,
    eight at a time; they end at ``limit``, before any other byte."""
    order, rank = np.arange(len(s)), group
    open_ = np.arange(len(s))  # places whose rank is shared
    at = width
    while len(open_):
        o = order[open_]
        room = np.clip(limit[o] - s[o] - at, 0, 8)
        pos = np.minimum((s[o] + at)[:, None] + np.arange(8), len(buf) - 1)
        word = np.where(np.arange(8) < room[:, None], buf[pos], 0).astype(np.uint8).view(">u8").ravel()
        by = np.lexsort((room, word, rank[open_]))
        order[open_] = o[by]
        r, word, room = rank[open_], word[by], room[by]
        new = np.r_[True, (r[1:] != r[:-1]) | (word[1:] != word[:-1]) | (room[1:] != room[:-1])]
        # A rank is the place of its first suffix, so parts keep their order.
        rank[open_] = open_[np.flatnonzero(new)[np.cumsum(new) - 1]]
        shared = ~(new & np.r_[new[1:], True]) & (room == 8)
        open_, at = open_[shared], at + 8
    return order


def common_prefixes(buf: np.ndarray, s: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Bytes that each start has in common with the one before it (0 for the first)."""
    lcp = np.zeros(len(s), np.int64)
    a, b = s[:-1], s[1:]
    room = np.minimum(limit[:-1] - a, limit[1:] - b)
    open_ = np.arange(len(a))
    at = 0
    while len(open_):
        # 64 bytes of each open pair at a time
        span = at + np.arange(64)
        x = buf[np.minimum(a[open_, None] + span, len(buf) - 1)] != buf[np.minimum(b[open_, None] + span, len(buf) - 1)]
        x |= span >= room[open_, None]
        hit = x.any(axis=1)
        lcp[open_[hit] + 1] = at + x[hit].argmax(axis=1)
        open_, at = open_[~hit], at + 64
    return lcp


def maximal_repeats(left: np.ndarray, lcp: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(length, first, last) in the suffix array of all intervals of the
    common-prefix tree of ``width`` bytes or more whose occurrences differ in
    the byte to the left. ``left``: that byte of each suffix, or a number below
    zero, different from all others, where it is unknown.

    One scan with a stack. An interval knows one left byte, or that it has
    several; closing it hands that to the interval around it. Shorter intervals
    come after the longer ones inside them.
    """
    out: list[tuple[int, int, int]] = []
    several = object()
    stack: list[list] = []  # length, first, left
    left_list, lcp_list = left.tolist(), lcp.tolist()
    for i in range(1, len(left_list) + 1):
        depth = lcp_list[i] if i < len(lcp_list) else 0
        depth = depth if depth >= width else 0
        first, seen = i - 1, left_list[i - 1]
        while stack and stack[-1][0] > depth:
            length, first, own = stack.pop()
            seen = own if own is several or own == seen else several
            if seen is several:
                out.append((length, first, i - 1))
        if depth:
            if stack and stack[-1][0] == depth:
                if stack[-1][2] is not several and stack[-1][2] != seen:
                    stack[-1][2] = several
            else:
                stack.append([depth, first, seen])
    return out


def repeat_groups(parts: list[bytes], counts: list[int], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Maximal repeats among segments: (segment, start) of each suffix of the
    array, and the (length, first, last) ranges of the groups. ``counts``: the
    starts of each segment."""
    buf = np.frombuffer(b"".join(parts), np.uint8)
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    first = np.cumsum(lens) - lens
    n = np.asarray(counts, np.int64)
    total = int(n.sum())
    owner = np.repeat(np.arange(len(parts)), n)
    starts = first[owner] + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    name = block_names(buf, width)[starts] if total else starts
    o = equal_windows(name)
    s, seg, name = starts[o], owner[o], name[o]
    left = np.where(s == first[seg], -1 - np.arange(len(s)), buf[np.maximum(s - 1, 0)].astype(np.int64))
    if len(s):
        # A group of equal windows with one known byte to the left lies inside a
        # longer repeat that starts one byte before: it has no maximal repeat.
        fresh = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
        sizes = np.diff(np.r_[fresh, len(s)])
        diverse = np.maximum.reduceat(left, fresh) != np.minimum.reduceat(left, fresh)
        keep = np.repeat(diverse, sizes)
        s, seg, left = s[keep], seg[keep], left[keep]
        sizes = sizes[diverse]
        group = np.repeat(np.cumsum(sizes) - sizes, sizes)
        o = suffix_order(buf, s, (first + lens)[seg], group, width)
        s, seg, left = s[o], seg[o], left[o]
    lcp = common_prefixes(buf, s, (first + lens)[seg])
    return seg, s - first[seg], maximal_repeats(left, lcp, width)


def covered_starts(seg: np.ndarray, start: np.ndarray, groups: list[tuple[int, int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first start, number of starts) that the groups cover; each
    occurrence counts with the longest group that it is in."""
    length = np.zeros(len(seg), np.int64)
    for n, a, b in groups:  # longer ones inside come first
        own = length[a : b + 1]
        own[own == 0] = n
    got = length > 0
    return seg[got], start[got], length[got] - width + 1


def kept_bytes(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs) without the bytes of
    the (start, end) spans."""
    if not len(spans):
        return text, 0, 0
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    fresh = np.r_[True, spans[1:, 0] > end[:-1]]
    a, b = spans[fresh, 0], end[np.r_[np.flatnonzero(fresh)[1:] - 1, len(end) - 1]]
    out, at = [], 0
    for x, y in zip(a.tolist(), b.tolist()):
        out.append(text[at:x])
        at = y
    out.append(text[at:])
    return b"".join(out), int((b - a).sum()), len(a)


def repeated_starts(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, hot_group: int = HOT_GROUP) -> DataFrame:
    """(h, g, start, count): runs of starts whose ``width`` bytes start anywhere
    else too, in ``texts`` of columns h and g (the text's key) and ``body``
    (its bytes); repeated runs and overlaps may occur."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, g, bodies = batch.column("h").to_numpy(), batch.column("g").to_numpy(), batch.column("body").to_pylist()
            for which, offset, joined, ends in scan_pieces(bodies, width):
                first, count, key, places = segments(np.frombuffer(joined, np.uint8), ends, width, gram)
                piece = np.searchsorted(ends, first, "right")
                view = memoryview(joined)
                sub = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (first + count + width - 1).tolist())]
                doc = np.asarray(which)[piece]
                at = np.asarray(offset)[piece] + first - (ends - np.diff(np.r_[0, ends]))[piece]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.array(sub, np.uint64).view(np.int64)), pa.array(h[doc]), pa.array(g[doc]), pa.array(at), pa.array(count.astype(np.int32)), pa.array(places.astype(np.int32))],
                    names=["key", "sub", "h", "g", "at", "n", "places"],
                )

    found = map_arrow(texts.select("h", "g", "body"), anchors, "key bigint, sub bigint, h bigint, g int, at bigint, n int, places int")
    # Anchors that occur once leave; c: occurrences of the anchor.
    # Joins further on would push these filters into some of the exchanges only.
    found = found.filter("key is not null and sub is not null and h is not null and g is not null")
    many = found.groupBy("key").agg(F.sum("places").alias("c")).filter("c > 1")
    met = found.drop("places").join(many, "key")
    different = met.groupBy("key", "sub").agg(F.count("*").alias("copies"), F.min(F.struct("h", "g", "at", "n")).alias("r"), F.max("c").alias("c"))
    # Every branch names all columns of what it shares with the others, so that
    # the exchanges below are equal and run once.
    whole = different.filter("copies > 1 and c >= copies").select("key", "sub", F.lit(0).alias("lo"), F.col("r.n").alias("cnt"))
    # All occurrences of an anchor are copies of one segment: nothing more to compare.
    fetch = different.filter("c > copies").select("key", "sub", "r.h", "r.g", "r.at", "r.n", "c")
    seg = fetch.join(texts, ["h", "g"]).select("key", "sub", "n", "c", F.expr(f"substring(body, int(at) + 1, n + {width - 1})").alias("seg"))

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def solve(rows):
            s, start, groups = repeat_groups([r[3] for r in rows], [r[2] for r in rows], width)
            s, lo, cnt = covered_starts(s, start, groups, width)
            n = np.array([r[2] for r in rows])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([r[0] for r in rows], np.int64)[s]), pa.array(np.array([r[1] for r in rows], np.int64)[s]), pa.array(lo.astype(np.int32)), pa.array(np.minimum(cnt, n[s] - lo).astype(np.int32))],
                names=["key", "sub", "lo", "cnt"],
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "sub", "n", "seg"))):
                if size >= ARRAY_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    dense = seg.filter(F.col("c") <= hot_group).select("key", "sub", "n", "seg").repartition("key").sortWithinPartitions("key")
    in_groups = map_arrow(dense, arrays, "key bigint, sub bigint, lo int, cnt int")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, sub, n, text in zip(*(batch.column(c).to_pylist() for c in ("key", "sub", "n", "seg"))):
                w = [hashlib.md5(text[i : i + width]).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.int64()), pa.array([sub] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(w, pa.binary())], names=["key", "sub", "lo", "w"])

    dealt = map_arrow(seg.filter(F.col("c") > hot_group).select("key", "sub", "n", "seg"), windows, "key bigint, sub bigint, lo int, w binary")
    twice = dealt.groupBy("w").agg(F.count("*").alias("k")).filter("k > 1").select("w")
    in_hot = dealt.join(twice, "w", "left_semi").select("key", "sub", "lo", F.lit(1).alias("cnt"))
    runs = whole.unionByName(in_groups).unionByName(in_hot).groupBy("key", "sub").agg(F.collect_set(F.struct("lo", "cnt")).alias("runs"))
    back = met.select("key", "sub", "h", "g", "at", "n").join(runs, ["key", "sub"])
    exact = F.least(F.col("r.cnt"), F.col("n") - F.col("r.lo"))
    return back.select("h", "g", "at", "n", F.explode("runs").alias("r")).select("h", "g", (F.col("at") + F.col("r.lo")).alias("start"), exact.cast("bigint").alias("count"))


def text_key(text):
    """Two columns that name a text: 64 and 32 hash bits."""
    return F.xxhash64(text).alias("h"), F.hash(text).alias("g")


def dedup_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, gram: int = GRAM, hot_group: int = HOT_GROUP, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` but for the text, with ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept_sha256``; with ``keep_text`` also
    ``kept``, the remaining bytes read as UTF-8, without characters of which
    only a part is left.

    A null text is empty; texts shorter than ``width`` keep everything. Texts
    that occur in two rows or more are removed whole. Ties do not matter: every
    occurrence of a repeated string is removed. A column of ``docs`` with the
    name of a new one gives way to it. An empty table gives none.
    """
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * keep_text]
    rest = [c for c in docs.columns if c.lower() not in {n.lower() for n in (*new, text)}]
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.struct(F.lit(0).alias("_"), *rest).alias("row"), body.alias("body"), *text_key(body), F.octet_length(body).cast("bigint").alias("n_bytes"))
    long = keyed.filter(F.col("n_bytes") >= width)
    texts = long.groupBy("h", "g").agg(F.first(F.col("body").cast("binary")).alias("body"), F.count("*").alias("rows"))
    # Naming the count keeps the exchange of the texts the same for all its users.
    spans = repeated_starts(texts.filter("rows > 0"), width, gram, hot_group).groupBy("h", "g").agg(F.collect_set(F.struct("start", "count")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, copies, own in zip(*(batch.column(c).to_pylist() for c in ("body", "rows", "spans"))):
                at = np.array([[x["start"], x["start"] + x["count"] + width - 1] for x in own or []], np.int64).reshape(-1, 2)
                rows.append(kept_bytes(body, np.array([[0, len(body)]]) if copies > 1 else at))
            out = [batch.column("h"), batch.column("g"), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string())]
            names = ["h", "g", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                out, names = [*out, pa.array([r[0].decode("utf-8", "ignore") for r in rows], pa.string())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    done = map_arrow(texts.join(spans, ["h", "g"], "left"), remove, "h bigint, g int, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept string" * keep_text)
    zero = F.lit(0).cast("bigint")
    wide = keyed.filter(F.col("n_bytes") >= width).select("row", "h", "g", "n_bytes").join(done, ["h", "g"]).select("row", *new)
    short = keyed.filter(F.col("n_bytes") < width).select("row", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(F.col("body").cast("binary"), 256).alias("kept_sha256"), *[F.col("body").alias("kept")] * keep_text)
    return wide.unionByName(short).select(*[F.col(f"row.`{c}`") for c in rest], *new)


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
