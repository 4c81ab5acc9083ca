"""Alignment of two tokenizers by interval coalescing.

Both tokenizers cut the same bytes. All tokens of both are sorted by start
(one lexsort) with a running maximum of their ends: where a start reaches that
maximum, both have just ended, and a new group begins. Tokens of one group are
linked. How many documents hold an id pair linked is counted over the corpus,
so that the usual partner of an id is known.

Per document only the different linked pairs are kept. Documents are dealt to
chunks of bounded text; a chunk has one dictionary of its pairs, and only
dictionaries are joined with the corpus-wide counts, so neither token
occurrences nor documents meet a pair's counts one by one.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import scratch_dir
from .common import map_arrow, slices, table
from .tokenizer_files import BYTE_BPE, PIECE_BPE

#: Bytes of text of a chunk, and id pairs expanded at a time.
CHUNK_BYTES, BLOCK_PAIRS = 8 << 20, 1 << 20

# Fixed value: how a byte-level vocabulary splits text before its merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are left to the tokenizers library.
LONGEST_RANKED = 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes
    stand for themselves, the others follow in order from code point 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ranked(file: dict, alphabet: dict[str, int]):
    """The same encoder by ranks, which is several times as fast, where the
    file is a plain byte-level vocabulary whose ids follow its merges; else
    None. Tests compare both on every code point."""
    model, split = file["model"], file["pre_tokenizer"] or {}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True) and not file["normalizer"]
    plain = plain and model["type"] == "BPE" and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or any(model["vocab"][m] != 256 + k for k, m in enumerate(merges)):
        return None
    import tiktoken

    ranks = {bytes([alphabet[c] for c in w]): i for w, i in model["vocab"].items() if i < 256 + len(merges)}
    return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Tokenizers A (byte level) and B (pieces), from the contents of their files."""

    def __init__(self, a: str, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a), SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        alphabet, entry = byte_alphabet(), self.a.get_vocab()
        self.ranked = ranked(json.loads(a), alphabet)
        size = max(entry.values()) + 1
        special = {x["id"]: x["content"] for x in json.loads(a)["added_tokens"]}
        self.bytes_a = [b""] * size
        for word, i in entry.items():
            self.bytes_a[i] = special[i].encode() if i in special else bytes([alphabet[c] for c in word])
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.len_a, self.len_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        self.bits_a, self.bits_b = (max(1, (len(x) - 1).bit_length()) for x in (self.bytes_a, self.bytes_b))
        # Decimal ids of A and then B, once with each separator that may follow.
        decimal = [str(i).encode() for x in (self.bytes_a, self.bytes_b) for i in range(len(x))]
        self.printed = [d + s for s in (b",", b"|", b";", b"") for d in decimal]

    def ids_a(self, text: str) -> list[int]:
        if self.ranked is None or len(text) > LONGEST_RANKED:
            return self.a.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def encode(self, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of space+text by A and of text by B; none where a text is empty
        or the bytes of its tokens are not those of space+text."""
        own = [t.decode("utf-8", "replace") for t in texts]
        one = [self.ids_a(" " + t) for t in own]
        two = self.b.encode(own, num_threads=1) if own else []
        for k, t in enumerate(texts):
            whole = b" " + t
            if not t or b"".join([self.bytes_a[i] for i in one[k]]) != whole or b"".join([self.bytes_b[i] for i in two[k]]) != whole:
                one[k], two[k] = [], []
        return one, two


_LOADED: dict[bytes, Tokenizers] = {}


def loaded(a: str, b: bytes) -> Tokenizers:
    """The tokenizers of a worker process, kept from task to task."""
    key = hashlib.sha256(a.encode() + b).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizers(a, b)
    return _LOADED[key]


def coalesce(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Group number of each interval: a group ends where the next start
    reaches the running maximum of the ends."""
    order = np.lexsort((end, start))
    group = np.zeros(len(start), np.int64)
    if len(start):
        group[order[1:]] = np.cumsum(start[order][1:] >= np.maximum.accumulate(end[order])[:-1])
    return group


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and the sum of ``n`` of each."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


class Aligned:
    """The texts of a slice, aligned: flat arrays over its tokens and groups."""

    def __init__(self, t: Tokenizers, texts: list[bytes]):
        self.t = t
        one, two = t.encode(texts)
        self.n_a, self.n_b = (np.array([len(x) for x in y], np.int64) for y in (one, two))
        self.a, self.b = (np.fromiter((i for x in y for i in x), np.int64, n.sum()) for y, n in ((one, self.n_a), (two, self.n_b)))
        # Both sides of a text have the same bytes, so positions run on over the slice.
        self.end_a, self.end_b = np.cumsum(t.len_a[self.a]), np.cumsum(t.len_b[self.b])
        ends = np.concatenate([self.end_a, self.end_b])
        group = coalesce(ends - np.concatenate([t.len_a[self.a], t.len_b[self.b]]), ends)
        self.group_a, self.group_b = group[: len(self.a)], group[len(self.a) :]
        self.doc_a, self.doc_b = (np.repeat(np.arange(len(texts)), n) for n in (self.n_a, self.n_b))
        self.groups = int(group.max()) + 1 if len(group) else 0
        self.doc = np.zeros(self.groups, np.int64)
        self.doc[self.group_a] = self.doc_a
        self.size_a, self.size_b = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        docs = len(texts)
        self.n_groups = np.bincount(self.doc, minlength=docs).astype(np.int64)
        total = np.r_[0, np.cumsum(self.size_a * self.size_b)]
        cuts = np.r_[0, np.cumsum(self.n_groups)]
        self.n_links = total[cuts[1:]] - total[cuts[:-1]]

    def digests(self) -> list[str]:
        """SHA-256 of the printed groups of each text; '' without tokens."""
        na, vocab = len(self.a), len(self.t.bytes_a)
        order = np.argsort(np.concatenate([2 * self.group_a, 2 * self.group_b + 1]), kind="stable")
        group, side = np.concatenate([self.group_a, self.group_b])[order], order >= na
        last = np.r_[group[1:] != group[:-1], True] if len(group) else np.zeros(0, bool)
        follows = np.where(last, 2, 0)
        follows[:-1][~last[:-1] & (side[1:] != side[:-1])] = 1
        cuts = np.r_[0, np.cumsum(self.n_a + self.n_b)]
        follows[cuts[1:][self.n_a > 0] - 1] = 3
        ids = np.concatenate([self.a, self.b + vocab])[order] + follows * (vocab + len(self.t.bytes_b))
        ids, printed = ids.tolist(), self.t.printed
        return [hashlib.sha256(b"".join([printed[i] for i in ids[x:y]])).hexdigest() if y > x else "" for x, y in zip(cuts.tolist(), cuts[1:].tolist())]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, id pair, number of links), each pair once a document, in
        order. Ids repeated in a group are counted before they are expanded,
        and at most BLOCK_PAIRS pairs (or one id's) are expanded at a time."""
        t = self.t
        ka, ca = summed(self.group_a << t.bits_a | self.a, np.ones(len(self.a), np.int64))
        kb, cb = summed(self.group_b << t.bits_b | self.b, np.ones(len(self.b), np.int64))
        group, a, b = ka >> t.bits_a, ka & (1 << t.bits_a) - 1, kb & (1 << t.bits_b) - 1
        of_b = np.searchsorted(kb >> t.bits_b, np.arange(self.groups + 1))
        per = of_b[group + 1] - of_b[group]
        stop = np.cumsum(per)
        width = t.bits_a + t.bits_b
        cuts = np.unique(np.searchsorted(stop, np.arange(BLOCK_PAIRS, int(stop[-1]) if len(stop) else 0, BLOCK_PAIRS))).tolist()
        keys, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in zip([0, *cuts], [*cuts, len(ka)]):
            if y <= x:
                continue
            rep = per[x:y]
            one = np.repeat(np.arange(x, y), rep)
            two = np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep) + of_b[group[one]]
            k, c = summed(self.doc[group[one]] << width | a[one] << t.bits_b | b[two], ca[one] * cb[two])
            keys.append(k), n.append(c)
        k, c = summed(np.concatenate(keys), np.concatenate(n))
        return k >> width, k & (1 << width) - 1, c

    def spans(self) -> pa.Array:
        """Per text a list of groups: byte range in space+text, ids of A and B."""
        cut_a, cut_b = np.r_[0, np.cumsum(self.size_a)], np.r_[0, np.cumsum(self.size_b)]
        end = self.end_a[cut_a[1:] - 1] if self.groups else np.zeros(0, np.int64)
        before = np.r_[0, self.end_a][np.cumsum(self.n_a) - self.n_a]
        start = np.r_[0, end[:-1]] if self.groups else end
        lists = [pa.ListArray.from_arrays(pa.array(c.astype(np.int32)), pa.array(x.astype(np.int32))) for c, x in ((cut_a, self.a), (cut_b, self.b))]
        one = pa.StructArray.from_arrays([pa.array(start - before[self.doc]), pa.array(end - before[self.doc]), *lists], names=["start", "end", "a", "b"])
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(self.n_groups)].astype(np.int32)), one)


def pack_links(pairs: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending pairs and their numbers as compressed byte planes."""
    planes = np.concatenate([np.diff(pairs, prepend=0), n]).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return np.int64(len(pairs)).tobytes() + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack_links(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], 16 * n, "zstd", asbytes=True), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<i8").ravel()
    return np.cumsum(both[:n]), both[n:]


def read_files(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def token_groups(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id and ``groups``, an array of
    (start, end, a, b): a byte range of space+text at whose ends tokens of A
    and of B end, and the ids of both in it. Empty for a null or empty text
    and where a tokenizer does not give the text's bytes back. One scan."""
    files, id_type = read_files(a_path, b_path), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = loaded(*files)
        for part, texts in slices(batches, text):
            yield pa.RecordBatch.from_arrays([part.column(id_col), Aligned(t, texts).spans()], names=[id_col, "groups"])

    return map_arrow(docs.select(id_col, text), run, f"`{id_col}` {id_type}, groups array<struct<start:bigint,end:bigint,a:array<int>,b:array<int>>>")


class Alignment:
    """The alignment of a corpus, written once to the shared folder.

    ``rows``: a row per document (id, figures, its links) and one per chunk
    with the chunk's dictionary. Chunk numbers are those of the written files,
    so a task that runs again cannot renumber them.
    """

    def __init__(self, docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, text: str = "text", id_col: str = "doc_id", chunk_bytes: int = CHUNK_BYTES):
        self.id_col, self.id_type = id_col, docs.schema[id_col].dataType.simpleString()
        files = read_files(a_path, b_path)
        self.bits_b = max(1, (loaded(*files).b.get_piece_size() - 1).bit_length())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = loaded(*files)
            chunk, held = TaskContext.get().partitionId() << 32, 0
            keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

            def dictionary() -> pa.RecordBatch:
                none = [pa.nulls(1, schema.field(k).type) for k in range(1, 8)]
                lists = [pa.array([x], pa.list_(pa.int64())) for x in (keys, n)]
                return pa.RecordBatch.from_arrays([pa.array([chunk]), *none, *lists], schema=schema)

            for part, texts in slices(batches, text):
                schema = pa.schema([
                    ("chunk", pa.int64()), ("id", part.column(id_col).type), *[(x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")],
                    ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("holding", pa.list_(pa.int64())),
                ])
                al = Aligned(t, texts)
                doc, pair, c = al.links()
                cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
                blobs = [pack_links(pair[x:y], c[x:y]) for x, y in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(texts), chunk)), part.column(id_col), *map(pa.array, (al.n_a, al.n_b, al.n_groups, al.n_links)), pa.array(al.digests()), pa.array(blobs, pa.binary()), *[pa.nulls(len(texts), pa.list_(pa.int64()))] * 2],
                    schema=schema,
                )
                keys, n = summed(np.concatenate([keys, pair]), np.concatenate([n, np.ones(len(pair), np.int64)]))
                held += sum(map(len, texts))
                if held >= chunk_bytes:
                    yield dictionary()
                    chunk, held, keys, n = chunk + 1, 0, keys[:0], n[:0]
            if len(keys):
                yield dictionary()

        schema = f"chunk bigint, id {self.id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary, pairs array<bigint>, holding array<bigint>"
        self.spark, self.path = docs.sparkSession, scratch_dir(docs.sparkSession, "alignment")
        map_arrow(docs.select(id_col, text), run, schema).write.option("compression", "zstd").parquet(self.path)

    @property
    def rows(self) -> DataFrame:
        """Read anew for each side of a join, so that no column is ambiguous."""
        return self.spark.read.parquet(self.path)

    def dictionaries(self) -> DataFrame:
        """(chunk, pair, n): how many documents of the chunk hold the pair."""
        one = self.rows.filter("pairs is not null").select("chunk", F.explode(F.arrays_zip("pairs", "holding")).alias("x"))
        return one.select("chunk", F.col("x.pairs").alias("pair"), F.col("x.holding").alias("n"))

    def pair_counts(self) -> DataFrame:
        """(a, b, docs, best): in how many documents the id pair is linked,
        and whether that is the highest number of its A id."""
        totals = self.dictionaries().groupBy("pair").agg(F.sum("n").alias("docs")).withColumn("a", F.shiftright("pair", self.bits_b))
        # At most one row for each id of A: a size given by the vocabulary.
        most = totals.groupBy("a").agg(F.max("docs").alias("most"))
        both = totals.join(F.broadcast(most), "a")
        return both.select(F.col("a").cast("int").alias("a"), F.col("pair").bitwiseAND((1 << self.bits_b) - 1).cast("int").alias("b"), "docs", (F.col("docs") == F.col("most")).alias("best"), "pair")

    def scored(self) -> DataFrame:
        """One row per document: id, ``n_a``, ``n_b``, ``n_groups``,
        ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
        own = self.dictionaries().select("chunk", "pair").join(self.pair_counts().select("pair", "docs", "best"), "pair")
        kept = self.rows.filter("pairs is null").drop("pairs", "holding")
        names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

        def score(docs: pa.Table, counts: pa.Table) -> pa.Table:
            order = np.argsort(counts.column("pair").to_numpy(), kind="stable")
            pair, n, best = (counts.column(c).to_numpy()[order] for c in ("pair", "docs", "best"))
            n_best, total = [], []
            for blob in docs.column("links"):
                keys, times = unpack_links(blob.as_py())
                at = np.searchsorted(pair, keys)
                n_best.append(int(times[best[at]].sum()) if len(keys) else 0)
                total.append(int((times * n[at]).sum()) if len(keys) else 0)
            own = {x: docs.column(x) for x in docs.column_names} | {"n_best": pa.chunked_array([pa.array(n_best, pa.int64())]), "count_sum": pa.chunked_array([pa.array(total, pa.int64())])}
            return pa.table([own["id"], *[own[x] for x in names]], names=["id", *names])

        types = ", ".join(f"{x} {'string' if x == 'groups_sha256' else 'bigint'}" for x in names)
        out = kept.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(score, f"id {self.id_type}, {types}")
        return out.select(F.col("id").alias(self.id_col), *names)


def align(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``; see ``Alignment.scored``.

    Null and empty texts, and texts whose tokens do not join to their bytes
    (in either tokenizer), have no tokens: all figures 0 and an empty digest
    column. Equal rows are documents of their own and count as such. Null ids
    stay null; further columns are ignored; an empty table gives no row. The
    tokenizer files are read on the driver and sent with the tasks. A chunk
    holds the links of ``CHUNK_BYTES`` of text, or of one longer text.
    """
    return Alignment(docs, a_path, b_path, text, id_col).scored()


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
