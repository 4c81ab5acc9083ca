"""Tokenizer alignment against a plain version over every pair of occurrences."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tablescope.llm import align
from tablescope.llm.tokenizer_files import BYTE_BPE, PIECE_BPE

SF = "/root/testdata/sf0.001"
ODD = [
    "aaaa" * 300 + "b" * 77, "▁x", "a\x00b", "<s> </s> <unk> <0x41> <|endoftext|> x", "ﬁ ½ Ａ é é 日本語 🙂🙂", "   \n\t x  ", "null",
    "-" * 500, "ab" * 333 + " " + "ba" * 200, "۱۲۳ नमस्ते",
]


def plain(rows):
    """[(id, text)] -> {position: figures}, with nothing but byte sets."""
    a, b = Tokenizer.from_file(BYTE_BPE), SentencePieceProcessor(model_file=PIECE_BPE)
    a.encode_special_tokens = True
    back = align.byte_alphabet()
    per, holding = [], Counter()
    for _, t in rows:
        groups = []
        if t:
            x, y = a.encode(" " + t, add_special_tokens=False), b.encode(t)
            bx = [bytes(back[c] for c in a.id_to_token(i)) for i in x.ids]
            by = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
            if b"".join(bx) == b"".join(by) == (" " + t).encode():
                ends = [np.cumsum([len(s) for s in z]).tolist() for z in (bx, by)]
                done = [0, 0]
                for stop in sorted(set(ends[0]) & set(ends[1])):
                    upto = [e.index(stop) + 1 for e in ends]
                    groups.append((x.ids[done[0] : upto[0]], y[done[1] : upto[1]]))
                    done = upto
        links = Counter((i, j) for g in groups for i in g[0] for j in g[1])
        holding.update(links.keys())
        per.append((groups, links))
    most = defaultdict(int)
    for (i, _), n in holding.items():
        most[i] = max(most[i], n)
    out = []
    for (k, _), (groups, links) in zip(rows, per):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((
            k, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if holding[p] == most[p[0]]), sum(n * holding[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents_and_odd_texts(spark, docs_of, edges, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(i, t[:3000] if t else t) for i, t in edges] + [(900 + k, t) for k, t in enumerate(ODD)]
    docs = docs_of(rows).repartition(3).selectExpr("*", "0 as chunk", "1 as pair", "'x' as links")
    want = sorted(plain(rows), key=str)
    assert found(align.align(docs)) == want
    # Many small chunks, and pairs expanded in small blocks.
    assert found(align.Alignment(docs, chunk_bytes=1).scored()) == want


def test_blocks_and_groups():
    t = align.loaded(*align.read_files(BYTE_BPE, PIECE_BPE))
    al = align.Aligned(t, [s.encode() for s in ODD])
    whole = al.links()
    align.BLOCK_PAIRS, before = 3, align.BLOCK_PAIRS
    try:
        assert all((x == y).all() for x, y in zip(whole, al.links()))
    finally:
        align.BLOCK_PAIRS = before
    pairs, n = align.unpack_links(align.pack_links(whole[1][:5], whole[2][:5]))
    assert pairs.tolist() == whole[1][:5].tolist() and n.tolist() == whole[2][:5].tolist()
    assert align.coalesce(np.array([0, 0, 2, 5, 4]), np.array([2, 4, 4, 9, 5])).tolist() == [0, 0, 0, 2, 1]


def test_group_spans_give_the_text_back(spark, docs_of, edges):
    t = align.loaded(*align.read_files(BYTE_BPE, PIECE_BPE))
    for r in align.token_groups(docs_of(edges)).collect():
        text = dict(edges)[r.doc_id]
        for g in r.groups:
            part = (" " + text).encode()[g.start : g.end]
            assert b"".join(t.bytes_a[i] for i in g.a) == part == b"".join(t.bytes_b[i] for i in g.b)
        assert sum(g.end - g.start for g in r.groups) == (len(text.encode()) + 1 if r.groups else 0)


def test_pair_counts_and_empty_table(spark, docs_of):
    counts = {(r.a, r.b): (r.docs, r.best) for r in align.Alignment(docs_of([(1, "the cat"), (2, "the cat"), (3, "the dog")])).pair_counts().collect()}
    assert sorted(n for n, _ in counts.values()) == [1, 2, 3] and all(best for _, best in counts.values())
    assert align.align(docs_of([])).collect() == []


def test_ranks_as_the_library():
    t = align.loaded(*align.read_files(BYTE_BPE, PIECE_BPE))
    assert t.ranked is not None
    for low in range(0, 0x110000, 0x997):
        chars = [chr(c) for c in range(low, min(low + 0x997, 0x110000)) if not 0xD800 <= c < 0xE000]
        text = " a" + "b1 ".join(chars) + "2 ".join(chars[::7]) + "".join(chars[::5])
        assert t.ids_a(text) == t.a.encode(text, add_special_tokens=False).ids
    long = " " + "x" * align.LONGEST_RANKED
    assert t.ids_a(long) == t.a.encode(long, add_special_tokens=False).ids
