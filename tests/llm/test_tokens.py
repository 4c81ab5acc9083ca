"""BPE, packing and chat formatting against the tokenizers library and plain Python."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tablescope.llm import chat, packing, queries, tokens
from tablescope.llm.bpe import Encoder, Vocabulary, merge_words
from tablescope.llm.tokenizer_files import WORD_BPE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def enc():
    return Encoder(Vocabulary(WORD_BPE))


def test_every_code_point_as_the_library(enc, library):
    for a in range(0, 0x30000, 97):
        if a + 97 < 0xD800 or a > 0xE000:
            text = "".join(map(chr, range(a, a + 97)))
            assert enc.ids([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_any_texts_as_the_library(texts):
    e, lib = _shared()
    ids, n = e.ids([t.encode() for t in texts])
    assert n.tolist() == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    assert ids.tolist() == [i for t in texts for i in lib.encode(t, add_special_tokens=False).ids]


_store: list = []


def _shared():
    if not _store:
        _store.extend([Encoder(Vocabulary(WORD_BPE), limit=50), Tokenizer.from_file(WORD_BPE)])
    return _store


def test_overlapping_pairs_merge_from_the_left(enc, library):
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)]
    ids, n = merge_words(enc.v, [w.encode() for w in words])
    assert ids.tolist() == [i for w in words for i in library.encode(w, add_special_tokens=False).ids]


def expected(library, text):
    own = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda b: hashlib.sha256(b.encode()).hexdigest()
    return len(own), sha(" ".join(map(str, own))), sha(library.decode(own, skip_special_tokens=False))


def test_encode_decode_rows(spark, docs_of, edges, library):
    got = tokens.encode_decode(docs_of(edges)).collect()
    want = sorted(str((i, *expected(library, t))) for i, t in edges)
    assert sorted(str(tuple(r)) for r in got) == want
    assert tokens.encode_decode(docs_of([])).collect() == []


def test_encode_query(spark, library):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text
    for r in queries.QUERIES["op2_bpe"](spark, SF).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, docs[r.doc_id])


def check_pieces(rows, texts, library):
    """Pieces tile each document, none crosses, lengths are its binary digits."""
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in texts.items():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by.pop(i), key=lambda r: r.start)
        assert [r.length for r in own] == [4096] * (len(ids) // 4096) + [1 << k for k in range(11, -1, -1) if len(ids) >> k & 1]
        at = 0
        for r in own:
            assert (r.start, r.doc_tokens, r.offset) == (at, len(ids), 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not by
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_packing_query(spark, library):
    texts = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text.to_dict()
    check_pieces(queries.QUERIES["op5_packing"](spark, SF).collect(), texts, library)


def test_packing_edges(spark, docs_of, edges, library):
    once = {i: t for i, t in edges}
    check_pieces(packing.pack_power_of_two(docs_of(list(once.items()))).collect(), once, library)
    twice = packing.pack_power_of_two(docs_of([(6, "x y z"), (6, "x y z")])).collect()
    assert len(twice) == 2 and len({r.sequence_id for r in twice}) == 2
    assert packing.pack_power_of_two(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        packing.pack_power_of_two(docs_of([]), longest=1000)
    kept = packing.pack_power_of_two(docs_of([(1, "one two three four")]), longest=2, keep_ids=True).collect()
    assert [len(r.ids) for r in kept] == [r.length for r in kept]


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|>\n<|im_start|>"), (1, 2, "assistant", "a\\|b <\\| \\"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (1, 5, "user", "trailing\n\n"), (2, 0, "user", "no answer"), (3, 0, "assistant", "only"), (3, 0, "assistant", "only"), (None, 1, "assistant", "<|"), (None, None, "user", "x"),
    (4, 1, "odd\n<|im_start|>\\n", "role"), (4, 2, None, "null role"), (5, 1, "user", "<"), (5, 2, "assistant", "|im_end|>\n" * 2000),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_examples(df)).collect()}
    convs = {}
    for c, t, r, x in TURNS:
        convs.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(convs)
    for c, rows in convs.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        assert got[c].n_turns == len(rows)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in rows).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_examples(spark):
    df = spark.createDataFrame(TURNS[:6], "conv_id long, turn long, role string, text string")
    ex = sorted(chat.format_examples(df).collect(), key=lambda r: r.example)
    assert [r.target_start is None for r in ex] == [False, False, True]
    assert all(b.formatted.startswith(a.formatted) for a, b in zip(ex, ex[1:]))
    assert ex[0].formatted.count("<|im_start|>") == 3
    assert chat.format_examples(df.limit(0)).collect() == []


def test_chat_is_native(spark):
    plan = queries.QUERIES["op7_chat"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
