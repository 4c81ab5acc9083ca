"""License scans against edit distances over all places, and against plain word lists."""

import random
import re

import pytest

from tablescope.llm import licenses

SF = "/root/testdata/sf0.001"


def words_of(text):
    low = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    return [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def base_places(words):
    out = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return sorted(out)


def least_edits(notice, words):
    """The least edit distance of the notice to any part of the words."""
    row = [0] * (len(words) + 1)
    for i, c in enumerate(notice, 1):
        new = [i]
        for j, d in enumerate(words, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(r, text, n):
    for _ in range(n):
        i = r.randrange(len(text))
        text = r.choice([text[:i] + text[i + 1 :], text[:i] + r.choice("xyz q") + text[i:], text[:i] + r.choice("xyz q") + text[i + 1 :]])
    return text


@pytest.mark.parametrize("seed", range(6))
def test_every_place_within_the_edits(seed):
    r = random.Random(seed)
    s = licenses.searcher(licenses.NOTICES, licenses.BASE, licenses.CHARS_PER_EDIT)
    for _ in range(6):
        parts = []
        for _ in range(r.randrange(4)):
            k = r.randrange(len(s.text))
            parts += [" ".join(r.choice(["lorem", "ipsum", "license", "the", "mit"]) for _ in range(r.randrange(6))), edited(r, s.text[k], r.randrange(s.edits[k] + 3))]
        words = " ".join(" ".join(parts).split())
        found = s.matches(words)
        for k, (notice, e) in enumerate(zip(s.text, s.edits)):
            if k >= s.base:
                least = least_edits(notice, words)
                assert (least <= e) == any(m.notice == k for m in found), (notice, words)
        for m in found:
            assert m.notice < s.base or least_edits(s.text[m.notice], words[m.start : m.end]) <= m.edits <= s.edits[m.notice]


def test_documents_and_odd_texts(spark, docs_of, edges):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] + list(edges)
    rows += [
        (801, "MIT License"), (802, "é MIT\nLICENSE, mit-license; submit license, MIT Licenses"), (803, "GNU General  Public\x00License"), (804, "Released undr the MIT Licnse!"),
        (805, "Licensed under CC BY-ND 4.0."), (806, "mitélicense mit license"), (807, "x" * 100_000 + " apache license"), (808, "Apache License " * 3000), (809, "ÀÉ 日本 — Released under the MIT License. É"),
    ]
    docs = docs_of(rows).selectExpr("*", "1 as n_words", "2 as spans", "3 as labels")
    got = sorted(licenses.scan(docs).collect(), key=lambda x: (x.doc_id is None, x.doc_id))
    rows.sort(key=lambda x: (x[0] is None, x[0]))
    assert [x.doc_id for x in got] == [i for i, _ in rows]
    for g, (_, text) in zip(got, rows):
        words = words_of(text)
        base = base_places(words)
        at = [i for i, _ in base]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(words), len(base), min(at, default=None), max(at, default=None))
        assert g.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, g.base_labels.split(","))) <= set(filter(None, g.labels.split(","))) == {x.label for x in g.spans}
        assert 0 <= g.score <= 1 and (g.score > 0) == bool(g.spans)
        for x in g.spans:
            part = " ".join(words_of(text[x.start : x.end]))
            assert least_edits(x.notice, part) <= x.edits
    one = {g.doc_id: g for g in got}
    assert one[804].labels == "mit" and one[804].n_base == 0 and one[804].score < 1
    assert one[805].labels == "cc-by-nd" and one[803].base_labels == "gpl" and one[802].n_base == 2
    span = one[809].spans[-1]
    assert one[809].labels == "mit" and "ÀÉ 日本 — Released under the MIT License. É"[span.start : span.end] == "MIT License"
    assert licenses.scan(docs.limit(0)).collect() == []


def test_pieces_hold_the_notice():
    for notice, _ in licenses.NOTICES:
        for e in range(8):
            p = licenses.pieces(notice, e)
            assert len(p) == e + 1 and "".join(x for _, x in p) == notice and all(notice[a : a + len(x)] == x for a, x in p)
