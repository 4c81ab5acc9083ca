"""Near-copies by shingle sets against all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tablescope.llm import nearsets

from .test_near import fingerprint, groups


def similar(a, b):
    """Jaccard similarity of five-word shingles, in plain Python."""
    one, two = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(one & two) / len(one | two)


def planted():
    """Texts of 60 to 400 words; copies with one word to several exchanged."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(60, 400))]
        texts.append(" ".join(base))
        for _ in range(4):
            own = list(base)
            for _ in range(rng.randrange(1, 1 + len(base) // 40)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own).upper() if rng.random() < 0.3 else " ".join(own))
    return texts


def classes_of(label):
    return {frozenset(i for i in label if label[i] == c) for c in set(label.values())}


@pytest.mark.parametrize("rounds, block", [(3, 4096), (0, 3), (1, 2)])
def test_planted_near_copies(spark, docs_of, monkeypatch, rounds, block):
    """Rounds with centres, comparison within tasks, and blocks of both."""
    monkeypatch.setattr(nearsets, "CENTRE_ROUNDS", rounds)
    monkeypatch.setattr(nearsets, "LEFT", min(block, 512))
    monkeypatch.setattr(nearsets, "RIGHT", block)
    monkeypatch.setattr(nearsets, "FEW", 0)
    texts = planted()
    near = [(a, b) for a in range(len(texts)) for b in range(a) if similar(texts[a], texts[b]) >= 0.8]
    want = groups(range(len(texts)), near)
    assert len(near) > 50 and 25 < len(set(want.values())) < len(texts)
    parts = {r.doc_id: r.part for r in nearsets.near_sets(docs_of(list(enumerate(texts)))).collect()}
    assert classes_of(parts) == classes_of(want)
    if not rounds:
        fps = [fingerprint(t) for t in texts]
        want = groups(range(len(texts)), near + [(a, b) for a in range(len(texts)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2])
        kept = corpus_pipeline.near_dedup(spark, docs_of(list(enumerate(texts))), "").collect()
        assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_large_group_and_templates(spark, docs_of):
    """600 near-copies of one text, and 120 texts of one template that are
    only 0.6 alike: the group is one part, the texts stay apart."""
    rng = random.Random(8)
    base, form = ([f"{c}{rng.random()}" for _ in range(n)] for c, n in (("b", 200), ("f", 150)))
    texts = []
    for k in range(600):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(200)] = f"n{k}"
        texts.append(" ".join(own))
    texts += [" ".join(form + [f"t{k}-{j}" for j in range(50)]) for k in range(120)]
    want = groups(range(len(texts)), [(k, 0) for k in range(1, 600) if similar(texts[k], texts[0]) >= 0.8] + [(k, k - 1) for k in range(1, 600) if similar(texts[k], texts[k - 1]) >= 0.8])
    assert 0.4 < similar(texts[-1], texts[-2]) < 0.65
    parts = {r.doc_id: r.part for r in nearsets.near_sets(docs_of(list(enumerate(texts)))).collect()}
    assert len({parts[k] for k in range(600)}) <= len({want[k] for k in range(600)})
    assert len({parts[k] for k in range(600, 720)}) == 120


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(9)
    met = 0
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 110, dtype=np.uint64)
        a, b = np.unique(x[:99]), np.unique(np.r_[x[:88], x[99:]])  # 88 of 110 in common
        met += any(p == q for p, q in zip(nearsets.band_keys(a), nearsets.band_keys(b)))
    assert met == 300


def test_near_sets_edges(spark, docs_of, edges):
    got = nearsets.near_sets(docs_of(edges)).collect()
    assert len(got) == len(edges)
    by = {r.doc_id: r.part for r in got}
    assert by[1] == by[2] == by[3] and by[5] == by[6] and len(set(by.values())) == len(by) - 3
    assert nearsets.near_sets(docs_of([])).count() == 0


def test_an_id_with_different_texts_loses_none(spark, docs_of):
    one, two, three = (" ".join(f"{c}{k}" for k in range(80)) for c in "xyz")
    docs = docs_of([(1, one), (2, one), (2, two), (2, two), (3, three), (3, two + " end"), (None, one)])
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, one), (1, one), (2, two), (3, three)]
