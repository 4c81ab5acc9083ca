"""Samples of labelled rows when all or most texts are long."""

import random

import numpy as np

from tablescope.llm import langid, samples


def prose(letters, seed, words):
    rng = random.Random(seed)
    some = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(300)]
    return " ".join(rng.choice(some) for _ in range(words))


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(i, prose("abcdefg", 1, 60), "aa") for i in range(30)] + [(100 + i, prose("tuvwxyz", 2, 8000 + i), "bb") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(len(t) > samples.LONGEST for _, t, lang in rows if lang == "bb")
    f = langid.learn(docs)
    assert f.names == ["aa", "bb"]
    assert {(r.doc_id >= 100, r.lang_pred) for r in langid.predict(docs, f).collect()} == {(False, "aa"), (True, "bb")}
    assert langid.learn(docs, language_bytes=1).names == ["aa", "bb"]


def test_counts_do_not_depend_on_pieces(monkeypatch):
    texts = [prose("abcdefg", 3, 2000), "", prose("uvw", 4, 30)]
    want = np.unique(np.concatenate([langid.gram_hashes([t])[0] for t in texts]), return_counts=True)
    monkeypatch.setattr(langid, "PENDING", 500)
    got = langid.gram_counts(texts)
    assert all((a == b).all() for a, b in zip(got, want))
    assert "".join(t for part in langid.pieces(texts, 700) for t in part) == "".join(texts)


def test_long_texts_fill_the_sample(spark):
    rows = [(i, prose("abcdefg", i, 8000 if i % 10 else 50)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    texts, y, _ = samples.labelled_sample(docs, labels, "toxic", 4, 2, per_class=10)
    assert (y == 0).sum() == (y == 1).sum() == 10
    short = sum(len(t) <= samples.LONGEST for t in texts)
    assert 0 < short <= 4
    texts, y, _ = samples.labelled_sample(docs, labels, "toxic", 4, 2, per_class=10, class_bytes=100_000)
    assert set(y.tolist()) == {0, 1} and sum(map(len, texts)) < 200_000
