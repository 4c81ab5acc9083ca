"""More languages than a machine word has bits."""

import random

import numpy as np
import pytest

from tablescope.llm import langid


def language(k):
    """Words of an invented language: its own syllables."""
    rng = random.Random(k)
    parts = ["".join(rng.choice("bcdfghklmnprstvzaeiouäöåøéíúý") for _ in range(3)) for _ in range(40)]
    return lambda n, seed: " ".join(random.Random(f"{k}-{seed}").choices([a + b for a in parts[:20] for b in parts[20:]], k=n))


@pytest.fixture(scope="module")
def texts():
    return {f"l{k:03d}": [language(k)(60, s) for s in range(12)] for k in range(200)}


def test_each_bit_is_its_own_set(texts):
    """Against plain sets: nothing that is contained is missed, and the measured
    rate of false positives is the one that is corrected for."""
    f = langid.build(texts, least=1)
    assert f.slots.shape[0] == 4 and f.slots.dtype == np.uint64 and len(f.names) == 200
    sets = {n: set(langid.gram_counts(texts[n])[0].tolist()) for n in f.names}
    h = np.unique(np.concatenate([langid.gram_counts(texts[n])[0] for n in f.names[::10]]))
    m = f.masks(h)
    for k, n in enumerate(f.names):
        bit, truth = f.bits(m, k).astype(bool), np.array([x in sets[n] for x in h.tolist()])
        assert bit[truth].all()
        assert (bit & ~truth).sum() <= (~truth).sum() * f.false_rate[k] * 2 + 5


def test_two_hundred_languages(spark, docs_of, texts):
    rows = [(1000 * k + s, t, n, "s", 0) for k, (n, own) in enumerate(texts.items()) for s, t in enumerate(own)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    f = langid.learn(df)
    assert f.names == sorted(texts)
    fresh = spark.createDataFrame([(k, language(k)(50, "new")) for k in range(200)], "doc_id long, text string")
    got = langid.predict(fresh, f).collect()
    assert np.mean([r.lang_pred == f"l{r.doc_id:03d}" for r in got]) > 0.98
    few = langid.learn(df, sample=400)  # two documents of each
    assert few.names == f.names and few.slots.shape[0] == 4


def test_slots_follow_from_the_counts():
    rng = np.random.default_rng(1)
    f = langid.fill({"a": rng.integers(0, 1 << 63, 700_000).astype(np.uint64), "b": np.arange(5, dtype=np.uint64)})
    assert f.slots.shape == (1, 1 << 22)
    assert 0.01 < f.false_rate[0] < 0.2 and f.false_rate[1] < 1e-9
    other = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert abs(f.bits(f.masks(other), 0).mean() - f.false_rate[0]) < 0.01
