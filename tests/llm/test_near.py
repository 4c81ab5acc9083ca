"""Near-duplicates, vectors and repeats against brute force."""

import collections
import hashlib
import random

import numpy as np
import pandas as pd
import pytest
import xxhash

from tablescope.functions.graph import components
from tablescope.llm import caps, queries, repeats, simhash

SF = "/root/testdata/sf0.001"


def groups(nodes, pairs):
    """The smallest node reachable from each, by union."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 17) for i in range(17)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == groups(nodes, [p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
    for c in "\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def test_masks_cover_every_pair_of_bits():
    masks = simhash.covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not (m >> i & 1) and not (m >> j & 1) for m in masks)


def test_links_within_the_radius(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(30)]
    fps += [f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps for _ in range(6)]
    fps += [fps[0] ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)]
    fps = sorted({simhash.signed(f) for f in fps})
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    near = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert got <= set(near)
    assert groups(fps, got) == groups(fps, near)


def test_simhash_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    f = {i: fingerprint(t) for i, t in zip(docs.doc_id, docs.text)}
    ids = sorted(f)
    comp = groups(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (f[a] ^ f[b]).bit_count() <= 2])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op10_simhash"](spark, SF).collect()}
    assert got == {i: (f"{f[i]:016x}", comp[i]) for i in ids}


def test_simhash_edges(spark, docs_of, edges):
    got = simhash.near_duplicates(docs_of(edges)).collect()
    assert len(got) == len(edges)
    by = {(r.doc_id): r for r in got}
    assert by[1].fp == by[2].fp == by[3].fp == 0 and by[3].component_id == 1
    assert by[5].component_id == by[6].component_id == 5
    assert by[None].component_id is None
    assert all(r.fp == simhash.signed(fingerprint(dict(edges)[r.doc_id])) for r in got)
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 977} x{i % 31}" for i in range(4000))
    whole = simhash.simhash(text.encode())
    monkeypatch.setattr(simhash.word_blocks, "__defaults__", (50,))
    assert simhash.simhash(text.encode()) == whole == fingerprint(text)


def near(rng, x, cosine):
    x = x / np.linalg.norm(x)
    o = rng.normal(size=len(x))
    o -= o @ x * x
    return cosine * x + np.sqrt(1 - cosine**2) * o / np.linalg.norm(o)


@pytest.mark.parametrize("block", [1024, 16])
def test_caps_against_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64))
    more = [near(rng, x[i], c) for i, c in enumerate(np.r_[np.full(60, 0.951), np.full(30, 0.97), np.full(30, 0.949)])]
    dense = [near(rng, x[200], 0.985) for _ in range(90)]
    v = np.array([*x, *more, *dense, *[x[250]] * 30, x[251] * 2]).astype(np.float32)
    odd = [(9000, None), (9001, [0.0] * 64), (9002, [float("nan")] * 64), (9003, [float("inf")] + [1.0] * 63), (9004, []), (None, v[0].tolist()), (9005, [1.0, 2.0]), (9006, [2.0, 4.0]), (9007, [None] * 64)]
    df = spark.createDataFrame([(i, y.tolist(), 1) for i, y in enumerate(v)] + [(*o, 1) for o in odd], "vec_id long, embedding array<float>, node int")
    got = {r.vec_id: r for r in caps.near_vectors(df, block=block).collect()}
    u = v.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    found = sum(got[i].n_links for i in range(len(v)))
    assert all(got[i].n_links <= link[i].sum() for i in range(len(v)))
    assert found >= 0.99 * link.sum()
    comp = groups(range(len(v)), np.argwhere(np.triu(link)).tolist())
    assert sum(got[i].component_id == comp[i] for i in comp) >= 0.99 * len(v)
    assert all(got[i].n_links == 0 and got[i].kept for i in (9000, 9001, 9002, 9003, 9004, 9007))
    assert got[None].n_links == 0 and not got[None].kept
    assert (got[9006].component_id, got[9006].kept, got[9005].n_links) == (9005, False, 1)
    assert len(got) == len(v) + len(odd)


def test_caps_recall_at_the_threshold():
    """Pairs exactly at cosine 0.95 that share a filter."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.array([near(rng, x, 0.95) for x in a])
    met = np.zeros(len(a), bool)
    for code in caps.codes(64):
        one, two = ({(i, f) for i, f in zip(*map(np.ndarray.tolist, caps.decode(y, code)))} for y in (a, b))
        met[[i for i, _ in one & two]] = True
    assert met.mean() >= 0.99


def test_caps_query_and_empty(spark):
    vecs = pd.read_parquet(f"{SF}/embeddings.parquet")
    x = np.array(vecs.embedding.tolist(), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    got = {r.vec_id: r.n_links for r in queries.QUERIES["op3_caps"](spark, SF).collect()}
    assert got == {i: int(n) for i, n in zip(vecs.vec_id, link.sum(axis=1))}
    assert caps.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def removed(texts, width=repeats.WIDTH):
    """(n_bytes, n_removed, n_spans, digest) of each text, by counting all windows."""
    count = collections.Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - width + 1):
            if count[t[p : p + width]] > 1:
                hit[p : p + width] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~hit[:-1]])
        out.append((len(t), int(hit.sum()), int((np.diff(np.r_[0, hit.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_maximal_repeats_of_small_segments(seed):
    rng = random.Random(seed)
    for _ in range(60):
        width, letters = rng.choice([3, 5, 8]), rng.choice([b"ab", b"abc", b"abcdefgh"])
        segs = list({bytes(rng.choice(letters) for _ in range(rng.randrange(width, 40))) for _ in range(rng.randrange(1, 8))})
        seg, start, found = repeats.repeat_groups(segs, [len(x) - width + 1 for x in segs], width)
        got = {(segs[seg[a]][start[a] : start[a] + n], frozenset(zip(seg[a : b + 1].tolist(), start[a : b + 1].tolist()))) for n, a, b in found}
        places = collections.defaultdict(set)
        for i, x in enumerate(segs):
            for p in range(len(x)):
                for n in range(width, len(x) - p + 1):
                    places[x[p : p + n]].add((i, p))
        side = lambda i, p: segs[i][p] if 0 <= p < len(segs[i]) else (i, p)
        want = {(s, frozenset(o)) for s, o in places.items() if len(o) > 1 and len({side(i, p - 1) for i, p in o}) > 1 and len({side(i, p + len(s)) for i, p in o}) > 1}
        assert got == want


@pytest.mark.parametrize("hot", [50_000, 1])
def test_repeats_query(spark, hot):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = dict(zip(docs.doc_id, removed([(t or "").encode() for t in docs.text])))
    rows = queries.QUERIES["op1_repeats"](spark, SF) if hot > 1 else repeats.dedup_repeats(spark.read.parquet(f"{SF}/documents.parquet"), hot_group=hot)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows.collect()} == want


def test_repeats_edges(spark, docs_of, edges):
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, period = noise(260), noise(37)
    rows = edges + [
        (20, noise(90) + passage + noise(500)), (21, passage), (22, noise(500) + passage), (23, noise(300) + passage[:199] + noise(100)),
        (24, "é" * 301), (25, (period * 60)[:2100]), (26, noise(50) + (period * 12)), (27, "q" * 5000), (28, noise(20) + "q" * 700 + noise(20)),
        (29, noise(1000)), (30, passage + passage),
    ]
    got = repeats.dedup_repeats(docs_of(rows), keep_text=True)
    want = removed([(t or "").encode() for _, t in rows])
    assert sorted(str((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))) for r in got.collect()) == sorted(str((i, w)) for (i, _), w in zip(rows, want))
    clash = docs_of(rows[:3]).withColumnRenamed("source", "N_Removed").withColumnRenamed("lang", "h")
    assert [c for c in repeats.dedup_repeats(clash).columns] == ["doc_id", "h", "n_chars", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert repeats.dedup_repeats(docs_of([])).count() == 0
