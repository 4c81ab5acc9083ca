"""Language, toxicity, quality and secrets: exactness where there is a plain
version, held-out accuracy where there is not; and the pipeline."""

import base64
import hashlib
import itertools
import json
import os
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tablescope.llm import crf, langid, quality, queries, repeats, samples, secrets, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")


@pytest.mark.parametrize("seed", range(20))
def test_chain_against_enumeration(seed):
    rng = np.random.default_rng(seed)
    lens = rng.integers(1, 7, size=rng.integers(1, 12))
    odds = rng.normal(size=lens.sum()) * 2
    first = np.zeros(len(odds), bool)
    first[np.cumsum(lens) - lens] = True
    chain = crf.Chain(rng.normal(size=(2, 2)), rng.normal(size=2))
    p, best, steps, starts, at = [], [], np.zeros((2, 2)), np.zeros(2), 0
    for n in lens:
        o, at = odds[at : at + n], at + n
        tags = list(itertools.product((0, 1), repeat=int(n)))
        s = np.array([chain.start[y[0]] + sum(o[i] * y[i] for i in range(n)) + sum(chain.step[y[i - 1], y[i]] for i in range(1, n)) for y in tags])
        w = np.exp(s) / np.exp(s).sum()
        p += (w @ np.array(tags)).tolist()
        best += tags[int(s.argmax())]
        for y, x in zip(tags, w):
            starts[y[0]] += x
            for i in range(1, n):
                steps[y[i - 1], y[i]] += x
    got, got_steps, got_starts = crf.marginals(odds, first, chain, pairs=True)
    assert np.allclose(got, p) and np.allclose(got_steps, steps) and np.allclose(got_starts, starts)
    assert crf.viterbi(odds, first, chain).tolist() == best
    assert len(crf.marginals(odds[:0], first[:0], chain)) == len(crf.viterbi(odds[:0], first[:0], chain)) == 0


def test_language_on_held_out_rows(spark, docs):
    rows = queries.QUERIES["op6_language"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs.lang[r.doc_id] for r in held]) > 0.98
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)


def test_filter_knows_its_grams_and_corrects():
    texts = {"aa": ["alpha beta gamma delta " * 5], "bb": ["omega sigma theta kappa " * 5]}
    f = langid.build(texts, least=1)
    h = langid.gram_hashes(texts["aa"])[0]
    assert ((f.masks(h) & 1) == 1).all()
    share, letters = f.shares(["alpha gamma", "kappa theta omega", "123 !?", "", "zzzz qqqq"])
    assert share[0].argmax() == 0 and share[1].argmax() == 1
    assert letters.tolist()[2:4] == [0, 0] and share[4].max() < 0.2


def test_grams_stay_in_their_document():
    many = ["one two", "", "three", "é ü", "a"]
    h, doc, _ = langid.gram_hashes(many)
    for i, t in enumerate(many):
        assert sorted(h[doc == i].tolist()) == sorted(langid.gram_hashes([t])[0].tolist())


def test_language_edges(spark, docs_of, edges):
    df = docs_of(edges)
    got = langid.predict(df, langid.learn(df)).collect()
    assert len(got) == len(edges)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.lang_pred == "en" for r in got if r.doc_id not in (1, 2, 3))
    assert langid.learn(docs_of([])).names == []
    assert {r.lang_pred for r in langid.predict(df, langid.learn(docs_of([]))).collect()} == {"und"}


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op4_toxicity"](spark, sf).toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out))
    m = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    hit = ((m.predicted == 1) & (m.toxic == 1)).sum()
    assert hit / (m.toxic == 1).sum() > 0.9 and hit / (m.predicted == 1).sum() > 0.9
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_toxic_spans_point_at_words(spark, docs_of):
    texts = ["you are a vile goblin today"] + [f"calm words number {w} here {k}" for w in "abcdefghijklmnop" for k in range(20)]
    texts += [f"some vile goblin said thing {w} twice {k}" for w in "qrstuvwxyzäöüßéè" for k in range(5)]
    y = np.array([1, *[0] * 320, *[1] * 80])
    model = toxicity.fit(texts, y, np.ones(len(y)))
    rows = toxicity.score(docs_of([(1, texts[0]), (2, texts[3]), (3, None), (4, ""), (4, "")]), model).collect()
    by = {r.doc_id: r for r in rows}
    a, b = map(int, by[1].spans.split(",")[0].split(":"))
    assert "vile" in texts[0][a:b] and by[2].spans == "" and by[1].score > by[2].score
    assert len(rows) == 5 and 0 <= by[3].score <= 1 and by[3].score == by[4].score
    empty = toxicity.fit([], np.zeros(0, np.int64), np.zeros(0))
    assert toxicity.score(docs_of([(1, "x")]), empty).count() == 1


def test_samples_are_bounded_and_not_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts, y, w = samples.labelled_sample(docs, labels, "toxic", 4, 2, per_class=10)
    assert len(texts) <= 20 and set(y.tolist()) == {0, 1} and abs(w.mean() - 1) < 1e-6
    held = {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2} - {r.text for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert not held & set(texts)


def base_figures(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(map(t.count, "#*$%&|<>")), dup, len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)


def test_quality_query(spark, docs):
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    right = []
    for r in queries.QUERIES["op9_quality"](spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_figures(docs.text[r.doc_id])
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in labels.index:
            right.append(r.kept == (labels[r.doc_id] == 1))
    assert np.mean(right) > 0.97


def test_quality_edges(spark, docs_of, edges):
    got = quality.assess(docs_of(edges), quality.fit([], np.zeros(0, np.int64), np.zeros(0))).collect()
    want = sorted(str((i, *base_figures(t))) for i, t in edges)
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in got) == want


PATTERNS = [r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]


def base_spans(text):
    out = []
    for k, (p, least) in enumerate(zip(PATTERNS, (6, 20, 24))):
        for m in re.finditer(p, text or "", re.A):
            if len(m[2] if k == 0 else m[0]) >= least:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_query(spark, docs):
    for r in queries.QUERIES["op8_secrets"](spark, SF).collect():
        assert r.base_sha256 == hashlib.sha256(base_spans(docs.text[r.doc_id]).encode()).hexdigest()


def der(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([129, n]) if n < 256 else bytes([130]) + n.to_bytes(2, "big")) + body


def test_structure_is_confirmed(spark, docs_of):
    number = der(2, bytes([1]) + os.urandom(127))
    rsa = der(0x30, der(2, b"\0") + number * 8)
    spki = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + der(5, b"")) + der(3, b"\0" + der(0x30, number + der(2, b"\1\0\1"))))
    pkcs8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, os.urandom(32))))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = field(b"ssh-rsa") + field(b"\1\0\1") + field(os.urandom(128))
    private = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(ssh) + field(os.urandom(99))
    url = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()
    jwt = f"{url({'alg': 'HS256', 'typ': 'JWT'})}.{url({'sub': 'me'})}.c2lnbmF0dXJl"
    b64 = lambda b: base64.b64encode(b).decode()
    text = "\n".join(b64(rsa)[i : i + 64] for i in range(0, len(b64(rsa)), 64))
    rows = [
        (1, f"é {b64(rsa)} end", "der"), (2, f"{b64(spki)}", "public"), (3, f"k={pkcs8.hex()}", "der"), (4, f"ssh-rsa {b64(ssh)} me@x", "public"), (5, b64(private), "ssh"),
        (6, f"see {jwt}, ok", "jwt"), (7, f"-----BEGIN RSA PRIVATE KEY-----\n{text}\n-----END RSA PRIVATE KEY-----", "pem"),
        (8, b64(rsa[:-1] + b"xx"), None), (9, b64(b"\x30\x82\x01\x00" + os.urandom(200)), None), (10, jwt.replace("eyJ", "eyK", 1), None), (11, "a" * 300, None), (12, b64(os.urandom(120)), None),
    ]
    got = {r.doc_id: r for r in secrets.scan(docs_of([r[:2] for r in rows]), mark="[X]").collect()}
    for i, t, kind in rows:
        kinds = [s.split(":")[0] for s in got[i].spans.split(",") if s]
        assert (kind in kinds) if kind else not set(kinds) & {"pem", "der", "ssh", "jwt"}, (i, kinds)
    assert got[1].redacted == "é [X] end" and got[6].redacted == "see [X], ok"


def test_secret_edges(spark, docs_of, edges):
    rows = edges + [(30, "é password = 'abc' token:abcdef, api_key=\"ABCDEF1\" secret=token=abcdefg"), (31, "ü" + "a1" * 12 + " AKIA" + "B" * 16 + "ſecret=abcdefg PASSWD:12345678")]
    got = secrets.scan(docs_of(rows), mark="[X]").collect()
    assert sorted(str((r.doc_id, r.base_sha256)) for r in got) == sorted(str((i, hashlib.sha256(base_spans(t).encode()).hexdigest())) for i, t in rows)
    assert all((r.redacted is None) == (r.doc_id == 1) for r in got)
    assert secrets.scan(docs_of([])).count() == 0


def shingles(text):
    w = re.split("[ \t-\r]+", text.lower().strip(" \t\n\v\f\r"))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Every stage on its own input, against plain versions."""
    from tests.llm.test_near import fingerprint, groups, removed

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(900_001, None, "en", "s", None), (900_002, "12 34 !!", "en", "s", 8), (None, "some words here without id", "en", "s", 5)], docs.schema)
    docs = docs.union(odd).withColumn("fp", docs.doc_id * 0).withColumn("n_removed", docs.doc_id * 0 + 7)
    frames = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], sf).write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(f.columns == docs.columns for f in frames[:-1])
    a, b, c, d, pieces = ({r.doc_id: r for r in f.collect()} if f is not frames[-1] else f.collect() for f in frames[1:])
    before = {r.doc_id: r for r in docs.collect()}
    assert set(before) - set(a) == {900_001, 900_002}
    ids = sorted(i for i in a if i is not None)
    f, sets = {i: fingerprint(a[i].text) for i in ids}, {i: shingles(a[i].text) for i in ids}
    alike = lambda x, y: len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])
    comp = groups(ids, [(x, y) for k, x in enumerate(ids) for y in ids[k + 1 :] if (f[x] ^ f[y]).bit_count() <= 2 or alike(x, y)])
    assert set(b) == {i for i in ids if comp[i] == i} | {None}
    order = list(b)
    kept = dict(zip(order, removed([b[i].text.encode() for i in order])))
    assert set(c) == set(b)
    for i in order:
        assert len(c[i].text.encode()) <= kept[i][0] - kept[i][1] and len(c[i].text.encode()) >= kept[i][0] - kept[i][1] - 6 * kept[i][2]
        assert c[i].n_chars == len(c[i].text)
    assert set(d) == set(c) and all(base_spans(r.text) == "" for r in d.values())
    assert {p.doc_id for p in pieces} == set(d)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and len({r.sequence_id for r in rows}) == len(rows)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_of_an_empty_table(spark, docs_of):
    empty = docs_of([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_repeat_width_is_a_parameter(spark, docs_of):
    got = repeats.dedup_repeats(docs_of([(1, "abcdefghij-klm"), (2, "xx abcdefghij")]), width=10, gram=4, keep_text=True).collect()
    assert {r.doc_id: r.kept for r in got} == {1: "-klm", 2: "xx "}
