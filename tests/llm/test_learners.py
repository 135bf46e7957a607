"""Toxicity and url filters: whole results against plain versions of their learners and parsers; ranks of nearest vectors."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pytest

from ratewell.llm import hnsw, queries, toxicity

SF = "/root/testdata/sf0.01"


def plain_ftrl(rows, alpha, beta, l1, l2):
    """FTRL-proximal one coordinate at a time, in dictionaries."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for at, y in rows:
        w = {i: weight(i) for i in at}
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values())))))
        for i in at:
            g = p - y
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
    return z, n


def test_ftrl_against_a_plain_loop():
    random = np.random.RandomState(1)
    rows = [(np.unique(random.randint(0, 300, random.randint(1, 40))), int(random.rand() < 0.4)) for _ in range(400)]
    z, n = np.zeros(1 << toxicity.BITS), np.zeros(1 << toxicity.BITS)
    toxicity.ftrl_pass(rows, z, n)
    wz, wn = plain_ftrl(rows, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    assert np.allclose([z[i] for i in wz], list(wz.values())) and np.allclose([n[i] for i in wn], list(wn.values()))
    w = toxicity._weights(z, n)
    assert (w[np.abs(z) <= toxicity.L1] == 0).all() and (w != 0).any()


def by_hand(text):
    """Feature numbers of a text, word by word."""
    mask, k = (1 << 64) - 1, 0x9E3779B97F4A7C15
    lower = {c: c + 32 for c in range(65, 91)}
    data = bytes(lower.get(c, c) if c > 127 or chr(c).isalnum() else 32 for c in (text or "").encode())
    h = [zlib.crc32(w) for w in data.split()]
    raw = h + [a * 3 + b * 0x10001 + 7 for a, b in zip(h, h[1:])] + [a * 5 + b * 0x30007 + 11 for a, b in zip(h, h[2:])]
    return sorted({max(((x & mask) * k & mask) >> (64 - toxicity.BITS), 1) for x in raw})


def test_features_by_hand():
    for text in (None, "", "one", "You ARE, an idiot! café \U0001F600 100%", "a b a b a b"):
        assert np.unique(toxicity.features(text)).tolist() == by_hand(text)


def test_toxicity_whole_table(spark):
    """Every row of the query is what the fitted weights give by hand, on and beyond the threshold."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    at, w = toxicity.fit(docs, labels)
    weights = dict(zip(at.tolist(), w.tolist()))
    assert 0 < len(weights) < 20_000  # L1 keeps few of 2^19
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        x = sum(weights.get(i, 0.0) for i in by_hand(text)) + weights.get(0, 0.0)
        r = got[doc_id]
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, x)))), rel=1e-9)
        assert (r.predicted, r.held_out) == (int(r.score >= 0.3), zlib.crc32(str(doc_id).encode()) % 4 == 2)


def test_training_is_bounded_in_rows(spark):
    """One id with most of the rows: copies count once, the rest is chosen by row, and held-out labels are never read."""
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 != 2]
    rows = [(ids[0], f"text {k}") for k in range(3000)] + [(ids[1], "the same")] * 3000 + [(k, f"own {k}") for k in ids[2:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    assert toxicity.training_rows(docs, labels, 10**6).count() == 3000 + len(ids) - 1
    some = toxicity.training_rows(docs, labels, 500)
    assert 400 < some.count() < 600
    assert toxicity.fit(docs.limit(0), labels)[1].tolist() == [-35.0]


def test_states_of_shards_stay_with_the_tasks(spark, monkeypatch):
    """Several shards give what a plain loop over them gives; the driver gets the weights, not the states."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 != 2]
    rows = [(k, f"word{k} rare{k} {'vile rude' if k % 2 else 'kind mild'} " + " ".join(f"w{k}x{i}" for i in range(k % 90))) for k in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, toxic int")
    learned = toxicity.training_rows(docs, labels).toPandas()
    size = 1 << toxicity.BITS
    z, n = np.zeros(size), np.zeros(size)
    for turn in range(toxicity.ROUNDS):
        all_z, all_n, heard = np.zeros(size), np.zeros(size), np.zeros(size)
        for _, shard in learned.groupby("shard"):
            own_z, own_n = z.astype(np.float32).astype(float), n.astype(np.float32).astype(float)
            known = [(np.append(at, 0), y) for at, y in zip(shard["at"], shard.toxic)]
            for k in range(toxicity.PASSES):
                order = np.lexsort((shard.h, [zlib.crc32(f"{turn}:{k}:{i}".encode()) for i in shard.h]))
                toxicity.ftrl_pass([known[j] for j in order], own_z, own_n)
            all_z += own_z.astype(np.float32)
            all_n += own_n.astype(np.float32)
            heard += own_n > 0
        z, n = (all_z / np.maximum(heard, 1), all_n / np.maximum(heard, 1)) if turn else (all_z, all_n)
    w = toxicity._weights(z, n)
    came, collect = [], type(docs).collect

    def counted(df):
        got = collect(df)
        came.extend(len(v) for r in got for v in r if isinstance(v, bytes | bytearray))
        return got

    monkeypatch.setattr(type(docs), "collect", counted)
    at, found = toxicity.fit(docs, labels)
    assert learned.shard.nunique() >= 3 and at.tolist() == np.flatnonzero(w).tolist()
    assert np.allclose(found, w[at], rtol=1e-6)
    assert (n > 0).sum() > 20 * len(at) and sum(came) <= 12 * len(at)


# --- urls ------------------------------------------------------------------------------------------------

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def judged_by_hand(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = []
    for rule, verdict in RULES:
        name, _, rest = rule.partition("/")
        if found and (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


def test_urls_whole_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = {r.page_id: r for r in queries.op8_urls(spark, SF).collect()}
    assert set(got) == set(pages)
    for page, url in pages.items():
        host, path, rule, verdict = judged_by_hand(url)
        r = got[page]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert len({r.rule for r in got.values()}) > 2


# --- nearest vectors -------------------------------------------------------------------------------------

def test_ranks_and_scores_of_nearest(spark):
    """Ranks count up from 1, scores are exact and fall, and ties go to the smaller id."""
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in rows}
    found = collections.defaultdict(list)
    for r in queries.op10_hnsw(spark, SF).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(found) == {k for k in x if k % 20 == 0}
    for query, hits in found.items():
        hits.sort()
        assert [k for k, _, _ in hits] == list(range(1, 21)) and query not in {v for _, v, _ in hits}
        for _, v, score in hits:
            assert score == pytest.approx(x[query] @ x[v], rel=1e-12)
        assert [(-s, v) for _, v, s in hits] == sorted((-s, v) for _, v, s in hits)
    tied = spark.createDataFrame([(k, [1.0, 0.0] if k < 30 else [0.0, 1.0]) for k in range(60)], "vec_id long, embedding array<double>")
    got = hnsw.nearest(tied, tied.where("vec_id = 40"), 35).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [*[k for k in range(30, 60) if k != 40], *range(6)]
