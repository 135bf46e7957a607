"""The registered queries over whole small tables against brute force."""

from __future__ import annotations

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest

from ratewell.llm import jaccard, licenses, packing, queries, urls

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(packing.tokenizer_path())
    got = queries.op1_packing(spark, SF).toPandas()
    for doc, pieces in got.groupby("doc_id"):
        ids, at = np.array([*encoder.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for p in pieces.sort_values("start").itertuples():
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    for _, pieces in got.groupby("sequence_id"):
        at = 0
        for p in pieces.sort_values("offset").itertuples():
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert got.length.sum() > 0.98 * 2048 * got.sequence_id.nunique()


def test_license_base(spark, texts):
    for r in queries.op2_licenses(spark, SF).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or ""))
        at = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_rules_base(spark, texts):
    for r in queries.op7_rules(spark, SF).collect():
        words, places, covered = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or ""), collections.defaultdict(list), set()
        for k in range(len(words) - 4):
            places[tuple(words[k:k + 5])].append(k)
        for found in places.values():
            if len(found) > 1:
                covered |= {k + j for k in found for j in range(5)}
        lines = [x for x in (texts[r.doc_id] or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", texts[r.doc_id] or "")), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in queries.op3_toxicity(spark, SF).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    good = [r.score for r in got if not labels[r.doc_id]]
    bad = [r.score for r in got if labels[r.doc_id]]
    assert np.mean([b > g for b in bad for g in good]) > 0.8


def test_jaccard_classes(spark, texts):
    sets = {}
    for doc, text in texts.items():
        w = (text or "").lower().split()
        sets[doc] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    root = {doc: doc for doc in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = collections.defaultdict(list)
    for doc, found in sets.items():
        for x in found:
            held[x].append(doc)
    for a, b in {(a, b) for docs in held.values() for a in docs for b in docs if a < b}:
        both = len(sets[a] & sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.doc_id: r.class_id for r in queries.op4_jaccard(spark, SF).collect()}
    assert got == {doc: find(doc) for doc in texts}
    assert 1 - (1 - 0.8 ** jaccard.shortest_prefix()) ** jaccard.TREES >= 0.999


def test_crowds_lose_no_link(spark, monkeypatch):
    """300 near copies of two texts: more than a small group holds, in many pairs of blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    rng, rows = np.random.RandomState(5), []
    for doc in range(300):
        words = [f"w{doc % 2}x{k}" for k in range(120)]
        for k in rng.choice(120, rng.randint(0, 6), replace=False):
            words[k] = f"new{rng.randint(10**6)}"
        rows.append((doc, " ".join(words)))
    sets = {doc: set(jaccard.shingles(text).tolist()) for doc, text in rows}
    texts = dict(rows)
    links, classes = collections.Counter(), {doc: {doc} for doc in texts}
    for a, b in itertools.combinations({min(d for d in texts if texts[d] == t) for t in texts.values()}, 2):
        both = len(sets[a] & sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            both_classes = classes[a] | classes[b]
            classes |= dict.fromkeys(both_classes, both_classes)
    got = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_links for r in got} == {r.doc_id: links[r.copy_of] for r in got} and len(got) == 300
    assert {r.doc_id: r.class_id for r in got} == {r.doc_id: min(classes[r.copy_of]) for r in got}


def test_url_model_agrees_with_labels(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = [r for r in urls.judge(pages).collect() if r.rule]
    assert np.mean([(r.block_score >= 0.5) == (r.verdict == "block") for r in got]) > 0.9


def test_lm_base(spark, texts):
    tokens = {doc: [*(text or "").encode().lower().split(), b""] for doc, text in texts.items()}
    counts = collections.Counter(w for doc, ws in tokens.items() if zlib.crc32(str(doc).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in queries.op9_lm(spark, SF).collect():
        ws = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in counts for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    got = collections.defaultdict(set)
    for r in queries.op10_hnsw(spark, SF).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        hits.append(len(got[ids[k]] & set(ids[np.lexsort((ids, -s))[:20]])) / 20)
    assert np.mean(hits) >= 0.95
