"""The language model: its network against a plain one, its held-out loss, its blocks."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ratewell.llm import lm, queries

SF = "/root/testdata/sf0.01"


def network(wide=3, seed=1):
    shape = lm.Shape(wide)
    flat = np.random.RandomState(seed).normal(0, 0.5, shape.size).astype(np.float32)
    return shape, flat, shape.unpacked(flat)


def plain_loss(shape, p, document):
    """Natural log probability of a document of symbols, one step at a time in doubles."""
    p, h, last, total = {k: v.astype(float) for k, v in p.items()}, np.zeros(lm.HIDDEN), 0, 0.0
    n = lm.HIDDEN
    for symbol in document:
        g, hu = p["x"][last], h @ p["u"]
        z, r = (1 / (1 + np.exp(-(g[k * n:(k + 1) * n] + hu[k * n:(k + 1) * n]))) for k in (0, 1))
        c = np.tanh(g[2 * n:] + r * hu[2 * n:])
        h = c + z * (h - c)
        out = h @ p["wc"] + p["bc"]
        kind = shape.class_of[symbol]
        total += out[kind] - math.log(np.exp(out).sum())
        if 1 <= kind <= shape.wide:
            words = h @ p["ww"][kind - 1] + p["bw"][kind - 1]
            total += words[(symbol - 1) % shape.wide] - math.log(np.exp(words).sum())
        last = symbol
    return total


def test_scores_are_those_of_a_plain_network(monkeypatch):
    """Over windows and batches of documents of every length, the state is carried to the end."""
    shape, _, p = network()
    random = np.random.RandomState(2)
    documents = [np.append(random.randint(1, shape.symbols, n), 0).astype(np.uint16) for n in (0, 1, 5, 47, 48, 49, 200, 3, 96)]
    want = [plain_loss(shape, p, d) / math.log(10) for d in documents]
    for window, together in ((48, 384), (7, 4), (1, 2)):
        monkeypatch.setattr(lm, "WINDOW", window)
        monkeypatch.setattr(lm, "TOGETHER", together)
        assert np.allclose(lm.score_documents(shape, p, documents), want, rtol=1e-4)


def test_training_follows_the_gradient(monkeypatch):
    """The first step of Adam has the sign of the loss's own differences, for every kind of weight."""
    shape, flat, p = network()
    document = np.random.RandomState(3).randint(0, shape.symbols, 2 * lm.STEPS).astype(np.uint16)
    monkeypatch.setattr(lm, "STEPS", len(document))
    moved = lm.train_shard(shape, [document], flat) - flat
    at, checked = 0, 0
    for name, dims in shape.shapes.items():
        size = int(np.prod(dims))
        for k in np.random.RandomState(4).choice(size, min(size, 12), replace=False):
            up, down = flat.astype(float), flat.astype(float)
            up[at + k] += 1e-4
            down[at + k] -= 1e-4
            slope = (plain_loss(shape, shape.unpacked(up), document) - plain_loss(shape, shape.unpacked(down), document)) / 2e-4
            if abs(slope) > 0.05:
                assert np.sign(moved[at + k]) == np.sign(slope), (name, k, slope, moved[at + k])
                checked += 1
        at += size
    assert checked > 30


def test_held_out_loss_beats_the_base(spark):
    rows = queries.op9_lm(spark, SF).collect()
    held = [r for r in rows if r.held_out]
    base, model = (-sum(s) / sum(r.n_tokens for r in held) for s in ([r.base_score for r in held], [r.score for r in held]))
    assert len(held) > 50 and model < base - 0.1, (base, model)


@pytest.mark.parametrize("chars", [1, 500, 10**9])
def test_blocks_of_every_size_give_the_same_base(spark, monkeypatch, chars):
    rows = [(k, f"one two three {k % 7} " * (k % 5)) for k in range(60)] + [(None, "one two"), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in lm.lm_scores(docs).collect())
    monkeypatch.setattr(lm, "BLOCK_CHARS", chars)
    monkeypatch.setattr(lm, "PIECE", 4)
    got = lm.lm_scores(docs).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in got) == whole
    assert len(got) == len(rows) and all(r.score < 0 for r in got)


def test_the_vocabulary_grows():
    assert [lm.wide_for(10**k) for k in (0, 3, 8, 12)] == [16, 16, 22, 100]
    assert [lm.Shape(w).head for w in (16, 100)] == [256, 10_000]
