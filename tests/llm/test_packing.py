"""The packing program: every piece is in a pattern, patterns fit, little room is left, also for short texts."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from ratewell.llm import packing


def planned(lengths):
    sizes = packing.class_sizes()
    classes = sizes[np.searchsorted(sizes, lengths)]
    counts = collections.Counter(classes.tolist())
    got, plan = collections.Counter(), packing.plan(dict(counts))
    for pattern, times in plan:
        assert times > 0 and sum(size * n for size, n in pattern.items()) <= packing.LENGTH
        for size, n in pattern.items():
            got[size] += n * times
    assert got == counts
    return lengths.sum() / packing.LENGTH / sum(times for _, times in plan)


@pytest.mark.parametrize("length", [1, 20, 40, 64, 97])
def test_short_texts_of_one_length(length):
    assert planned(np.full(400_000, length)) > 0.98


def test_mixtures():
    random = np.random.RandomState(1)
    assert planned(random.randint(1, 2049, 60_000)) > 0.98
    assert planned(random.randint(1, 129, 60_000)) > 0.998
    assert planned(np.clip(random.lognormal(5.5, 1.2, 60_000).astype(int) + 1, 1, 2048)) > 0.98
    # Long pieces of which no two fit: short ones go beside them, and nothing better is possible.
    mixed = np.concatenate([np.full(1000, 1500), np.full(13_000, 32)])
    assert planned(mixed) == pytest.approx(mixed.sum() / 2048 / 1000)


def test_knapsack_against_a_plain_one():
    random = np.random.RandomState(2)
    for _ in range(40):
        sizes = np.unique(random.randint(1, 30, 6))
        prices, room = random.rand(len(sizes)) * sizes, int(random.randint(30, 90))
        best = [0.0] * (room + 1)
        for c in range(1, room + 1):
            best[c] = max([best[c - 1], *[best[c - s] + p for s, p in zip(sizes, prices) if s <= c]])
        taken = packing.knapsack(prices, sizes, room)
        assert taken @ sizes <= room and taken @ prices == pytest.approx(best[room])


def test_documents_of_one_token_fill_their_sequences(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN '' END AS text")
    placed = packing.pack_documents(docs).groupBy("sequence_id").count().collect()
    assert sorted(r["count"] for r in placed) == [9000 - 4 * 2048, *[2048] * 4]
