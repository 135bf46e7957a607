"""Cases of the fourth round of findings."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

import numpy as np
from tokenizers import Tokenizer, normalizers

from ratewell.llm import lm, packing
from ratewell.plans import registry, views


def test_batch_runs_read_the_line_items_once(spark, tmp_path, monkeypatch):
    first = datetime(1997, 12, 30)
    lines = [(pair[0], pair[1], first + timedelta(days=d), 100.0 + d) for d in range(5) for pair in views.PAIR_CODES if d != 1 or pair != "AF"]
    spark.createDataFrame(lines, "l_returnflag string, l_linestatus string, l_shipdate timestamp, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    read, asked = [], []
    table = views.table
    monkeypatch.setattr(views, "table", lambda s, d, name: read.append(name) or table(s, d, name))
    monkeypatch.setattr(registry, "run", lambda s, folder, kind, day, landed, *rest: asked.append((kind, str(day), sorted(r[0] for r in landed.select("path").collect()))))
    monkeypatch.setattr(registry, "backfill", lambda s, folder, days, params: asked.append(("backfill", [str(d) for d in days])))
    assert registry.q_run(spark, str(tmp_path)).isEmpty()
    both = ["rates-1997.zip", "rates-1998.zip"]
    assert asked == [("manual", "1998-01-01", both), ("backfill", ["1998-01-02"]), ("scheduled", "1998-01-03", both)]
    assert read == ["lineitem"]


def test_letter_runs_have_the_ids_of_the_whole_tokenizer():
    path = packing.tokenizer_path()
    plain = Tokenizer.from_file(path)
    words = ["Straße", "ÀÉÎÕÜ", "naïveté", "café,", "über!", "école.", "Þórr", "ÿ", "ß", "don't", "it's", "'s", "a×b", "x÷y", "ªº", "µm", "İI", "ΑΣ", "été", "a1é", "é1.", "thatound!!", "foo&&&", "", "<|endoftext|>", "Q" * 300]
    random = np.random.RandomState(5)
    words += ["".join(random.choice(list("abcdeéèßüÄÖzZ"), random.randint(1, 14))) + random.choice(["", ".", ",", "!?"]) for _ in range(3000)]
    encoder = packing.Encoder(path)
    asked = []
    encode = encoder.tokenizer.encode
    encoder.tokenizer = type("Counted", (), {"encode": lambda self, text, **k: asked.extend(text.split(" ")) or encode(text, **k)})()
    texts = [" ".join(words[k:k + 90]) for k in range(0, len(words), 90)]
    for text in texts:
        assert encoder.ids(text).tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]
    # Runs of letters, with a mark behind or not, need neither normalising nor splitting.
    assert asked and not any(re.fullmatch("[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?", w) for w in asked if len(w) > 1)


def test_other_tokenizers_take_no_short_way(tmp_path):
    made = Tokenizer.from_file(packing.tokenizer_path())
    made.normalizer = normalizers.NFC()  # keeps capitals
    made.save(path := str(tmp_path / "capitals.json"))
    assert packing.merges_words(Tokenizer.from_file(packing.tokenizer_path())) and packing.Encoder(path).merges is None


def test_words_of_a_class_stand_together():
    """The network's words: one sum of exponentials for the words of all classes, and the places and values of a plain softmax."""
    shape, random = lm.Shape(5, 3), np.random.RandomState(1)
    p = shape.unpacked(random.normal(0, 0.5, shape.size).astype(np.float32))
    states, targets = random.normal(0, 1, (400, lm.HIDDEN)).astype(np.float32), random.randint(0, shape.symbols, 400).astype(np.uint16)
    at, spans = lm.by_class(shape.class_of[targets], shape.wide)
    assert sorted(at.tolist()) == np.flatnonzero((targets > 0) & (targets <= shape.head)).tolist()
    assert [hi - lo for _, lo, hi in spans] == [int((shape.class_of[targets] == 1 + k).sum()) for k, _, _ in spans]

    def softmax(x):
        return x - np.log(np.exp(x).sum())

    for row, target, got in zip(states.astype(float), targets.tolist(), lm.log_prob(shape, p, states, targets)):
        kind = shape.class_of[target]
        want = softmax(row @ p["wc"] + p["bc"])[kind]
        if 0 < target <= shape.head:
            want += softmax(row @ p["ww"][kind - 1] + p["bw"][kind - 1])[(target - 1) % shape.wide]
        assert abs(got - want) < 1e-4
    none = np.zeros(7, np.uint16)
    assert lm.by_class(shape.class_of[none], shape.wide)[1] == [] and lm.log_prob(shape, p, states[:7], none).shape == (7,)


def test_blocks_of_nothing_and_of_odd_space(monkeypatch):
    for piece in (4, 1 << 22):
        monkeypatch.setattr(lm, "PIECE", piece)
        block = lm.Block("b")
        texts = ["", " \t a\x0bB\x0c c\r\n", "ÀÉ x\u00a0y Z\x1c\x85q", "\n", "a b a", "xyz" * 50]
        for k, text in enumerate(texts):
            block.add(str(k), None if k == 3 else str(k % 3), text)
        row = block.row().to_pylist()[0]
        words = [[w.decode() for w in text.encode().lower().split()] + [""] for text in texts]
        assert [[row["words"][i] for i in np.frombuffer(d["ids"], np.uint32)] for d in row["docs"]] == words
        assert row["words"] == list(dict.fromkeys(["", *[w for one in words for w in one]]))
        learned = [w for one, d in zip(words, row["docs"]) if d["fold"] not in (None, "2") for w in one]
        assert row["n"] == [learned.count(w) for w in row["words"]]
    empty = lm.Block("e")
    empty.add("1", "0", "")
    assert empty.row().to_pylist() == [{"block": "e", "words": [""], "n": [1], "docs": [{"doc_id": "1", "fold": "0", "ids": bytes(4)}]}]
