"""Spelling variants, document fingerprints and vector codes: against brute force, and nulls, ties, repeats, empty tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.llm import codes, digests, queries, spelling

SF = "/root/testdata/sf0.01"
CLASH = {"n": 1, "rank": 2, "word": "w", "text_": "x", "part": 3, "row": "r", "h": 4, "fingerprint": "f", "code": "c", "v": 5, "error": 6}


def clashing(df):
    return df.withColumns({name: F.lit(value) for name, value in CLASH.items()})


def words_by_hand(docs, shortest=6, least=5, every=199):
    counts, lower = collections.Counter(), str.maketrans(spelling.UPPER, spelling.LOWER)
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def spelling_by_hand(counts, ratio=5):
    alphabet, near = sorted(set("".join(counts))), {}
    for w in counts:
        made = {w[:k] + w[k + 1:] for k in range(len(w))}
        made |= {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in alphabet} | {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in alphabet}
        near[w] = sorted((x for x in made if x != w and x in counts), key=lambda x: (-counts[x], x))
    form = {w: near[w][0] if near[w] and counts[near[w][0]] >= ratio * counts[w] else None for w in counts}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def as_dict(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


def test_spelling_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = spelling_by_hand(words_by_hand(docs))
    assert as_dict(queries.op11_spelling(spark, SF)) == want
    assert any(form for form, *_ in want.values())


@pytest.fixture(scope="module")
def odd_docs(spark):
    random = np.random.RandomState(3)
    # Few letters make rows of equal code points, shared prefixes and chains of forms.
    words = ["".join(random.choice(list("aabéß"), random.randint(5, 9))) for _ in range(300)]
    text = " ".join(w for w in words for _ in range(random.choice([1, 5, 30, 160, 900])))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (None, None), (4, "AİBCDEF " * 20 + "7" * 9), (5, "AbCdEfÉ×÷ " * 9), (6, "q" * 3000 + " " + "q" * 2999 + "z" + " " + "q" * 2999)]
    return rows + [rows[-1]] * 5


@pytest.mark.parametrize("size", [300, 1_000_000])
def test_spelling_odd_texts(spark, odd_docs, size):
    df = clashing(spark.createDataFrame(odd_docs, "doc_id long, text string"))
    want = spelling_by_hand(words_by_hand(odd_docs))
    got = spelling.spelling(df, size=size)
    assert as_dict(got) == want
    assert any(root != form for form, root, *_ in want.values() if form)  # chains of more than one step
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_nothing(spark):
    assert spelling.spelling(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert spelling.spelling(spark.createDataFrame([(1, None), (2, "short one")], "doc_id long, text string")).collect() == []


def prints_by_hand(docs):
    out = []
    for k, (doc_id, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        n = len(text) // 3
        new = text[:len(text) - n] + following[:n]
        own, theirs = digests.fingerprint(text), digests.fingerprint(new)
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), own, theirs, digests.likeness(own, theirs), digests.likeness(own, digests.fingerprint(following))))
    return out


def test_fingerprints_whole_table(spark):
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = queries.op12_fingerprints(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(prints_by_hand(docs))
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


def test_bucket_counts_by_hand():
    data = np.random.RandomState(1).bytes(3000)
    want = collections.Counter()
    for i in range(len(data)):
        for j, (second, third) in enumerate(digests.TRIPLETS):
            if i + third < len(data):
                x = data[i] | data[i + second] << 8 | data[i + third] << 16
                want[((x ^ j << 24) * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    for chunk in (64, 2999, 1 << 20):
        old, digests.CHUNK = digests.CHUNK, chunk
        try:
            assert digests.bucket_counts(data).tolist() == [want[k] for k in range(256)]
        finally:
            digests.CHUNK = old


def test_likeness():
    random = np.random.RandomState(2)
    text = " ".join(map(str, random.randint(0, 10 ** 6, 2000)))
    other = " ".join("".join(random.choice(list("abcdefgh"), 6)) for _ in range(2000))
    a, b, c = (digests.fingerprint(t) for t in (text, text.replace("77", "78"), other))
    assert digests.difference(a, c) == digests.difference(c, a) and digests.likeness(a, a) == 1.0
    assert digests.likeness(a, b) > 0.7 > digests.likeness(a, c)
    assert digests.fingerprint("") != digests.fingerprint("a" * 40) and len(digests.fingerprint("")) == len(a)


def test_fingerprints_odd_rows(spark):
    rows = [(2 ** 60 + 1, "big"), (None, "no id \U0001F600é"), (None, None), (5, None), (4, ""), (3, "x" * 300_000 + "\U0001F600")]
    rows += [(7, "the same row")] * 40 + [(7, f"one id, many texts {k % 30}") for k in range(60)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    order = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text")).collect()
    docs = [(r.doc_id, r.text) for r in sorted(order, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.hash, r.text))]
    got = digests.fingerprints(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, prints_by_hand(docs)))
    one = digests.fingerprints(spark.createDataFrame([(9, "alone in the table")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(9, 1.0)]
    assert digests.fingerprints(df.limit(0)).collect() == []


def codes_by_hand(rows, entries=256, rounds=4, parts=4):
    """rows: (vec_id, vector, label), ids without ties; plain Python integers."""
    kept = sorted((i, [int(np.floor(1024 * np.float64(x))) for x in v], label) for i, v, label in rows)
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(q, book):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for c in cut:
                members[near(c[p], books[p])[1]].append(c[p])
            for e, own in members.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    last = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors, labels = [sum(d for d, _ in x) for x in last], collections.Counter()
    for (_, _, label), error in zip(kept, errors):
        labels[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((i, "".join(f"{e:02x}" for _, e in x), error, labels[label], digest) for (i, _, label), x, error in zip(kept, last, errors))


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("scale", [0.01, 3.0, 1e5])
def test_codes_by_hand(spark, scale):
    """Ties (small scale), ordinary values, and values whose squares leave the doubles' integers."""
    x = np.random.RandomState(5).normal(size=(400, 8)) * scale
    rows = [(k * 7 % 400, x[k].tolist(), [None, 1, 2][k % 3]) for k in range(400)]
    assert sorted(map(tuple, codes.vector_codes(clashing(spark.createDataFrame(rows, SCHEMA))).collect())) == codes_by_hand(rows)


def test_errors_that_fit_no_long(spark):
    x = np.random.RandomState(5).normal(size=(300, 4)) * 1e9
    rows = [(k, x[k].tolist(), k % 2) for k in range(300)]
    got = sorted(map(tuple, codes.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()))
    want = codes_by_hand(rows)
    assert [(g[0], g[1], g[4]) for g in got] == [(w[0], w[1], w[4]) for w in want]
    assert [g[2] for g in got] == [w[2] if w[2] < 2 ** 63 else None for w in want] and {g[3] for g in got} == {None}


def test_nearest_entry_is_that_of_a_full_comparison():
    random = np.random.RandomState(6)
    for spread in (2, 40, 100_000):
        book = np.floor(random.normal(size=(256, 5)) * spread)
        q = np.floor(random.normal(size=(3000, 5)) * spread * 1.5)
        d2 = ((q[:, None] - book[None]) ** 2).sum(axis=2)
        entry, best = codes.Gnat(book).nearest(q)
        assert (entry == d2.argmin(axis=1)).all() and (best == d2.min(axis=1)).all()


def test_subtrees_are_left_out():
    """On entries in clusters the tree compares a query with a part of the entries only."""
    random, compared = np.random.RandomState(7), []
    book = np.floor((random.randint(0, 12, 256)[:, None] * 5000) + random.normal(size=(256, 4)) * 50)
    tree, plain = codes.Gnat(book), codes.squared
    codes.squared = lambda a, b: compared.append(len(a) * len(b)) or plain(a, b)
    try:
        entry, _ = tree.nearest(book)
    finally:
        codes.squared = plain
    assert (book[entry] == book).all() and sum(compared) < 0.5 * 256 * 256


def test_codes_odd_rows(spark):
    good = [(k, [k + 0.5, -k / 3, 1.0, 0.0], k % 2) for k in range(9)]
    rows = [*good, good[3], (None, [1.0, 2.0, 3.0, 4.0], None), (50, None, 1), (51, [1.0, None, 1.0, 1.0], 1), (52, [float("nan")] * 4, 1),
            (53, [float("inf"), 0.0, 0.0, 0.0], 1), (54, [], 7), (55, [1.0] * 6, 8), (56, [0.0] * 4, None), (57, [2.0 ** 60] * 4, 9)]
    got = codes.vector_codes(spark.createDataFrame(rows, SCHEMA))
    by_id = {r.vec_id: r for r in got.collect()}
    assert got.count() == len(rows) - 4 and not {50, 51, 52, 53} & set(by_id)
    assert [(by_id[k].code, by_id[k].error, by_id[k].label_error) for k in (54, 55)] == [(None, None, None)] * 2
    assert all(re.fullmatch("[0-9a-f]{8}", by_id[k].code) for k in [*range(9), None, 56, 57])
    assert by_id[56].label_error == by_id[None].label_error == by_id[56].error + by_id[None].error
    none = spark.createDataFrame(rows, SCHEMA).where("vec_id IN (50, 54)")
    assert [r.code for r in codes.vector_codes(none).collect()] == [None]
    assert codes.vector_codes(none.limit(0)).collect() == []


def test_label_sums_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.createDataFrame([(k, "00", k, None if k % 5 == 0 else k % 5) for k in range(100)], "vec_id long, code string, error long, label int")
    want = sorted(map(tuple, codes.with_label_error(rows).collect()), key=str)
    monkeypatch.setattr(codes, "LABELS", 2)
    salted = codes.with_label_error(rows)
    assert "Broadcast" not in salted._jdf.queryExecution().analyzed().toString() and sorted(map(tuple, salted.collect()), key=str) == want
