"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratewell.llm import hnsw, jaccard, licenses, lm, mixing, packing, rules, toxicity, urls, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, class_id string, row int, score string"
LONG = " ".join(f"word{k % 977} licence{k % 31}" for k in range(20_000))
ROWS = [
    (1, "a b c d e f g h i j k l", "en", "x"), (2, "a b c d e f g h i j k l", "en", "x"), (2, "a b c d e f g h i j k l", "en", "x"),
    (3, None, "en", None), (4, "", None, "y"), (None, "some text of ten words or more stands in this row here", "en", "x"),
    (None, None, None, None), (5, LONG, "en", "x"), (6, "Licensed under CC BY-NC 4.0. All rights reserved. General   Public\nLicense", "en", "y"),
    (7, "\u212a \u0130 \x00 caf\u00e9 \U0001F600 \t\r\n", "de", "y"), (8, "idiot moron " * 8, "en", "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "w", "c", 3, "s") for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (8, 0, 1), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")


def test_packing(docs):
    got = packing.pack_documents(docs).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert sum(r.start == 0 for r in got) == len(ROWS)
    assert all(r.doc_tokens == 1 and r.length == 1 for r in got if r.doc_id in (3, 4))
    assert packing.pack_documents(docs.limit(0)).count() == 0
    placed = packing.pack(packing.stored(packing.token_pieces(docs), "t"))
    whole = packing.sequences(placed).select(F.length("ids").alias("n")).collect()
    assert sum(r.n for r in whole) == 4 * sum(r.length for r in got)


def test_licenses(docs):
    got = licenses.scan_licenses(docs).collect()
    six = next(r for r in got if r.doc_id == 6)
    assert (six.n_base, six.first_word, six.last_word, six.base_labels) == (3, 2, 10, "cc-by,gpl,reserved")
    assert "cc-by-nc-4.0" in six.labels and six.score == 1.0
    assert [(r.n_words, r.labels, r.score) for r in got if r.doc_id in (3, 4)] == [(0, "", 0.0)] * 2
    assert len(got) == len(ROWS) and licenses.scan_licenses(docs.limit(0)).count() == 0


def test_toxicity(docs, labels):
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


def test_jaccard(docs):
    got = {(r.doc_id, r.class_id, r.n_copies) for r in jaccard.jaccard_join(docs).collect()}
    assert {(1, 1, 3), (2, 1, 3), (3, 3, 3), (4, 3, 3), (None, 3, 3), (None, None, 1)} <= got
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert jaccard.jaccard_join(docs.limit(0)).count() == 0


def test_mixing(docs):
    got = mixing.mix(docs, {"x": 1.0})
    assert got.columns == docs.columns and {r.source for r in got.collect()} <= {"x"}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs).count() >= 0


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/\r\nX: y", "p", 1), (2, None, "p", 1), (2, None, "p", 1), (3, "u", None, 1), (None, "u", "p", 1), (None, None, "q", 1), (2**53 + 1, "z", "x" * 9_000_000, 1)], "page_id long, url string, html string, payload int")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(warc.write_archives(pages)).collect()}
    assert got == {(1, "revisit", 2, 1), (2, "response", None, 1), (3, "response", None, 0), (None, "revisit", 2, 1), (None, "response", None, 1), (2**53 + 1, "response", None, 9_000_000)}
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_rules(docs, labels):
    got = rules.judge(docs, labels).collect()
    assert len(got) == len(ROWS) and all(r.base_failed and not r.kept for r in got if r.n_words == 0)
    assert rules.keep_good(docs, labels).columns == docs.columns
    assert rules.judge(docs.limit(0), labels.limit(0)).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame([(1, "HTTP://WWW.Example.com/en/x?q", "h"), (2, "http://a.example.com/en/", "h"), (3, None, "h"), (4, "no scheme/x", "h"), (5, "x://b.net/es/#f", "h"), (6, "x://example.com", "h"), (7, "x://notnet/es/", "h"), (8, "x://é.com/" + "a" * 100_000, "h")], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert got[1] == ("www.example.com", "www.example.com/en/", "allow") and got[2] == ("a.example.com", "example.com/en/", "block")
    assert got[3][:2] == ("", None) and got[4][:2] == ("", None) and got[5][1] == "net/es/" and got[6][1] is None and got[7][1] is None and got[8][1] == "com/"
    assert urls.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(pages.where("page_id in (3, 4)")).collect()} == {"allow"}


def test_lm(docs):
    got = lm.lm_scores(docs).collect()
    assert len(got) == len(ROWS) and all(r.score < 0 for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (3, 4)] == [1, 1]
    assert lm.lm_scores(docs.limit(0)).count() == 0


def test_hnsw(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k * 5, [1.0, 0.0]) for k in range(40)] + [(k, v) for k, v in enumerate(([0.0, 0.0], None, [nan, 1.0], [inf, 1.0], [None, 1.0], []), 1000)] + [(None, [1.0, 1.0]), (20, [1.0, 0.0]), (7, [3.0, 1.0]), (60, [1.0])]
    got = hnsw.search_table(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, key int")).collect()
    first = [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 20]
    assert first == [(1, 7), *((k + 2, v) for k, v in enumerate([0, 5, 10, 15, *range(25, 100, 5)][:19]))]
    assert hnsw.search_table(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stages_keep_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    # Two documents pass the first stages; a Poisson count may be zero.
    assert all(r.length > 0 for r in corpus_pipeline.run(spark, str(tmp_path)).collect())


def test_pipeline_on_empty_tables(spark, docs, labels, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns


def test_one_hot_id(spark, labels):
    """An id with most of the rows, with one text or many, in the learners."""
    rows = [(8, "idiot moron " * 8)] * 200 + [(8, f"idiot number {k}") for k in range(200)] + [(k, f"a calm text {k}") for k in range(20)]
    hot = spark.createDataFrame(rows, "doc_id long, text string")
    assert toxicity.toxicity(hot, labels).count() == lm.lm_scores(hot).count() == len(rows)
