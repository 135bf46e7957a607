"""Parts of the training-data operators that once did less than the whole job."""

from __future__ import annotations

import collections
import glob
import tempfile
import time
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from ratewell.llm import hnsw, jaccard, licenses, lm, mixing, urls
from ratewell.llm.common import stored


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    """They go when the write ends, not with some later collection of garbage; the session's settings stay as they were."""
    files = lambda: set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/*/shuffle_*"))
    settings, before = dict(spark.sparkContext.getConf().getAll()) | spark.conf.getAll, files()
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
    rows.write.format("noop").mode("overwrite").save()
    assert files() - before  # of a plain write they are seen
    before = files()
    got = stored(rows.join(rows.withColumnRenamed("count", "n"), "k"), "no-shuffle-files")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and got.count() == rows.count() == 100
    assert dict(spark.sparkContext.getConf().getAll()) | spark.conf.getAll == settings


def test_nearest_tasks_see_one_block(spark):
    """A search task sees one shard and one block of queries, and many of both lose no neighbour."""
    x = np.random.RandomState(4).normal(size=(600, 8))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = hnsw.nearest(rows, rows.where("vec_id % 2 = 0"), top=5, shard=100, block=32)
    plan = got._jdf.queryExecution().toString()
    assert any("FlatMapCoGroupsInPandas" in line and "block" in line.split("found(")[0] for line in plan.splitlines()), plan
    named = collections.defaultdict(list)
    for r in got.orderBy("query_id", "rank").collect():
        named[r.query_id].append(r.vec_id)
    hits = 0
    for k in range(0, 600, 2):
        s = x @ x[k]
        s[k] = -np.inf
        hits += len(set(named[k]) & set(np.argsort(-s)[:5].tolist()))
    assert len(named) == 300 and hits >= 0.98 * 5 * 300


def test_an_empty_block_adds_no_link(spark):
    """One huge text makes many blocks for a small crowd, some of them empty: no link is counted for an empty partner."""
    words = [f"w{k}" for k in range(120)]
    rows = [(doc, " ".join([*words[:119], f"own{doc}"])) for doc in range(20)] + [(20, " ".join(words) + " " * 25_000_000)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {doc: (0, 20) for doc in range(21)}


def test_every_training_document_is_learned(spark):
    """Whatever its id: a table of one training document changes the weights; one that is held out or has no id does not."""
    shape = lm.Shape(4)
    totals = SimpleNamespace(shape=shape, start=np.zeros(shape.classes), head_counts=np.zeros(shape.head))
    first, text = lm.first_weights(totals), np.array([1, 2, 3, 4, 0] * 40, np.uint16).tobytes()
    for doc, fold in (("1", "0"), ("2", "1"), ("3", "3"), ("4", "2"), (None, None)):
        made = lm.fit(spark.createDataFrame([(doc, doc, fold, text)], "block string, doc_id string, fold string, symbols binary"), totals)
        assert (np.abs(made - first).max() > 0) == (fold in ("0", "1", "3"))


def test_keep_one_of_classes_without_ids(spark):
    """Near copies without ids, and near copies that share the smallest id: one row of each class stays."""
    def near(tag, k):
        return " ".join([f"{tag}{j}" for j in range(60)] + [f"own{tag}{k}"])

    rows = [(None, near("a", k)) for k in range(3)] + [(5, near("b", 0)), (5, near("b", 1)), (9, near("b", 2))] + [(None, near("c", k)) for k in range(2)] + [(7, near("c", 9))]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text[0], r.doc_id or 0) for r in got) == [("a", 0), ("b", 5), ("c", 7)]


def test_copies_of_a_url_do_not_fill_the_sample(spark):
    rows = spark.range(1000).selectExpr("concat('h', id, '.com') host", "'/x' path", "cast(id % 2 as int) block")
    for url in range(30):  # some of them fall into the share, some don't
        rows = rows.unionAll(spark.range(2000).selectExpr(f"'hot{url}.com' host", "'/' path", "1 block"))
    got = urls.sampled(rows, 100).collect()
    assert 50 < len(got) < 150 and {r.n for r in got} == {1, 2000}
    assert len(urls.fit(rows, 100)) == (1 << urls.BITS) + 1


def test_notices_repeated_many_times(spark):
    """Time grows with the length of a text: thousands of notices in one text, and words that vote without a notice."""
    one, n = "Licensed under CC BY-NC 4.0\n", 20_000
    rows = [(1, one * n), (2, "licensed " * 30_000 + "under cc by nc 4 0"), (3, "cc nc by 4 " * 20_000)]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word) == (7 * n, n, 2, 7 * n - 5)
    assert [got[k].labels for k in (1, 2, 3)] == ["cc-by,cc-by-nc-4.0"] * 2 + [""]
    assert got[1].score == got[2].score == 1.0 and got[3].n_base == 0


def test_mixing_moves_documents_once(spark, tmp_path):
    """One exchange of documents, into known ranges of the hash, in which the order is global; many sources are not broadcast."""
    spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "concat('s', id % 7) AS source").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    copies = mixing.shuffled(mixing.replicate(docs))
    shown = copies._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange") == 2 and "BroadcastExchange" in shown and "rangepartitioning" not in shown
    keys = [(r.shuffle_key, r.copy) for r in copies.collect()]
    assert keys == sorted(keys) and len(keys) > 2000
    parts = copies.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 2 * min(r["count"] for r in parts)


def test_mixing_many_sources(spark, monkeypatch):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id) AS text", "IF(id % 9 = 0, NULL, concat('s', id % 7)) AS source")
    want = sorted((r.row.doc_id, r.copy, r.shuffle_key) for r in mixing.replicate(docs).collect())
    monkeypatch.setattr(mixing, "SOURCES", 3)
    assert sorted((r.row.doc_id, r.copy, r.shuffle_key) for r in mixing.replicate(docs).collect()) == want
