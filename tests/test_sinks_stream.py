from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ratewell.operators.gates import GateFailed, stage_gates
from ratewell.operators.reconcile import late_diff
from ratewell.plans.views import zip_bytes
from ratewell.schemas import INGESTION_LOG
from ratewell.sources.scratch import scratch_folder
from ratewell.sources.sinks import (
    insert_missing, materialize, promote, replace_days, replace_partition, replace_table, write_snapshot, write_stage,
)
from ratewell.sources.tables import (
    Tables, contains, find_table, latest_snapshot, present_keys, scan, snapshot_by_hash, table_rows,
)
from ratewell.streaming.landing import land_stream, landing_files
from tests.helpers import D, stage, tuples

GOOD = [("2026-01-05", "USD", 1), ("2026-01-05", "GBP", 2), ("2026-02-05", "USD", 3)]


def short(df):
    return [(str(d), c, int(r)) for d, c, r in tuples(df, "rate_date", "currency", "rate")]


def test_tables(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert tables.find("t") is None and table_rows(spark, tables.path("t")) is None
    write_snapshot(stage(spark, GOOD), tables.path("t"))
    write_snapshot(stage(spark, GOOD[:2]), tables.path("t"))
    assert table_rows(spark, tables.path("t")) == 2
    assert contains(tables.source("t"), "h") and not contains(tables.source("t"), "x")
    assert contains(tables.source("t"), "h", "2026-01-05") and not contains(tables.source("t"), "h", "2026-02-05")
    assert scan(spark, tables.path("t"), "x").isEmpty() and scan(spark, tables.path("t")).count() == 2
    wanted = spark.createDataFrame([("h",), ("x",)], "hash_id string")
    assert tuples(present_keys(tables.source("t"), wanted, ["hash_id"])) == [("h",)]


def test_log_lookups(spark):
    rows = [("a", "u", 1, datetime(2026, 1, 5)), ("b", "v", 2, datetime(2026, 1, 7)), ("c", "w", 3, datetime(2026, 1, 6))]
    log = spark.createDataFrame([(*r, None, None, None) for r in rows], INGESTION_LOG)
    assert tuples(latest_snapshot(log, ["zip_size", "hash_id", "zip_size"])) == [("b", 2)]
    assert tuples(snapshot_by_hash(log, "c", ["gcs_zip_uri"])) == [("c", "w")]
    assert snapshot_by_hash(log, "z", ["gcs_zip_uri"]).isEmpty()
    for bad in ([], ["drop_me"]):
        with pytest.raises((KeyError, ValueError)):  # the log's schema itself knows its fields
            latest_snapshot(log, bad)


def test_replace_table_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(stage(spark, GOOD), path)
    replace_table(find_table(spark, path).where("currency = 'USD'"), path)
    assert short(find_table(spark, path)) == [("2026-01-05", "USD", 1), ("2026-02-05", "USD", 3)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_materialize(spark, tmp_path):
    assert materialize(stage(spark, GOOD), "m", "view").count() == 3
    assert spark.table("m").count() == 3
    assert materialize(stage(spark, GOOD), "m", "table", str(tmp_path / "m")).count() == 3
    with pytest.raises(ValueError):
        materialize(stage(spark, GOOD), "m", "table")


def test_write_stage_is_partitioned_by_month(spark, tmp_path):
    path = str(tmp_path / "s")
    write_stage(stage(spark, GOOD), path)
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["rate_month=2026-01-01", "rate_month=2026-02-01"]
    assert short(find_table(spark, path)) == short(stage(spark, GOOD))


def test_promote_only_what_passes(spark, tmp_path):
    path = str(tmp_path / "s")
    gates = lambda written: stage_gates(written, "h")
    promote(stage(spark, GOOD), gates, path)
    with pytest.raises(GateFailed, match="positive_rate"):
        promote(stage(spark, [*GOOD, ("2026-03-05", "USD", 0)]), gates, path)
    assert short(find_table(spark, path)) == short(stage(spark, GOOD))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["s"]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_replace_days(spark, tmp_path, grain):
    path = str(tmp_path / "core")
    replace_days(stage(spark, [*GOOD, ("2026-01-06", "USD", 4)]), path, grain=grain)
    replace_days(stage(spark, [("2026-01-05", "USD", 9), ("2026-03-01", "JPY", 7)]), path, grain=grain, order=["currency"])
    wanted = [("2026-01-05", "USD", 9), ("2026-01-06", "USD", 4), ("2026-02-05", "USD", 3), ("2026-03-01", "JPY", 7)]
    assert short(find_table(spark, path)) == wanted
    replace_days(stage(spark, []), path, grain=grain)
    assert short(find_table(spark, path)) == wanted
    with pytest.raises(ValueError):
        replace_days(stage(spark, GOOD), path, grain="week")


def test_replace_days_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "core")
    replace_days(stage(spark, GOOD), path)
    plan = find_table(spark, path).where(F.col("rate_date") == D("2026-01-05"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rate_date" in plan


def test_empty_diff_clears_the_check_date(spark, tmp_path):
    path = str(tmp_path / "late")
    some = late_diff(stage(spark, GOOD), stage(spark, []), "2026-01-06")
    for day in ("2026-01-06", "2026-01-07"):
        replace_partition(some.withColumn("check_date", F.lit(D(day))), path, "check_date", day)
    replace_partition(some.limit(0), path, "check_date", "2026-01-06")
    got = find_table(spark, path)
    assert tuples(got.groupBy("check_date").count()) == [(D("2026-01-07"), 2)]


def test_insert_missing(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "hash_id string")
    insert_missing(frame(["a", "a", "b"]), path)
    insert_missing(frame(["b", "c", "c"]), path)
    insert_missing(frame(["a"]), path)
    assert tuples(find_table(spark, path)) == [("a",), ("b",), ("c",)]


def test_scratch_folder_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    name = scratch_folder(spark, "x")
    assert before is None or name.startswith(before)
    assert scratch_folder(spark, "x") != name


def test_land_stream_logs_each_content_once(spark, tmp_path):
    landing, log, checkpoint = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "cp")
    landing.mkdir()
    first, second = zip_bytes("a.csv", "Date,USD\n2026-01-05,1\n"), zip_bytes("a.csv", "Date,USD\n2026-01-05,2\n")

    def land():
        land_stream(landing_files(spark, str(landing)), log, checkpoint, 1000).awaitTermination()
        return find_table(spark, log)

    (landing / "a.zip").write_bytes(first)
    (landing / "copy.zip").write_bytes(first)
    (landing / "huge.zip").write_bytes(b"x" * 1001)
    assert land().count() == 1
    (landing / "again.zip").write_bytes(first)
    (landing / "b.zip").write_bytes(second)
    got = land()
    assert sorted(r["zip_size"] for r in got.collect()) == sorted([len(first), len(second)])
    assert got.columns == INGESTION_LOG.fieldNames()
    assert got.where("gcs_csv_uri is not null").isEmpty()
    assert land().count() == 2
