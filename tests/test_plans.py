"""Shapes of physical plans and behaviour under one hot key."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratewell.operators.aggregates import duplicate_keys
from ratewell.operators.gates import quality_gate, stage_gates
from ratewell.operators.reconcile import late_diff, latest_day_before, meta_around, missing_required
from ratewell.operators.reshape import clean_long, rebase
from ratewell.operators.upserts import missing_rows
from ratewell.operators.windows import pct_change, rolling_stats
from ratewell.params import Params
from ratewell.plans.marts import quality_daily, stg_rates, stg_rates_wide
from ratewell.schemas import CORE_META
from ratewell.sources.sinks import _clustered, replace_days, write_stage
from tests.helpers import D, stage, tuples


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    rows = [(f"2026-0{m}-1{d}", c, m + d) for m in (1, 2, 3) for d in range(5) for c in ("USD", "GBP", "JPY")]
    paths = {name: str(root / name) for name in ("day", "month", "stage")}
    replace_days(stage(spark, rows), paths["day"])
    replace_days(stage(spark, rows), paths["month"], grain="month")
    write_stage(stage(spark, rows), paths["stage"])
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def test_staging_prunes_partitions_and_columns(stored):
    params = Params(start_date="2026-02-12")
    day, month = plan(stg_rates(stored["day"], params)), plan(stg_rates(stored["month"], params))
    assert "PartitionFilters: [isnotnull(rate_date" in day
    assert "PartitionFilters: [isnotnull(rate_month" in month
    assert "PushedFilters: [In(currency" in day
    assert all("hash_id" not in p.split("ReadSchema")[1] for p in (day, month))


def test_rolling_windows_share_one_shuffle_and_sort(stored):
    text = plan(rolling_stats(stg_rates(stored["day"], Params())))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1


def test_bases_and_quality_read_their_input_once(stored):
    params = Params()
    stg = stg_rates(stored["day"], params)
    assert plan(rebase(stg_rates_wide(stg, params), params.bases, params.base)).count("FileScan") == 1
    assert plan(quality_daily(stg, None, params, "2026-04-01")).count("FileScan") == 1
    assert plan(missing_required(stored["day"], params.required)).count("Exchange") == 1


def test_reconciliation_prunes_both_sides(stored):
    text = plan(late_diff(stored["stage"], stored["month"], "2026-02-12", hash_id="h"))
    assert text.count("PartitionFilters: [isnotnull(rate_month") == 2
    assert "FullOuter" in text


def test_stage_gates_take_one_keyed_shuffle(stored):
    text = plan(stage_gates(stored["stage"], "h"))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_partitioned_writes_are_rebalanced(stored):
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(_clustered(stored["day"], "rate_date", ["currency"]))


def hot_series(spark):
    """One series holds more than a third of all rows: 3000 days against 40 series of 100 days."""
    days = spark.range(3000).select(F.date_add(F.lit(D("2010-01-01")), F.col("id").cast("int")).alias("rate_date"), F.lit("HOT").alias("currency"))
    others = spark.range(4000).select(
        F.date_add(F.lit(D("2010-01-01")), (F.col("id") % 100).cast("int")), F.concat(F.lit("S"), (F.col("id") % 40).cast("string"))
    )
    rate = (F.dayofyear("rate_date") + F.length("currency") + 1).cast("decimal(38,9)")
    return days.union(others).withColumn("rate", rate)


def test_blocks_split_a_hot_series_without_changing_it(spark):
    df = hot_series(spark)
    for function in (rolling_stats, pct_change):
        whole, split = function(df), function(df, block_rows=64)
        assert whole.count() == split.count() > 6000
        assert whole.exceptAll(split).count() == 0
    text = plan(pct_change(df, block_rows=64))
    assert "hashpartitioning(currency" in text and "_block" in text


def test_copies_of_a_hot_row_collapse(spark):
    copies = spark.range(30000).select(
        F.lit("2026-01-05").alias("date_str"), F.lit(" usd").alias("currency"), F.lit("1.5").alias("rate_str"), F.lit("h").alias("hash_id")
    )
    few = spark.createDataFrame([("2026-01-06", "GBP", "2", "h"), ("2026-01-06", "GBP", "3", "h")], copies.columns)
    cleaned = clean_long(copies.union(few))
    assert tuples(cleaned, "currency", "rate") == [("GBP", Decimal(2)), ("GBP", Decimal(3)), ("USD", Decimal("1.5"))]
    assert tuples(duplicate_keys(cleaned)) == [(D("2026-01-06"), "GBP", 2)]
    text = plan(cleaned)
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
    log = spark.createDataFrame([("a",)], "hash_id string")
    new = spark.range(30000).select(F.when(F.col("id") < 29990, "a").when(F.col("id") < 29995, "b").otherwise("c").alias("hash_id"))
    assert tuples(missing_rows(log, new)) == [("b",), ("c",)]


def test_one_day_gate_reads_few_months(spark, tmp_path):
    """Every scan of meta by a one-day gate is pruned by literal months, and the baseline may be years back."""
    days = [date(1999, 3, 31), date(2020, 5, 29), *[date(2024, m, d) for m in range(1, 13) for d in (1, 15)]]
    rows = [(d, "scheduled", "h", 2, 2, [("GBP", Decimal(1)), ("USD", Decimal(1))], ["USD", "GBP"], datetime(2026, 1, 1)) for d in days]
    meta = spark.createDataFrame(rows, CORE_META)
    path = str(tmp_path / "core_meta")
    replace_days(meta, path, grain="month")
    stored = spark.read.parquet(path)
    for day, baseline in ((date(2024, 6, 1), date(2024, 5, 15)), (date(2024, 1, 1), date(2020, 5, 29)), (date(2020, 5, 29), date(1999, 3, 31)), (date(1999, 3, 31), None)):
        assert latest_day_before(stored, day) == latest_day_before(meta, day) == baseline
        part = meta_around(stored, day, day)
        assert {r.rate_date for r in part.collect()} == {day, baseline} - {None}
        checked = spark.createDataFrame([(day, True)], "rate_date date, expected boolean")
        gated = quality_gate(part, checked, Params(), "h")
        scans = [line for line in plan(gated).splitlines() if "FileScan" in line]
        assert scans and all("PartitionFilters: [isnotnull(rate_month" in line and "rate_month" in line for line in scans), scans
        got, want = gated.collect(), quality_gate(meta, checked, Params(), "h").collect()
        assert got == want and (got[0].check == "no_baseline") == (baseline is None)


def test_blocked_windows_read_their_input_once(spark, tmp_path):
    """Rows of a series are numbered without a window over the series or its years, and the input is planned once."""
    rows = [(date(2020, 1, 1) + timedelta(days=k), "A" if k % 10 else "B", Decimal(k + 1)) for k in range(2000)]
    spark.createDataFrame(rows, "rate_date date, currency string, rate decimal(38,9)").repartition(7).write.parquet(str(tmp_path / "stg"))
    stg = spark.read.parquet(str(tmp_path / "stg"))
    blocked = rolling_stats(stg, block_rows=64)
    shown = plan(blocked)
    assert str(tmp_path) not in shown  # the input is behind the written, numbered rows
    assert "year(" not in shown and "row_number" not in shown
    assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, rolling_stats(stg).collect()))
