from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, meta, stage, tuples
from ratewell.functions.calendars import calendar, expected_days, in_window
from ratewell.operators.aggregates import baseline_date, day_meta, diff_summary, duplicate_keys
from ratewell.operators.gates import (
    AcceptedRange, ExpressionIsTrue, GateFailed, NotNull, Unique, accepted_range, enforce, expression_is_true,
    log_gate, not_null, quality_gate, required_gate, snapshot_audit, table_tests, unique, unique_combination,
)
from ratewell.operators.reconcile import late_diff, missing_required, rate_jumps, with_baseline
from ratewell.operators.upserts import fill_missing, missing_rows
from ratewell.params import Params
from ratewell.plans.marts import model_tests
from ratewell.schemas import INGESTION_LOG

PARAMS = Params(required=("USD", "GBP"), holidays=("2026-01-06",))


def test_calendar(spark):
    assert tuples(calendar(spark, "2026-01-30", "2026-02-01")) == [(D(d),) for d in ("2026-01-30", "2026-01-31", "2026-02-01")]
    assert calendar(spark, "2026-02-02", "2026-02-01").count() == 0
    assert calendar(spark, "2020-01-01").count() > 2000
    got = tuples(expected_days(spark, "2026-04-02", "2026-04-06", ["2026-04-03", "2026-04-06"]))
    assert got == [(D(f"2026-04-0{d}"), d == 2) for d in range(2, 7)]


def test_in_window_bounds_the_month_partition(spark):
    df = stage(spark, [("2026-01-30", "USD", 1), ("2026-01-31", "USD", 1), ("2026-02-02", "USD", 1), ("2026-02-03", "USD", 1)])
    months = df.withColumn("rate_month", F.trunc("rate_date", "MM"))
    for frame in (df, months):
        assert [r[0] for r in tuples(in_window(frame, "2026-01-31", "2026-02-02"), "rate_date")] == [D("2026-01-31"), D("2026-02-02")]


def test_missing_required_and_gate(spark):
    df = stage(spark, [("2026-01-05", "USD", 1), ("2026-01-05", "GBP", 1), ("2026-01-06", "JPY", 1), ("2026-01-07", "GBP", 1)])
    assert tuples(missing_required(df, ["USD", "GBP"])) == [
        (D("2026-01-06"), "GBP"), (D("2026-01-06"), "USD"), (D("2026-01-07"), "USD"),
    ]
    assert missing_required(df, []).count() == 0
    gate = {r["rate_date"].day: (r["status"], r["missing"]) for r in required_gate(df, ["USD", "GBP"]).collect()}
    assert gate == {5: ("PASS", []), 6: ("FAIL", ["GBP", "USD"]), 7: ("FAIL", ["USD"])}
    with pytest.raises(GateFailed):
        enforce(required_gate(df, ["USD", "GBP"]))
    both = missing_required(df.withColumn("hash_id", F.lit("z")), ["USD"], ["hash_id", "rate_date"])
    assert tuples(both) == [("z", D("2026-01-06"), "USD"), ("z", D("2026-01-07"), "USD")]


def diffs(spark, staged, core, **kwargs):
    df = late_diff(stage(spark, staged, "new"), stage(spark, core, "old"), "2026-01-10", hash_id="new", **kwargs)
    return tuples(df, "rate_date", "currency", "stage_rate", "core_rate", "diff_type", "stage_hash_id", "core_hash_id")


def test_late_diff_kinds_and_window(spark):
    staged = [
        ("2026-01-03", "USD", 1), ("2026-01-02", "GBP", 1), ("2026-01-05", "USD", "1.000000001"),
        ("2026-01-06", "USD", 3), ("2026-01-10", "JPY", 4), ("2026-01-11", "JPY", 4), ("2026-01-09", "AUD", 1, "other"),
    ]
    core = [("2026-01-05", "USD", 1), ("2026-01-06", "USD", 3), ("2026-01-07", "CAD", 5), ("2026-01-02", "CAD", 5)]
    assert diffs(spark, staged, core) == [
        (D("2026-01-03"), "USD", Decimal(1), None, "late_insert", "new", None),
        (D("2026-01-05"), "USD", Decimal("1.000000001"), Decimal(1), "late_update", "new", "old"),
        (D("2026-01-07"), "CAD", None, Decimal(5), "core_extra", None, "old"),
        (D("2026-01-10"), "JPY", Decimal(4), None, "late_insert", "new", None),
    ]


def test_late_diff_eps_is_strict(spark):
    staged, core = [("2026-01-05", "USD", "1.5"), ("2026-01-06", "USD", "1.500000001")], [("2026-01-05", "USD", 1), ("2026-01-06", "USD", 1)]
    assert [d[0].day for d in diffs(spark, staged, core, eps="0.5")] == [6]


def test_late_diff_columns_and_summary(spark):
    df = late_diff(stage(spark, [("2026-01-05", "USD", 1)]), stage(spark, []), "2026-01-10", detected_at=F.lit(datetime(2026, 1, 10)))
    row = df.first()
    assert (row["check_date"], row["lookback_date"], row["detected_at"]) == (D("2026-01-10"), D("2026-01-03"), datetime(2026, 1, 10))
    assert tuples(diff_summary(df, "2026-01-10")) == [("late_insert", 1)]
    assert tuples(diff_summary(df, "2026-01-11")) == []


def test_day_meta(spark):
    df = stage(spark, [("2026-01-05", "USD", 2), ("2026-01-05", "GBP", 1), ("2026-01-06", "USD", 3)])
    got = {r["rate_date"].day: r for r in day_meta(df, ["USD", "GBP"], "manual", F.lit(datetime(2026, 1, 7))).collect()}
    assert [(p["currency"], p["rate"]) for p in got[5]["rates"]] == [("GBP", Decimal(1)), ("USD", Decimal(2))]
    assert (got[5]["row_count"], got[5]["currency_count"], got[5]["run_type"]) == (2, 2, "manual")
    assert got[6]["required_curr"] == ["USD", "GBP"]


def test_duplicate_keys(spark):
    df = stage(spark, [("2026-01-05", "USD", 1), ("2026-01-05", "USD", 2), ("2026-01-06", "USD", 1)])
    assert tuples(duplicate_keys(df)) == [(D("2026-01-05"), "USD", 2)]


def test_baseline_and_jumps(spark):
    df = meta(spark, [
        ("2025-12-30", {"USD": 1, "GBP": 0, "JPY": 5}), ("2026-01-05", {"USD": "1.04", "GBP": 1}),
        ("2026-01-07", {"USD": 1}),
    ])
    assert baseline_date(df, "2026-01-05").first()[0] == D("2025-12-30")
    assert baseline_date(df, "2025-12-30").first()[0] is None
    based = with_baseline(df)
    assert tuples(based, "rate_date", "baseline_date") == sorted([
        (D("2025-12-30"), None), (D("2026-01-05"), D("2025-12-30")), (D("2026-01-07"), D("2026-01-05")),
    ], key=lambda t: [str(x) for x in t])
    jumps = tuples(rate_jumps(based), "rate_date", "currency", "jump")
    assert jumps == [(D("2026-01-05"), "USD", 0.040000000000000036), (D("2026-01-07"), "USD", abs(1 / 1.04 - 1))]


def gate(spark, rows, day, expected_hash="h", params=PARAMS):
    days = expected_days(spark, day, day, params.holidays)
    row = quality_gate(meta(spark, rows), days, params, expected_hash).first()
    return row["status"], row["check"]


FIRST = ("2026-01-01", {"USD": 1, "GBP": 1})


@pytest.mark.parametrize("rows, day, wanted", [
    ([FIRST], "2026-01-01", ("PASS", "no_baseline")),
    ([FIRST], "2026-01-03", ("SKIP", "not_expected")),
    ([FIRST], "2026-01-06", ("SKIP", "not_expected")),
    ([FIRST], "2026-01-05", ("FAIL", "meta_missing")),
    ([("2026-01-01", {"USD": 1}, {"hash_id": "x"})], "2026-01-01", ("FAIL", "other_snapshot")),
    ([("2026-01-01", {"USD": 1}, {"row_count": 0}), ("2026-01-05", {"USD": 1})], "2026-01-05", ("FAIL", "baseline_empty")),
    ([("2026-01-01", {"USD": 1, "GBP": 1}, {"row_count": 10}), ("2026-01-05", {"USD": 1, "GBP": 1}, {"row_count": 8})],
     "2026-01-05", ("PASS", "ok")),
    ([("2026-01-01", {"USD": 1}, {"row_count": 10}), ("2026-01-05", {"USD": 1}, {"row_count": 7})],
     "2026-01-05", ("FAIL", "row_drift")),
    ([("2026-01-01", {"USD": 1}, {"currency_count": 0}), ("2026-01-05", {"USD": 1})],
     "2026-01-05", ("FAIL", "baseline_no_series")),
    ([("2026-01-01", {"USD": 1, "GBP": 1}, {"currency_count": 10}), ("2026-01-05", {"USD": 1, "GBP": 1}, {"currency_count": 9})],
     "2026-01-05", ("PASS", "ok")),
    ([("2026-01-01", {"USD": 1}, {"currency_count": 9}), ("2026-01-05", {"USD": 1}, {"currency_count": 8})],
     "2026-01-05", ("FAIL", "series_drift")),
    ([FIRST, ("2026-01-05", {}, {"row_count": 2, "currency_count": 2})], "2026-01-05", ("FAIL", "no_rates")),
    ([("2026-01-01", None, {"row_count": 2, "currency_count": 2}), ("2026-01-05", {"USD": 1, "GBP": 1})],
     "2026-01-05", ("FAIL", "no_rates")),
    ([FIRST, ("2026-01-05", {"USD": 1, "JPY": 1})], "2026-01-05", ("FAIL", "required_missing")),
    ([FIRST, ("2026-01-05", {"USD": "1.04", "GBP": 1})], "2026-01-05", ("FAIL", "rate_jump")),
    ([FIRST, ("2026-01-05", {"USD": "1.0399", "GBP": 1})], "2026-01-05", ("PASS", "ok")),
    ([("2026-01-01", {"USD": 0, "GBP": 1}), ("2026-01-05", {"USD": 9, "GBP": 1})], "2026-01-05", ("PASS", "ok")),
])
def test_quality_gate_rules(spark, rows, day, wanted):
    assert gate(spark, rows, day) == wanted


def test_quality_gate_lists_all_jumps(spark):
    rows = [FIRST, ("2026-01-05", {"USD": 2, "GBP": 3})]
    row = quality_gate(meta(spark, rows), expected_days(spark, "2026-01-05", "2026-01-05"), PARAMS).first()
    assert [(j["currency"], j["jump"]) for j in row["jumps"]] == [("GBP", 2.0), ("USD", 1.0)]
    assert (row["observed"], row["threshold"], row["missing"]) == (2.0, 0.04, None)


def log(spark, rows):
    at = datetime(2026, 1, 5)
    return spark.createDataFrame([
        (h, z, s, at, c, n, at if c else None) for h, z, s, c, n in rows
    ], INGESTION_LOG)


def test_log_gate(spark):
    wanted = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 1)], "hash_id string, zip_size long")
    logged = log(spark, [("a", "zip/a", 1, None, None), ("b", "", 1, None, None), ("c", None, 1, None, None), ("d", "zip/d", 2, None, None)])
    got = {r["hash_id"]: (r["status"], r["check"]) for r in log_gate(wanted, logged, ["gcs_zip_uri", "zip_size"], ["zip_size"]).collect()}
    assert got == {
        "a": ("PASS", "ok"), "b": ("FAIL", "gcs_zip_uri_missing"), "c": ("FAIL", "gcs_zip_uri_missing"),
        "d": ("FAIL", "zip_size_differs"), "e": ("FAIL", "row_missing"),
    }


def test_snapshot_audit(spark):
    logged = log(spark, [("a", "p/a", 1, None, None), ("b", "p/b", 1, None, None), ("c", "p/c", 1, None, None), ("d", "p/d", 1, None, None), ("e", None, None, None, None)])
    files = spark.createDataFrame([("p/a", 1, "a"), ("p/b", 2, "b"), ("p/c", 1, "x")], "path string, size long, hash_id string")
    got = {r["hash_id"]: r["check"] for r in snapshot_audit(logged, files).collect()}
    assert got == {"a": "ok", "b": "size_differs", "c": "hash_differs", "d": "file_missing"}


def test_upserts(spark):
    logged = log(spark, [("a", "zip/a", 1, "csv/a", 5), ("b", "zip/b", 1, None, None), ("c", "zip/c", 1, None, None)])
    new = log(spark, [("a", "zip/other", 9, None, None), ("d", "zip/d", 2, None, None), ("d", "zip/d", 2, None, None)])
    assert tuples(missing_rows(logged, new), "hash_id") == [("d",)]
    at = datetime(2026, 1, 9)
    updates = spark.createDataFrame(
        [("a", "csv/x", 7, at), ("b", "csv/b", 8, at), ("z", "csv/z", 9, at)],
        "hash_id string, gcs_csv_uri string, csv_size long, unpacked_at timestamp",
    )
    filled = fill_missing(logged, updates)
    assert filled.columns == logged.columns
    assert tuples(filled, "hash_id", "gcs_csv_uri", "csv_size") == [
        ("a", "csv/a", 5), ("b", "csv/b", 8), ("c", None, None),
    ]


def test_declared_tests(spark):
    df = stage(spark, [("2026-01-05", "USD", 1), ("2026-01-05", "USD", 2), ("2026-01-06", None, 0), ("2026-01-07", "GBP", None)])
    tests = [
        Unique(("rate_date", "currency")), NotNull("currency"), NotNull("rate"), AcceptedRange("rate", low=0, inclusive=False),
        ExpressionIsTrue("rate < 2"), Unique(("currency",), combination=False),
    ]
    got = [(r["test"], r["status"], r["failures"]) for r in table_tests(df, tests, "m").collect()]
    assert sorted(got) == sorted([
        ("unique_combination(rate_date, currency)", "FAIL", 1), ("not_null(currency)", "FAIL", 1), ("not_null(rate)", "FAIL", 1),
        ("accepted_range(rate)", "FAIL", 1), ("expression_is_true(rate < 2)", "FAIL", 1), ("unique(currency)", "FAIL", 1),
    ])


def test_offender_frames(spark):
    df = stage(spark, [("2026-01-05", "USD", 1), ("2026-01-05", "USD", 2), ("2026-01-06", None, 0), ("2026-01-07", None, None)])
    assert not_null(df, "currency", "rate").count() == 2
    assert tuples(unique(df, "currency")) == [("USD", 2)]
    assert tuples(unique_combination(df, ["rate_date", "currency"])) == [(D("2026-01-05"), "USD", 2)]
    assert accepted_range(df, "rate", 0, 2, inclusive=False).count() == 2
    assert accepted_range(df, "rate", 0, 2).count() == 0
    assert expression_is_true(df, "rate > 0").count() == 1


def test_forty_declared_tests():
    kinds = {}
    for tests in model_tests(Params()).values():
        for t in tests:
            kind = t.label.split("(")[0]
            kinds[kind] = kinds.get(kind, 0) + 1
    assert kinds == {"not_null": 31, "unique_combination": 5, "unique": 1, "accepted_range": 2, "expression_is_true": 1}
