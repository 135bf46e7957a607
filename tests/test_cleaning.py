from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, tuples
from ratewell.functions.cleaning import clean_code, is_series_code, strict_date, strict_numeric, strip_blanks
from ratewell.operators.gates import GateFailed, enforce, stage_gates
from ratewell.operators.reshape import clean_long
from ratewell.schemas import RAW_LONG


def values(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_numbers(spark):
    texts = [None, "", "  ", "N/A", " N/A ", "abc", "n/a", " 1.5 ", "1.2345678905", "0", "-1", "1e2", "\t2 "]
    wanted = [None] * 7 + [
        Decimal("1.5"), Decimal("1.234567891"), Decimal(0), Decimal(-1), Decimal(100), Decimal(2)
    ]
    assert values(spark, texts, strict_numeric) == wanted


def test_dates(spark):
    texts = ["2026-01-05", "2026-1-5", "2026-01", "2026", "2026-01-05 10:00", "", None, " 2026-01-05", "2026-02-30",
             "2026-01-05\n", "0000-01-01"]
    assert values(spark, texts, strict_date) == [D("2026-01-05")] * 2 + [None] * 9


def test_codes(spark):
    assert values(spark, [" usd ", "\tUSD ", "USD\n", " eur　"], clean_code) == ["USD", "USD", "USD", "EUR"]
    assert values(spark, ["USD", "US", "USDT", "USD\n", "usd", "ÄÖÜ"], is_series_code) == [True] + [False] * 5
    assert values(spark, [" a b "], strip_blanks) == ["a b"]


def raw(spark, rows):
    return spark.createDataFrame([(*r, "h") if len(r) == 3 else r for r in rows], RAW_LONG)


def test_clean_long_drops_and_deduplicates(spark):
    rows = [
        ("2026-01-05", "USD", "1.5"), ("2026-01-05", "USD", " 1.50 "), ("2026-01-05", " ", "1"),
        ("2026-01-05", None, "1"), ("2026-01", "USD", "1"), ("2026-01-06", "USD", "N/A"),
        ("2026-01-06", " gbp\t", "2"), ("2026-01-06", "JPY", "3", "other"),
    ]
    assert tuples(clean_long(raw(spark, rows), "h")) == [
        (D("2026-01-05"), "USD", Decimal("1.5"), "h"), (D("2026-01-06"), "GBP", Decimal(2), "h"),
    ]
    assert clean_long(raw(spark, rows)).count() == 3


def gate_status(spark, rows, hash_id="h"):
    typed = spark.createDataFrame(
        [(D(d), c, Decimal(r), h) for d, c, r, h in rows],
        "rate_date date, currency string, rate decimal(38,9), hash_id string",
    )
    return {r["check"]: (r["status"], r["observed"]) for r in stage_gates(typed, hash_id).collect()}


def test_stage_gates(spark):
    good = [("2026-01-05", "USD", "1", "h"), ("2026-01-05", "GBP", "2", "h")]
    assert gate_status(spark, good) == {
        "not_empty": ("PASS", 2), "holds_snapshot": ("PASS", 2), "series_format": ("PASS", 0),
        "positive_rate": ("PASS", 0), "unique_key": ("PASS", 0),
    }
    bad = [
        *good, ("2026-01-06", "US", "1", "h"), ("2026-01-06", "USDT", "1", "h"), ("2026-01-06", "USD\n", "1", "h"),
        ("2026-01-07", "USD", "0", "h"), ("2026-01-08", "USD", "-1", "h"), ("2026-01-05", "USD", "9", "h"),
    ]
    got = gate_status(spark, bad)
    assert got["series_format"] == ("FAIL", 3)
    assert got["positive_rate"] == ("FAIL", 2)
    assert got["unique_key"] == ("FAIL", 1)


def test_stage_gates_look_at_the_snapshot_only(spark):
    got = gate_status(spark, [("2026-01-05", "us", "0", "other"), ("2026-01-05", "us", "0", "other")])
    assert got["not_empty"] == ("PASS", 2)
    assert got["holds_snapshot"] == ("FAIL", 0)
    assert got["series_format"] == got["positive_rate"] == got["unique_key"] == ("PASS", 0)


def test_empty_candidate_fails(spark):
    frame = spark.createDataFrame([], "rate_date date, currency string, rate decimal(38,9), hash_id string")
    with pytest.raises(GateFailed, match="not_empty"):
        enforce(stage_gates(frame, "h"))
