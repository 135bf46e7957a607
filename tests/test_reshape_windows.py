import random
from datetime import timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import D, stage, tuples
from ratewell.functions.numeric import difference, jump, relative_change, safe_divide
from ratewell.functions.ordering import previous_day
from ratewell.operators.reshape import rebase, series_columns, stamp, to_long, to_wide
from ratewell.operators.windows import pct_change, rolling_stats
from ratewell.params import Params
from ratewell.plans.marts import display_order, mart_daily, quality_daily, stg_rates, stg_rates_wide

NINE = Decimal("0.000000001")


def nine(x):
    return x.quantize(NINE, ROUND_HALF_UP)


def pair(spark, a, b):
    return spark.createDataFrame([(a and Decimal(a), b and Decimal(b))], "a decimal(38,9), b decimal(38,9)")


@pytest.mark.parametrize("a, b, wanted", [
    ("1", "3", "0.333333333"), ("2", "3", "0.666666667"), ("1", "0", None), (None, "1", None), ("1", None, None),
    ("0", "5", "0"), ("123456789012.5", "0.5", "246913578025"), ("5", "123456789012.5", "0"),
])
def test_safe_divide(spark, a, b, wanted):
    got = pair(spark, a, b).select(safe_divide(F.col("a"), F.col("b"))).first()[0]
    assert got == (None if wanted is None else Decimal(wanted))


def test_exact_difference_and_change(spark):
    row = pair(spark, "1.000000001", "1").select(
        difference(F.col("a"), F.col("b")), relative_change(F.col("a"), F.col("b"))
    ).first()
    assert list(row) == [NINE, NINE]


def test_jump_is_double(spark):
    one = lambda a, b: pair(spark, a, b).select(jump(F.col("a"), F.col("b"))).first()[0]
    assert one("1.04", "1") == 0.040000000000000036
    assert one("1", "0") is None


def wide_frame(spark):
    return spark.createDataFrame(
        [("2026-01-05", "1.1", None, ""), ("2026-01-06", "", "N/A", "")],
        "Date string, USD string, GBP string, _trailing_empty string",
    )


def test_to_long_drops_nulls_and_keeps_blanks(spark):
    assert tuples(to_long(wide_frame(spark), "h")) == [
        ("2026-01-05", "USD", "1.1", "h"), ("2026-01-06", "GBP", "N/A", "h"), ("2026-01-06", "USD", "", "h"),
    ]


def test_series_columns_and_stamp(spark):
    assert series_columns(wide_frame(spark)) == ["USD", "GBP"]
    with pytest.raises(ValueError):
        series_columns(wide_frame(spark).select("Date", "_trailing_empty"))
    assert stamp(wide_frame(spark), run_type="manual", n=1).first()["run_type"] == "manual"


def test_wide_and_rebase(spark):
    stg = stage(spark, [("2026-01-05", "USD", 2), ("2026-01-05", "GBP", 0), ("2026-01-06", "USD", 4)])
    wide = to_wide(stg, ["EUR", "USD", "GBP"], "EUR")
    assert tuples(wide) == [
        (D("2026-01-05"), Decimal(1), Decimal(2), Decimal(0)), (D("2026-01-06"), Decimal(1), Decimal(4), None),
    ]
    got = tuples(rebase(wide, ["EUR", "USD", "GBP"], "EUR").where("rate_date = '2026-01-05'"))
    assert got == [
        (D("2026-01-05"), "EUR", Decimal(1), Decimal(2), Decimal(0)),
        (D("2026-01-05"), "GBP", None, None, None),
        (D("2026-01-05"), "USD", Decimal("0.5"), Decimal(1), Decimal(0)),
    ]
    absent = tuples(rebase(wide, ["GBP"], "EUR").where("rate_date = '2026-01-06'"))
    assert absent == [(D("2026-01-06"), "GBP", None, None, None)]


def test_stg_rates_filters_the_stored_code(spark):
    core = stage(spark, [
        ("2025-12-31", "USD", 1), ("2026-01-01", "USD", 2), ("2026-01-31", " USD ", 3), ("2026-02-03", "XXX", 4),
        ("2026-02-03", "GBP", 5),
    ])
    assert tuples(stg_rates(core, Params())) == [
        (D("2026-01-01"), D("2026-01-01"), "EUR", "USD", Decimal(2)),
        (D("2026-02-03"), D("2026-02-01"), "EUR", "GBP", Decimal(5)),
    ]


def history(n, seed=1, code="USD"):
    rng = random.Random(seed)
    day, rows = D("2024-01-01"), []
    for _ in range(n):
        rows.append((day.isoformat(), code, rng.randint(1, 10**7) / 100))
        day += timedelta(days=rng.choice([1, 1, 1, 3, 40]))
    return rows


def expected_rolling(rows, n):
    values = {}
    for i, (day, code, _) in enumerate(rows):
        frame = rows[max(0, i - n + 1): i + 1]
        rates = [Decimal(str(r[2])) for r in frame]
        values[day, code] = (
            D(frame[0][0]), min(rates), max(rates), nine(sum(rates) / len(rates)),
            nine((max(rates) - min(rates)) / min(rates)),
        )
    return values


@pytest.mark.parametrize("block_rows", [None, 29, 40])
def test_rolling_against_brute_force(spark, block_rows):
    series = [history(n, n, code) for n, code in [(1, "AAA"), (6, "BBB"), (7, "CCC"), (30, "DDD"), (31, "EEE"), (200, "FFF")]]
    got = {
        (r["rate_date"].isoformat(), r["currency"]): r
        for r in rolling_stats(stage(spark, sum(series, [])), block_rows=block_rows).collect()
    }
    assert len(got) == 275
    for n in (7, 30):
        names = [f"{c}_{n}d" for c in ("window_start_date", "rate_min", "rate_max", "rate_avg", "range_pct")]
        for rows in series:
            for key, wanted in expected_rolling(rows, n).items():
                assert tuple(got[key][c] for c in names) == wanted, (key, n)


@pytest.mark.parametrize("block_rows", [None, 1, 3])
def test_pct_change_against_brute_force(spark, block_rows):
    rows = history(25) + history(1, 2, "GBP")
    got = {r["rate_date"].isoformat(): r for r in pct_change(stage(spark, rows), block_rows=block_rows).collect()}
    assert len(got) == 24
    for before, now in zip(rows[:24], rows[1:25]):
        a, b = Decimal(str(before[2])), Decimal(str(now[2]))
        assert (got[now[0]]["prev_rate"], got[now[0]]["pct_change"]) == (a, nine(b / a) - 1)


def test_change_on_a_zero_or_null_base(spark):
    rows = [("2026-01-05", "USD", 0), ("2026-01-06", "USD", 1), ("2026-01-07", "USD", None), ("2026-01-08", "USD", 2)]
    assert tuples(pct_change(stage(spark, rows)), "rate_date", "pct_change") == [
        (D("2026-01-06"), None), (D("2026-01-07"), None),
    ]


def test_rolling_ignores_null_rates(spark):
    rows = [("2026-01-05", "USD", None), ("2026-01-06", "USD", 1), ("2026-01-07", "USD", None), ("2026-01-08", "USD", 2)]
    got = tuples(rolling_stats(stage(spark, rows), windows=(2,)), "rate_date", "window_start_date_2d", "rate_avg_2d")
    assert got == [
        (D("2026-01-05"), D("2026-01-05"), None), (D("2026-01-06"), D("2026-01-05"), Decimal(1)),
        (D("2026-01-07"), D("2026-01-06"), Decimal(1)), (D("2026-01-08"), D("2026-01-07"), Decimal(2)),
    ]


def test_block_must_cover_the_frame(spark):
    with pytest.raises(ValueError):
        rolling_stats(stage(spark, history(3)), block_rows=28)


def test_previous_day_crosses_empty_years(spark):
    days = ["2020-12-30", "2020-12-31", "2023-06-01", "2023-06-02", "2023-06-02", "2025-01-01"]
    df = spark.createDataFrame([(D(d),) for d in days], "rate_date date")
    assert tuples(previous_day(df)) == sorted([
        (D("2020-12-30"), None), (D("2020-12-31"), D("2020-12-30")), (D("2023-06-01"), D("2020-12-31")),
        (D("2023-06-02"), D("2023-06-01")), (D("2025-01-01"), D("2023-06-02")),
    ], key=lambda t: [str(x) for x in t])


PARAMS = Params(required=("USD", "GBP"), bases=("EUR", "USD"))


def quality(spark, rows, as_of, stored, **kwargs):
    stg = stg_rates(stage(spark, rows), PARAMS)
    changes = pct_change(stg) if stored else None
    return {r["rate_date"].isoformat(): r for r in quality_daily(stg, changes, PARAMS, as_of, **kwargs).collect()}


@pytest.mark.parametrize("stored", [True, False])
def test_quality_daily(spark, stored):
    rows = [
        ("2026-01-01", "USD", 1), ("2026-01-01", "GBP", 1),
        ("2026-01-02", "USD", "1.01"), ("2026-01-02", "GBP", 1),
        ("2026-01-03", "USD", 2),
        ("2026-01-06", "USD", 2),
        ("2026-01-07", "USD", 2), ("2026-01-07", "GBP", "1.02"),
    ]
    got = quality(spark, rows, "2026-01-08", stored)
    assert len(got) == 8
    assert {d: r["alert"] for d, r in got.items()} == {
        "2026-01-01": None,
        "2026-01-02": None,  # exactly at the threshold
        "2026-01-03": "LARGE_CHANGE",  # a weekend day may report a change
        "2026-01-04": None,
        "2026-01-05": "MISSING_DATA",
        "2026-01-06": "INCOMPLETE_DATA",
        "2026-01-07": "LARGE_CHANGE",
        "2026-01-08": "MISSING_DATA",
    }
    assert [got[d]["expected_currency_count"] for d in ("2026-01-02", "2026-01-03")] == [2, 0]
    assert got["2026-01-02"]["avg_abs_pct_change"] == Decimal("0.005")
    assert got["2026-01-07"]["max_abs_pct_change"] == Decimal("0.02")
    assert (got["2026-01-04"]["row_count"], got["2026-01-04"]["max_abs_pct_change"]) == (0, None)


def test_quality_daily_holidays_and_empty_span(spark):
    rows = [("2026-01-01", "USD", 1)]
    assert quality(spark, rows, "2026-01-02", True, holidays=["2026-01-02"])["2026-01-02"]["alert"] is None
    assert quality(spark, rows, "2025-12-31", True) == {}


def test_display_order(spark):
    stg = stg_rates(stage(spark, [("2026-01-05", "USD", 1), ("2026-01-06", "USD", 2), ("2026-01-06", "GBP", 2)]), PARAMS)
    shown = display_order(rolling_stats(stg), "mart_rolling_stats")
    assert [(r["rate_date"].day, r["currency"]) for r in shown.collect()] == [(6, "GBP"), (6, "USD"), (5, "USD")]
    daily = display_order(mart_daily(stg_rates_wide(stg, PARAMS), PARAMS), "mart_daily")
    assert [(r["base_currency"], r["rate_date"].day) for r in daily.collect()] == [("EUR", 6), ("EUR", 5), ("USD", 6), ("USD", 5)]
    assert display_order(stg, "stg_rates") is stg


def test_models_have_the_documented_columns(spark):
    stg = stg_rates(stage(spark, history(3)), Params())
    assert stg.columns == ["rate_date", "rate_month", "base_currency", "currency", "rate"]
    wide = stg_rates_wide(stg, Params())
    assert wide.columns == ["rate_date"] + [f"rate_{c}" for c in ("eur", "usd", "gbp", "jpy", "chf", "cad", "aud")]
    daily = mart_daily(wide, Params())
    assert daily.columns == ["rate_date", "base_currency", *wide.columns[1:]]
    assert {t for c, t in daily.dtypes if c.startswith("rate_") and c != "rate_date"} == {"decimal(38,9)"}
    assert pct_change(stg).columns == ["rate_date", "currency", "rate", "prev_rate", "pct_change"]
