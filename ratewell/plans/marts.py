"""Staging and mart tables over the core fact table, and the tests declared on them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.calendars import calendar, is_weekday, month_start, to_date
from ratewell.functions.cleaning import clean_code
from ratewell.operators.aggregates import change_stats, day_and_change_stats, day_stats
from ratewell.operators.gates import AcceptedRange, ExpressionIsTrue, NotNull, Unique
from ratewell.operators.reshape import rebase, to_wide, wide_name
from ratewell.operators.windows import with_change
from ratewell.params import Params


def stg_rates(core: DataFrame, params: Params) -> DataFrame:
    """Core rows of the listed codes from the start date. The list is matched against the stored code, the
    output holds the cleaned one. Both predicates reach the scan; a core table partitioned by month also gets
    the bound on its partition column."""
    start = to_date(params.start_date)
    kept = core.where((F.col("rate_date") >= F.lit(start)) & F.col("currency").isin(*params.listed))
    if "rate_month" in core.columns:
        kept = kept.where(F.col("rate_month") >= F.lit(start.replace(day=1)))
    return kept.select(
        "rate_date",
        month_start(F.col("rate_date")).alias("rate_month"),
        F.lit(params.base).alias("base_currency"),
        clean_code(F.col("currency")).alias("currency"),
        "rate",
    )


def stg_rates_wide(stg: DataFrame, params: Params) -> DataFrame:
    return to_wide(stg, params.listed, params.base)


def mart_daily(wide: DataFrame, params: Params) -> DataFrame:
    return rebase(wide, params.bases, params.base)


def alert(row_count: Column, series_count: Column, change: Column, params: Params) -> Column:
    """MISSING_DATA before INCOMPLETE_DATA, both on working days only, before LARGE_CHANGE on any day."""
    working = F.col("data_expected")
    return (
        F.when(working & (row_count == 0), "MISSING_DATA")
        .when(working & (series_count < params.expected_series), "INCOMPLETE_DATA")
        .when(F.coalesce(change, F.lit(0)) > F.lit(str(params.large_change)).cast("decimal(38,9)"), "LARGE_CHANGE")
    )


def quality_daily(
    stg: DataFrame,
    changes: DataFrame | None,
    params: Params,
    as_of: date | str | None = None,
    holidays: Sequence[str] = (),
) -> DataFrame:
    """One row per calendar day from the start date to as_of (default yesterday). Holidays count as working
    days unless given. Stored changes are read beside stg; without them the changes are computed here and stg
    is read once. What is joined to the calendar has one row per day; Spark broadcasts it by its own size
    check, or sorts and merges it."""
    working = is_weekday(F.col("rate_date"))
    if holidays:
        working = working & ~F.col("rate_date").isin([to_date(h) for h in holidays])
    days = calendar(stg.sparkSession, params.start_date, as_of).withColumn("data_expected", working)
    rows = F.coalesce(F.col("row_count"), F.lit(0)).cast("long")
    series = F.coalesce(F.col("currency_count"), F.lit(0)).cast("long")
    if changes is None:
        measured = days.join(day_and_change_stats(with_change(stg)), "rate_date", "left")
    else:
        measured = days.join(day_stats(stg), "rate_date", "left").join(
            change_stats(changes), "rate_date", "left"
        )
    return measured.select(
        "rate_date",
        "data_expected",
        rows.alias("row_count"),
        series.alias("currency_count"),
        F.when(F.col("data_expected"), params.expected_series).otherwise(0).cast("long").alias(
            "expected_currency_count"
        ),
        "avg_abs_pct_change",
        "max_abs_pct_change",
        alert(rows, series, F.col("max_abs_pct_change"), params).alias("alert"),
    )


def display_order_of(model: str) -> list[Column]:
    """The order in which a model is shown, and in which its stored months are written."""
    newest = F.col("rate_date").desc()
    return {
        "stg_rates": [F.col("rate_date"), F.col("currency")],
        "stg_rates_wide": [newest],
        "mart_daily": [F.col("base_currency"), newest],
        "mart_pct_change": [F.col("currency"), newest],
        "mart_quality_daily": [newest],
        "mart_rolling_stats": [newest, F.col("currency")],
    }.get(model, [])


def display_order(df: DataFrame, model: str) -> DataFrame:
    """A model in the order in which it is shown. Its stored files hold each month in that order."""
    order = display_order_of(model) if model != "stg_rates" else []
    return df.orderBy(*order) if order else df


def model_tests(params: Params) -> dict[str, list]:
    """Declared tests per model: 31 not null, 5 unique combinations, 1 unique, 2 ranges, 1 expression."""
    wide = [wide_name(c) for c in params.listed]
    day_series = Unique(("rate_date", "currency"))

    def filled(*columns: str) -> list[NotNull]:
        return [NotNull(c) for c in columns]

    positive = " AND ".join(f"{wide_name(b)} > 0" for b in params.bases)
    return {
        "stg_rates": [
            day_series,
            *filled("rate_date", "currency", "rate"),
            AcceptedRange("rate", low=0, inclusive=False),
        ],
        "stg_rates_wide": [
            Unique(("rate_date",), combination=False), *filled("rate_date", *wide), ExpressionIsTrue(positive),
        ],
        "mart_daily": [
            Unique(("rate_date", "base_currency")), *filled("rate_date", "base_currency", *wide),
        ],
        "mart_pct_change": [
            day_series,
            *filled("rate_date", "currency", "rate"),
            AcceptedRange("pct_change", low=-2, high=2, inclusive=False),
        ],
        "mart_quality_daily": [
            Unique(("rate_date",)),
            *filled("rate_date", "data_expected", "row_count", "currency_count", "expected_currency_count"),
        ],
        "mart_rolling_stats": [day_series, *filled("rate_date", "currency", "rate")],
    }
