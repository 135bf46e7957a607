"""Calendar expressions and frames."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def is_weekday(day: Column) -> Column:
    """Monday to Friday; dayofweek counts from Sunday = 1."""
    return F.dayofweek(day).between(2, 6)


def is_expected(day: Column, holidays=()) -> Column:
    """A weekday that is no holiday; holidays are ISO strings or dates."""
    expected = F.weekday(day) < 5
    if holidays:
        expected = expected & ~day.isin([to_date(h) for h in holidays])
    return expected


def to_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(str(value))


def days_before(day: date | str, n: int) -> date:
    return to_date(day) - timedelta(days=n)


def day_series(lo: Column, hi: Column) -> Column:
    """Array of the days lo..hi, both included; NULL (so no rows once exploded) where lo is after hi."""
    return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi), F.expr("interval 1 day")))


def calendar(spark: SparkSession, lo: date | str, hi: date | str | None = None) -> DataFrame:
    """One row per day from lo to hi, by default to yesterday."""
    first = F.lit(to_date(lo))
    last = F.date_sub(F.current_date(), 1) if hi is None else F.lit(to_date(hi))
    return spark.range(1, numPartitions=1).select(F.explode(day_series(first, last)).alias("rate_date"))


def expected_days(spark: SparkSession, lo: date | str, hi: date | str | None = None, holidays=()) -> DataFrame:
    return calendar(spark, lo, hi).withColumn("expected", is_expected(F.col("rate_date"), holidays))


def in_window(df: DataFrame, lo: date | str, hi: date | str, column: str = "rate_date") -> DataFrame:
    """Inclusive date range. A month-partitioned table also gets the bound on rate_month, because Spark does
    not derive partition filters from a bound on rate_date."""
    lo, hi = to_date(lo), to_date(hi)
    kept = df.where(F.col(column).between(F.lit(lo), F.lit(hi)))
    if "rate_month" in df.columns:
        kept = kept.where(F.col("rate_month").between(F.lit(lo.replace(day=1)), F.lit(hi.replace(day=1))))
    return kept
