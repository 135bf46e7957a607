"""Day-level and key-level aggregates; each combines map-side before its one shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.numeric import numeric
from ratewell.functions.calendars import to_date


def day_meta(
    stage: DataFrame, required: Sequence[str], run_type: str, inserted_at: Column | None = None
) -> DataFrame:
    """One row per day and snapshot: counts and the ordered (currency, rate) pairs. The stage gates leave at
    most one row per day and three-letter code, so a pair array never holds more than 26^3 entries."""
    pairs = stage.groupBy("rate_date", "hash_id").agg(
        F.sort_array(F.collect_list(F.struct("currency", numeric(F.col("rate")).alias("rate")))).alias("rates")
    )
    return pairs.select(
        "rate_date",
        F.lit(run_type).alias("run_type"),
        "hash_id",
        F.size("rates").cast("long").alias("row_count"),
        F.size(F.array_distinct(F.transform("rates", lambda pair: pair["currency"]))).cast("long").alias(
            "currency_count"
        ),
        "rates",
        F.array(*[F.lit(c) for c in required]).cast("array<string>").alias("required_curr"),
        (F.current_timestamp() if inserted_at is None else inserted_at).alias("inserted_at"),
    )


def _sizes() -> list[Column]:
    return [F.count(F.lit(1)).alias("row_count"), F.count_distinct("currency").alias("currency_count")]


def _changes() -> list[Column]:
    size = F.abs("pct_change")
    return [numeric(F.avg(size)).alias("avg_abs_pct_change"), F.max(size).alias("max_abs_pct_change")]


def day_stats(stg: DataFrame) -> DataFrame:
    return stg.groupBy("rate_date").agg(*_sizes())


def change_stats(changes: DataFrame) -> DataFrame:
    return changes.groupBy("rate_date").agg(*_changes())


def day_and_change_stats(changed: DataFrame) -> DataFrame:
    """Both in one pass over rows that carry their change; a NULL change counts as a row only."""
    return changed.groupBy("rate_date").agg(*_sizes(), *_changes())


def baseline_date(meta: DataFrame, day: date | str) -> DataFrame:
    """The latest day of the meta table strictly before `day`, as one row; NULL if there is none."""
    return meta.where(F.col("rate_date") < F.lit(to_date(day))).agg(F.max("rate_date").alias("baseline_date"))


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("rate_date", "currency")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def diff_summary(diff: DataFrame, check_date: date | str | None = None) -> DataFrame:
    if check_date is not None:
        diff = diff.where(F.col("check_date") == F.lit(to_date(check_date)))
    return diff.groupBy("diff_type").agg(F.count(F.lit(1)).alias("cnt")).orderBy("diff_type")
