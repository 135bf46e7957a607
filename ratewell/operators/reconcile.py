"""Comparisons between tables: missing codes, late data, baselines and jumps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.calendars import days_before, in_window, to_date
from ratewell.functions.numeric import difference, jump, numeric
from ratewell.functions.ordering import previous_day

def missing_by_day(
    stage: DataFrame, required: Sequence[str], days: Sequence[str] = ("rate_date",)
) -> DataFrame:
    """Day columns and the sorted array of required codes the day lacks, empty for a complete day. One shuffle
    of partial sets; a set holds required codes only, so it never outgrows the list, however large the day."""
    codes = sorted(set(required))
    wanted = F.array(*[F.lit(c) for c in codes]).cast("array<string>")
    present = F.collect_set(F.when(F.col("currency").isin(codes), F.col("currency")))
    return stage.groupBy(*days).agg(F.array_except(wanted, present).alias("missing"))


def missing_required(
    stage: DataFrame, required: Sequence[str], days: Sequence[str] = ("rate_date",)
) -> DataFrame:
    """(day columns, missing_currency) for every day of the frame at once; `days` may add hash_id."""
    return missing_by_day(stage, required, days).select(
        *days, F.explode("missing").alias("missing_currency")
    )


def classify_diff(stage_rate: Column, core_rate: Column, eps=0) -> Column:
    """late_insert, core_extra, late_update (above eps), else NULL."""
    return (
        F.when(stage_rate.isNotNull() & core_rate.isNull(), "late_insert")
        .when(stage_rate.isNull() & core_rate.isNotNull(), "core_extra")
        .when(F.abs(difference(stage_rate, core_rate)) > numeric(F.lit(str(eps))), "late_update")
    )


def late_diff(
    stage: DataFrame,
    core: DataFrame,
    check_date: date | str,
    lookback_days: int = 7,
    eps=0,
    hash_id: str | None = None,
    key: str = "currency",
    detected_at: Column | None = None,
) -> DataFrame:
    """Full reconciliation of the days check_date - lookback_days .. check_date, both included. Both sides are
    cut to the window, and the stage to one snapshot, before the join; (rate_date, key) is unique on each
    side, so the two-key hash spreads evenly whatever share of rows one key has."""
    check_day, lookback = to_date(check_date), days_before(check_date, lookback_days)
    if hash_id is not None:
        stage = stage.where(F.col("hash_id") == hash_id)

    def side(df: DataFrame, name: str) -> DataFrame:
        return in_window(df, lookback, check_day).select(
            "rate_date", key, F.col("hash_id").alias(f"{name}_hash_id"), F.col("rate").alias(f"{name}_rate")
        )

    return (
        side(stage, "stage")
        .join(side(core, "core"), ["rate_date", key], "full")
        .select(
            F.lit(check_day).alias("check_date"),
            F.lit(lookback).alias("lookback_date"),
            "rate_date",
            key,
            "stage_hash_id",
            "core_hash_id",
            "stage_rate",
            "core_rate",
            classify_diff(F.col("stage_rate"), F.col("core_rate"), eps).alias("diff_type"),
            (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
        )
        .where(F.col("diff_type").isNotNull())
    )


def with_baseline(meta: DataFrame) -> DataFrame:
    """Each meta row with the row of the latest earlier day, as base_* columns; NULL on the first day. Only
    dates take part in the ordering; the pair arrays meet in an equi join on the baseline day."""
    base = meta.select(
        F.col("rate_date").alias("baseline_date"),
        F.lit(True).alias("base_found"),
        F.col("row_count").alias("base_row_count"),
        F.col("currency_count").alias("base_currency_count"),
        F.col("rates").alias("base_rates"),
    )
    return meta.join(previous_day(meta), "rate_date", "left").join(base, "baseline_date", "left")


def latest_day_before(meta: DataFrame, day: date | str) -> date | None:
    """The latest day of meta before `day`. A table partitioned by rate_month is walked backwards, one month first, then four
    times as many at each step, with literal months, so that only those partitions are read."""
    day = to_date(day)
    earlier = meta.where(F.col("rate_date") < F.lit(day))
    if "rate_month" not in meta.columns:
        return earlier.agg(F.max("rate_date")).first()[0]
    high, months = day.year * 12 + day.month - 1, 1  # months since the year 0
    while high >= 12:  # dates begin with the year 1
        low = max(high - months + 1, 12)
        some = earlier.where(F.col("rate_month").between(_month(low), _month(high)))
        if found := some.agg(F.max("rate_date")).first()[0]:
            return found
        high, months = low - 1, months * 4
    return None


def _month(number: int) -> Column:
    """First day of a month as a literal; written as text, since years before 1000 are lost on the way as dates."""
    return F.lit(date(number // 12, number % 12 + 1, 1).isoformat()).cast("date")


def meta_around(meta: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """The part of meta that decides about the days first .. last: these days and the baseline of the first. On a table
    partitioned by rate_month the bounds are literals, which prune it."""
    first, last = to_date(first), to_date(last)
    start = latest_day_before(meta, first) or first
    part = meta.where(F.col("rate_date").between(F.lit(start), F.lit(last)))
    if "rate_month" in meta.columns:
        part = part.where(F.col("rate_month").between(F.lit(start.replace(day=1)), F.lit(last.replace(day=1))))
    return part


def _rate_of(pairs: Column, code: Column) -> Column:
    """Rate of a code in a pair array, the last one if listed twice, NULL if absent."""
    return F.try_element_at(F.filter(pairs, lambda pair: pair["currency"] == code), F.lit(-1))["rate"]


def rate_map(pairs: Column) -> Column:
    """Map from code to rate of a pair array; of a code listed twice the last rate counts."""
    # Sorted by code and place, a code's last pair is the one before another code: one sort instead of a search per code.
    placed = F.sort_array(F.transform(pairs, lambda pair, i: F.struct(pair["currency"].alias("currency"), i.alias("i"), pair["rate"].alias("rate"))))
    last = F.get(F.transform(F.array(placed), lambda s: F.filter(s, lambda pair, i: ~pair["currency"].eqNullSafe(F.get(s, i + 1)["currency"]) & pair["currency"].isNotNull())), 0)
    return F.map_from_entries(F.transform(last, lambda pair: F.struct(pair["currency"], pair["rate"])))


def required_jumps(rates: Column, base_rates: Column, required: Column) -> Column:
    """Array of (currency, base_rate, new_rate, jump) for the required codes on both sides with a base that is
    not zero, ordered by code."""
    matched = F.transform(
        F.array_sort(F.array_distinct(required)),
        lambda code: F.struct(
            code.alias("currency"),
            _rate_of(base_rates, code).alias("base_rate"),
            _rate_of(rates, code).alias("new_rate"),
        ),
    )
    compared = F.transform(
        matched, lambda m: m.withField("jump", jump(m["new_rate"], m["base_rate"]))
    )
    return F.filter(compared, lambda m: m["jump"].isNotNull())


def rate_jumps(meta_with_base: DataFrame) -> DataFrame:
    """One row per day and required code with its relative jump against the baseline day."""
    jumps = required_jumps(F.col("rates"), F.col("base_rates"), F.col("required_curr"))
    return meta_with_base.select("rate_date", "baseline_date", F.explode(jumps).alias("_j")).select(
        "rate_date", "baseline_date", "_j.currency", "_j.base_rate", "_j.new_rate", "_j.jump"
    )
