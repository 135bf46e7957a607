"""Stored models by month, in order, and their refresh by the days that were loaded since.

A change of a day reaches the rows of its own day, the next row of each series (change) and the 29 rows after it (rolling
statistics). A refresh computes these rows from the stored staging table with as many rows before them as the longest window
needs, and writes the months they lie in; readers and refreshes prune by month. A day that is replaced by nothing keeps its
rows, as in core."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace as changed
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.calendars import in_window, month_start, to_date
from ratewell.operators.gates import data_tests, enforce
from ratewell.operators.reconcile import latest_day_before
from ratewell.operators.windows import pct_change, rolling_stats
from ratewell.params import Params
from ratewell.plans.marts import display_order_of, mart_daily, model_tests, quality_daily, stg_rates, stg_rates_wide
from ratewell.sources.sinks import materialize, replace_table
from ratewell.sources.tables import Tables
from ratewell.sources.versions import current, names_in, replace

CORE, META, STATE = "core_daily", "core_meta", "marts_state"
STORED = ("stg_rates", "mart_daily", "mart_pct_change", "mart_quality_daily", "mart_rolling_stats")
#: Rows of the longest rolling window.
REACH = 30


def write_model(df: DataFrame, name: str, folder: str) -> None:
    """The months of df, each in the model's order; other months in the folder stay."""
    monthly = df.withColumn("rate_month", month_start(F.col("rate_date"))).hint("rebalance", "rate_month")
    ordered = monthly.sortWithinPartitions("rate_month", *display_order_of(name))
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("rate_month").parquet(folder)


def build_marts(tables: Tables, params: Params, as_of: date | str | None = None) -> dict[str, DataFrame]:
    """Build the staging and mart models from all of core, each read by the next from its table, and run the declared tests
    of a layer before the next layer is built."""
    tests = model_tests(params)

    def stored(df: DataFrame, name: str) -> DataFrame:
        def write(folder: str) -> None:
            write_model(df, name, folder)
            if not any(part.startswith("rate_month=") for part in names_in(tables.spark, folder)):
                # A model without rows has no months; one empty file keeps its columns.
                df.withColumn("rate_month", month_start(F.col("rate_date"))).limit(0).write.mode("append").parquet(folder)

        replace(tables.spark, tables.path(name), write)
        return tables.source(name)

    stg = stored(stg_rates(tables.source(CORE), params), "stg_rates")
    wide = materialize(stg_rates_wide(stg, params), "stg_rates_wide", "view")
    staging = {"stg_rates": stg, "stg_rates_wide": wide}
    enforce(data_tests(staging, tests))
    changes = stored(pct_change(stg), "mart_pct_change")
    marts = {
        "mart_daily": stored(mart_daily(wide, params), "mart_daily"),
        "mart_pct_change": changes,
        "mart_quality_daily": stored(quality_daily(stg, changes, params, as_of), "mart_quality_daily"),
        "mart_rolling_stats": stored(rolling_stats(stg), "mart_rolling_stats"),
    }
    enforce(data_tests(marts, tests))
    return {**staging, **marts}


def last_reached(stg: DataFrame, day: date, rows: int, series: DataFrame) -> date:
    """The latest day among the first `rows` rows after `day` of each of the series, or `day`."""
    later = stg.join(series, "currency", "left_semi").where((F.col("rate_month") >= F.lit(day.replace(day=1))) & (F.col("rate_date") > F.lit(day)))
    place = F.row_number().over(Window.partitionBy("currency").orderBy("rate_date"))
    return _one(later.withColumn("_n", place).where(F.col("_n") <= rows), F.max("rate_date")) or day


def context_start(stg: DataFrame, first: date, last: date, rows: int) -> date:
    """The earliest day among the last `rows` rows before `first` of each series that has rows from `first` to `last`, or
    `first`. Months are read backwards until there are enough."""
    wanted, months = in_window(stg, first, last).select("currency").distinct(), 2
    while True:
        begin = first.replace(day=1)
        for _ in range(months):
            begin = (begin - timedelta(days=1)).replace(day=1) if begin > date(1, 1, 1) else begin
        before = in_window(stg, begin, first).where(F.col("rate_date") < F.lit(first))
        counts = wanted.join(before.groupBy("currency").agg(F.count(F.lit(1)).alias("_n")), "currency", "left")
        if counts.where(F.coalesce("_n", F.lit(0)) < rows).isEmpty() or latest_day_before(stg, begin) is None:
            break
        months *= 4
    place = F.row_number().over(Window.partitionBy("currency").orderBy(F.col("rate_date").desc()))
    near = before.join(wanted, "currency", "left_semi").withColumn("_n", place).where(F.col("_n") <= rows)
    return _one(near, F.min("rate_date")) or first


def _one(df: DataFrame, value: Column):
    return df.agg(value).first()[0]


def replace_range(tables: Tables, name: str, df: DataFrame, first: date, last: date) -> DataFrame:
    """Put the rows of df in the place of the model's rows from `first` to `last`; only their months are read and written."""
    stored = tables.source(name)
    kept = in_window(stored, first.replace(day=1), last).unionByName(_rest_of_month(stored, last))
    kept = kept.where(~F.col("rate_date").between(F.lit(first), F.lit(last))).drop("rate_month")
    write_model(df.select(*kept.columns).unionByName(kept), name, current(tables.spark, tables.path(name)))
    return tables.source(name)


def _rest_of_month(stored: DataFrame, last: date) -> DataFrame:
    return stored.where((F.col("rate_month") == F.lit(last.replace(day=1))) & (F.col("rate_date") > F.lit(last)))


def refresh_marts(tables: Tables, params: Params, as_of: date | str | None = None) -> dict[str, DataFrame]:
    """Bring the stored models up to the loaded days: those that meta lists since the last time, or all if
    there was none or a model has no rows yet.
    The declared tests see the months that were written."""
    loaded = _one(tables.source(META), F.max("inserted_at"))
    state = tables.find(STATE)
    if state is None or any((found := tables.find(name)) is None or found.isEmpty() for name in STORED):
        models = build_marts(tables, params, as_of)
    else:
        since = state.first()["loaded"]
        days = [r[0] for r in tables.source(META).where(F.col("inserted_at") > F.lit(since)).select("rate_date").distinct().orderBy("rate_date").collect()]
        models = _refreshed(tables, params, days, to_date(as_of) if as_of else date.today() - timedelta(days=1))
    replace_table(tables.spark.createDataFrame([(loaded,)], "loaded timestamp"), tables.path(STATE))
    return models


def _refreshed(tables: Tables, params: Params, days: list[date], as_of: date) -> dict[str, DataFrame]:
    tests = model_tests(params)
    ends = _one(tables.source("mart_quality_daily"), F.max("rate_date"))
    # The calendar goes on to as_of, with or without new days.
    spans = [(ends + timedelta(days=1), as_of)] if ends and ends < as_of else []
    if days:
        first, last = days[0], days[-1]
        core = in_window(tables.source(CORE), first, last)
        new, old = stg_rates(core, params), tables.source("stg_rates")
        # Series that have rows in the days now or had some before.
        series = new.select("currency").union(in_window(old, first, last).select("currency")).distinct()
        reached = last_reached(old, last, REACH - 1, series)
        stg = replace_range(tables, "stg_rates", new, first, last)
        part = in_window(stg, context_start(stg, first, reached, REACH), reached)
        own = F.col("rate_date").between(F.lit(first), F.lit(reached))
        wide = stg_rates_wide(in_window(stg, first, last), params)
        enforce(data_tests({"stg_rates": in_window(stg, first, last), "stg_rates_wide": wide}, tests))
        replace_range(tables, "mart_daily", mart_daily(wide, params), first, last)
        replace_range(tables, "mart_pct_change", pct_change(part).where(own), first, reached)
        replace_range(tables, "mart_rolling_stats", rolling_stats(part).where(own), first, reached)
        if first <= as_of:
            spans.append((first, min(reached, as_of)))
        written = (first, max(reached, as_of))
    elif spans:
        written = spans[0]
    else:
        written = (as_of, as_of)
    start = to_date(params.start_date)
    for first, last in spans:
        first = max(first, start)
        stg, changes = (in_window(tables.source(name), first, last) for name in ("stg_rates", "mart_pct_change"))
        quality = quality_daily(stg, changes, changed(params, start_date=str(first)), last)
        replace_range(tables, "mart_quality_daily", quality, first, last)
    marts = {name: tables.source(name) for name in STORED}
    enforce(data_tests({name: in_window(df, *written) for name, df in marts.items()}, {name: tests[name] for name in STORED}))
    return {**marts, "stg_rates_wide": materialize(stg_rates_wide(marts["stg_rates"], params), "stg_rates_wide", "view")}
