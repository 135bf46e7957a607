"""Stored models: refreshed by the loaded days they equal a full rebuild, untouched months keep their files."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratewell.params import Params
from ratewell.plans import refresh
from ratewell.plans.daily import load_days
from ratewell.plans.marts import display_order_of, mart_daily, quality_daily, stg_rates, stg_rates_wide
from ratewell.operators.windows import pct_change, rolling_stats
from ratewell.sources.tables import Tables
from ratewell.sources.versions import current
from tests.helpers import stage

CODES = ("USD", "GBP", "JPY", "CHF", "CAD", "AUD")
AS_OF = "2021-12-31"


def whole(tables, params, as_of):
    stg = stg_rates(tables.source("core_daily"), params)
    return {
        "stg_rates": stg, "mart_daily": mart_daily(stg_rates_wide(stg, params), params), "mart_pct_change": pct_change(stg),
        "mart_quality_daily": quality_daily(stg, None, params, as_of), "mart_rolling_stats": rolling_stats(stg),
    }


def differences(tables, params, as_of):
    out = {}
    for name, df in whole(tables, params, as_of).items():
        columns = [c for c in df.columns if c != "rate_month"]
        ours, theirs = tables.source(name).select(*columns), df.select(*columns)
        out[name] = (ours.exceptAll(theirs).count(), theirs.exceptAll(ours).count())
    return out


def months_of(tables, name):
    from pathlib import Path

    return {p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("part-*")) for p in Path(current(tables.spark, tables.path(name))).glob("rate_month=*")}


@pytest.fixture
def loaded(spark, tmp_path, monkeypatch):
    """Three years of working days; AUD begins late, CAD pauses for a year, so the declared tests would not pass."""
    monkeypatch.setattr(refresh, "enforce", lambda results: None)
    random.seed(4)
    rows, day = [], date(2019, 1, 1)
    while day <= date(2021, 11, 30):
        if day.weekday() < 5:
            rows += [(str(day), c, f"{random.randint(500, 999)}.{random.randint(0, 99):02d}") for c in CODES
                     if not (c == "AUD" and day < date(2021, 5, 3)) and not (c == "CAD" and day.year == 2020)]
        day += timedelta(days=1)
    tables = Tables(spark, str(tmp_path / "store"))
    params = Params(start_date="2019-01-01", holidays=(), required=CODES, core_grain="month")

    def load(rows):
        load_days(stage(spark, rows), tables.path("core_daily"), tables.path("core_meta"), params_for(rows), "manual")

    def params_for(rows):
        from dataclasses import replace
        from collections import defaultdict

        by_day = defaultdict(set)
        for r in rows:
            by_day[r[0]].add(r[1])
        return replace(params, required=tuple(sorted(set.intersection(*by_day.values()))))

    load(rows)
    refresh.refresh_marts(tables, params, "2021-11-30")
    return tables, params, load, rows


def test_a_refresh_equals_a_rebuild(loaded):
    tables, params, load, rows = loaded
    assert set(differences(tables, params, "2021-11-30").values()) == {(0, 0)}
    before = {name: months_of(tables, name) for name in refresh.STORED}

    # A new day at the end, and a calendar that goes on.
    load([("2021-12-01", c, 700 + k) for k, c in enumerate(CODES)])
    refresh.refresh_marts(tables, params, AS_OF)
    assert set(differences(tables, params, AS_OF).values()) == {(0, 0)}
    after = {name: months_of(tables, name) for name in refresh.STORED}
    for name in ("stg_rates", "mart_daily", "mart_pct_change", "mart_rolling_stats"):
        assert {m for m in after[name] if after[name][m] != before[name].get(m)} == {"rate_month=2021-12-01"}, name

    # Days within the table: the change reaches the next rows of every series, over months and over the pause of CAD.
    load([("2019-12-30", c, 800 + k) for k, c in enumerate(CODES) if c != "AUD"] + [("2020-02-03", c, 801 + k) for k, c in enumerate(CODES) if c not in ("AUD", "CAD")])
    refresh.refresh_marts(tables, params, AS_OF)
    assert set(differences(tables, params, AS_OF).values()) == {(0, 0)}
    last = {name: months_of(tables, name) for name in refresh.STORED}
    assert {m for m in last["stg_rates"] if last["stg_rates"][m] != after["stg_rates"].get(m)} == {f"rate_month={m}-01" for m in ("2019-12", "2020-01", "2020-02")}
    untouched = [m for m in after["mart_rolling_stats"] if m < "rate_month=2019-12" or m > "rate_month=2021-03"]
    assert len(untouched) > 15 and all(last["mart_rolling_stats"][m] == after["mart_rolling_stats"][m] for m in untouched)

    # Nothing new: nothing but the state is written.
    refresh.refresh_marts(tables, params, AS_OF)
    assert {name: months_of(tables, name) for name in refresh.STORED} == last


def test_context_and_reach(loaded, spark):
    tables, _, _, rows = loaded
    stg = tables.source("stg_rates")
    days = {c: sorted(date.fromisoformat(d) for d, code, _ in rows if code == c) for c in CODES}
    for first, last in ((date(2021, 5, 4), date(2021, 5, 4)), (date(2021, 1, 4), date(2021, 1, 6)), (date(2019, 1, 3), date(2019, 1, 3)), (date(2020, 7, 1), date(2020, 7, 1))):
        there = [c for c in CODES if any(first <= d <= last for d in days[c])]
        want = min((([d for d in days[c] if d < first][-30:] or [first])[0] for c in there))
        assert refresh.context_start(stg, first, last, 30) == want
        reach = max(([d for d in days[c] if d > last][:29] or [last])[-1] for c in there)
        assert refresh.last_reached(stg, last, 29, spark.createDataFrame([(c,) for c in there], "currency string")) == reach


def test_models_are_stored_by_month_in_order(loaded):
    tables, _, _, _ = loaded
    for name in refresh.STORED:
        one = tables.source(name).where(F.col("rate_month") == F.lit(date(2021, 6, 1)))
        shown = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(rate_month" in shown
        stored = [tuple(r) for r in one.drop("rate_month").collect()]
        wanted = [tuple(r) for r in one.drop("rate_month").orderBy(*display_order_of(name)).collect()]
        assert len(stored) >= 22 and stored == wanted, name
