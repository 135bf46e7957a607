from dataclasses import replace
from decimal import Decimal

import pytest

from ratewell.operators.gates import GateFailed
from ratewell.params import Params
from ratewell.plans import daily
from ratewell.plans.views import zip_bytes
from ratewell.sources.tables import Tables
from tests.helpers import D, tuples

# One of seven series may be missing.
PARAMS = Params(holidays=(), series_drift=0.15)
CODES = ("USD", "GBP", "JPY", "CHF", "CAD", "AUD")


def archive(folder, name, days):
    """An archive with one row per day: {day: {code: rate}} over rates of 1."""
    rows = "".join(
        ",".join([d, *[str(changes.get(c, "1.0")) for c in (*CODES, "SEK")]]) + ",\n" for d, changes in days.items()
    )
    (folder / name).write_bytes(zip_bytes("rates.csv", "Date," + ",".join((*CODES, "SEK")) + ",\n" + rows))


def test_arguments():
    with pytest.raises(ValueError, match="unknown run type"):
        daily.run_date("nightly", "2026-01-05")
    with pytest.raises(ValueError, match="needs a date"):
        daily.run_date("manual", None)
    with pytest.raises(ValueError):
        daily.run_date("manual", "05.01.2026")
    assert daily.run_date("backfill", "2026-01-05") == D("2026-01-05")


def test_runs(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    root = str(tmp_path / "store")
    tables = Tables(spark, root)
    run = lambda kind, day, params=PARAMS: daily.run(spark, root, kind, day, str(landing), params, as_of="2026-01-10")

    archive(landing, "a.zip", {"2026-01-05": {}, "2026-01-06": {"USD": "1.01"}, "2026-01-07": {"SEK": "N/A"}})
    # Nothing is logged yet, so this run takes the landed archive as well.
    first = run("backfill", "2026-01-05")
    assert tuples(tables.source("core_daily"), "rate_date", "currency")[0] == (D("2026-01-05"), "AUD")
    assert tables.source("core_daily").count() == 7
    log = tables.source("ingestion_log").first()
    assert log["hash_id"] == first and log["csv_size"] > 0 and "hash_id=" in log["gcs_csv_uri"]
    # Neither differences nor models on a backfill.
    assert tables.find("late_data_diff") is None and tables.find("stg_rates") is None

    # Any set of days in one job; a day without rows is left out.
    assert daily.backfill(spark, root, ["2026-01-06", "2026-01-07", "2026-02-01"], PARAMS) == first
    assert tables.source("core_daily").count() == 20
    # On a working day without rows the gate misses the meta row.
    with pytest.raises(GateFailed, match="meta_missing"):
        run("backfill", "2026-01-08")
    assert tables.source("core_daily").count() == 20

    # A run that is not scheduled stays on the logged snapshot, whatever has landed since.
    archive(landing, "b.zip", {"2026-01-05": {"USD": "1.02"}, "2026-01-06": {"USD": "1.01"}, "2026-01-07": {}})
    assert run("backfill", "2026-01-07") == first
    second = run("scheduled", "2026-01-07")
    assert second != first and tables.source("ingestion_log").count() == 2
    assert tables.source("mart_pct_change").where("currency = 'USD' and rate_date = '2026-01-06'").first()["pct_change"] == Decimal("0.01")
    assert tables.source("mart_quality_daily").count() == 10
    assert tables.source("mart_daily").count() == 9
    late = lambda: tables.source("late_data_diff").where("check_date = '2026-01-07'")
    assert tuples(late(), "rate_date", "currency", "stage_rate", "core_rate", "diff_type") == [
        (D("2026-01-05"), "USD", Decimal("1.02"), Decimal("1.0"), "late_update")
    ]
    # The correction reaches core when its day is loaded again, and then the logged diff of that day is cleared.
    stage = tables.source("stage_long")
    daily.load_days(stage, tables.path("core_daily"), tables.path("core_meta"), PARAMS, "manual", ["2026-01-05"])
    daily.detect_late(tables, second, D("2026-01-07"), PARAMS)
    assert late().count() == 0


def test_failures_leave_core_alone(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    root = str(tmp_path / "store")
    archive(landing, "a.zip", {"2026-01-05": {}, "2026-01-06": {"USD": "1.2"}, "2026-01-07": {"JPY": "N/A"}})
    daily.run(spark, root, "backfill", "2026-01-05", str(landing), PARAMS)
    tables = Tables(spark, root)
    with pytest.raises(GateFailed, match="JPY"):
        daily.run(spark, root, "backfill", "2026-01-07", str(landing), PARAMS)
    assert tables.source("core_daily").count() == 7
    with pytest.raises(GateFailed, match="rate_jump"):
        daily.run(spark, root, "backfill", "2026-01-06", str(landing), PARAMS)
    # The day is loaded before it is gated.
    assert tables.source("core_daily").count() == 14
    loose = replace(PARAMS, rate_jump=0.5)
    daily.run(spark, root, "backfill", "2026-01-06", str(landing), loose)
    # Without strictness the complete days are loaded and the others left as they are.
    daily.load_days(
        tables.source("stage_long"), tables.path("core_daily"), tables.path("core_meta"), PARAMS, "backfill", strict=False
    )
    assert [r[0].day for r in tuples(tables.source("core_meta"), "rate_date")] == [5, 6]


def test_landing_problems(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    with pytest.raises(ValueError, match="no archive"):
        daily.run(spark, str(tmp_path / "s"), "scheduled", "2026-01-05", str(landing), PARAMS)
    with pytest.raises(ValueError, match="landing folder"):
        daily.run(spark, str(tmp_path / "s"), "manual", "2026-01-05", None, PARAMS)
    (landing / "a.zip").write_bytes(b"not a zip")
    with pytest.raises(ValueError, match="BadZipFile"):
        daily.run(spark, str(tmp_path / "s"), "scheduled", "2026-01-05", str(landing), PARAMS)
    archive(landing, "a.zip", {"2026-01-05": {}})
    with pytest.raises(ValueError, match="too large"):
        daily.run(spark, str(tmp_path / "s"), "scheduled", "2026-01-05", str(landing), replace(PARAMS, max_archive_bytes=5))
