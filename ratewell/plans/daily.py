"""The batch run: land, extract, load, reshape, stage, load days, reconcile, gate, build marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.functions.calendars import expected_days, is_expected, to_date
from ratewell.operators.aggregates import day_meta
from ratewell.operators.gates import (
    GateFailed, enforce, log_gate, quality_gate, required_gate, snapshot_audit, stage_gates,
)
from ratewell.operators.reconcile import late_diff, meta_around
from ratewell.operators.reshape import clean_long, to_long
from ratewell.params import Params
from ratewell.plans.refresh import CORE, META, refresh_marts
from ratewell.sources import archives as zips
from ratewell.sources.sinks import (
    day_frame, fill_table, insert_missing, month_starts, promote, replace_days, replace_partition, replace_table,
)
from ratewell.sources.tables import Tables, contains, latest_snapshot, rows_of_key, snapshot_by_hash

RUN_TYPES = ("scheduled", "manual", "backfill")

LOG = "ingestion_log"
ARCHIVES = "archives"
CSV_OBJECTS = "csv"
RAW_LONG = "raw_long"
STAGE = "stage_long"
LATE = "late_data_diff"


def run_date(run_type: str, rate_date: date | str | None) -> date:
    """The day a run is for; every run type needs an ISO date."""
    if run_type not in RUN_TYPES:
        raise ValueError(f"unknown run type {run_type!r}")
    if not rate_date:
        raise ValueError(f"a {run_type} run needs a date YYYY-MM-DD")
    return to_date(rate_date)


# --- snapshot steps --------------------------------------------------------------------------------------

def ingest(tables: Tables, run_type: str, landing: str | DataFrame | None, params: Params) -> str:
    """hash_id of the snapshot to work on. A run that is not scheduled takes the newest logged snapshot; else
    the newest landed archive is stored and logged, once per content. `landing` is a folder, or a frame with the columns of
    the binaryFile source. What landed is read here only: later steps and runs read the stored archive."""
    log_path = tables.path(LOG)
    if run_type != "scheduled":
        log = tables.find(LOG)
        newest = None if log is None else latest_snapshot(log, ["gcs_zip_uri", "zip_size"]).first()
        if newest and newest["gcs_zip_uri"] and newest["zip_size"]:
            _audit_archive(tables, newest["hash_id"])
            return newest["hash_id"]
    if landing is None:
        raise ValueError("no logged snapshot: a landing folder is needed")
    files = zips.newest_file(tables.spark, landing)
    if files is None:
        raise ValueError(f"no archive in {landing}")
    bad = zips.refused(files, params.max_archive_bytes).first()
    if bad:
        raise ValueError(f"{bad['path']}: {bad['error']}")
    archive = zips.identify(files, params.max_archive_bytes)
    _raise_rejected(zips.extract_members(archive))
    hash_id = archive.select("hash_id").first()["hash_id"]
    zips.store_archives(archive, tables.path(ARCHIVES))
    kept = _archive_of(tables, hash_id)
    insert_missing(zips.log_rows(kept), log_path)
    wanted = kept.select("hash_id", F.col("path").alias("gcs_zip_uri"), F.col("size").alias("zip_size"))
    enforce(log_gate(wanted, _logged(tables, hash_id), ["gcs_zip_uri", "zip_size"], ["gcs_zip_uri", "zip_size"]))
    _audit_archive(tables, hash_id)
    return hash_id


def _logged(tables: Tables, hash_id: str) -> DataFrame:
    """The log row of a snapshot, from the part of the log that can hold it."""
    rows = rows_of_key(tables.spark, tables.path(LOG), hash_id)
    if rows is None:
        raise FileNotFoundError(f"no table {tables.path(LOG)}")
    return rows


def _archive_of(tables: Tables, hash_id: str) -> DataFrame:
    return zips.stored_archive(tables.spark, tables.path(ARCHIVES), hash_id)


def _audit_archive(tables: Tables, hash_id: str) -> None:
    logged = snapshot_by_hash(_logged(tables, hash_id), hash_id, ["gcs_zip_uri", "zip_size"])
    enforce(snapshot_audit(logged, _archive_of(tables, hash_id)))


def _raise_rejected(members: DataFrame) -> None:
    bad = zips.rejected(members).first()
    if bad:
        raise ValueError(f"{bad['hash_id']}: {bad['error']}")


def extract(tables: Tables, hash_id: str) -> None:
    """Store the CSV of a logged archive and fill the log's extraction fields where they are NULL."""
    wanted = tables.spark.range(1, numPartitions=1).select(F.lit(hash_id).alias("hash_id"))
    enforce(log_gate(wanted, _logged(tables, hash_id), ["gcs_zip_uri", "zip_size"]))
    _audit_archive(tables, hash_id)
    root = tables.path(CSV_OBJECTS)
    logged = snapshot_by_hash(_logged(tables, hash_id), hash_id, ["gcs_csv_uri", "csv_size"])
    if logged.first()["gcs_csv_uri"] is None:
        members = zips.extract_members(_archive_of(tables, hash_id))
        _raise_rejected(members)
        zips.write_members(members, root)
        stored = zips.stored_members(tables.spark, f"{root}/hash_id={hash_id}").select(
            "hash_id",
            F.col("path").alias("gcs_csv_uri"),
            F.col("size").alias("csv_size"),
            F.current_timestamp().alias("unpacked_at"),
        )
        fill_table(stored, tables.path(LOG))
    enforce(log_gate(wanted, _logged(tables, hash_id), ["gcs_csv_uri", "csv_size"]))
    logged = snapshot_by_hash(_logged(tables, hash_id), hash_id, ["gcs_csv_uri", "csv_size"])
    objects = zips.stored_members(tables.spark, f"{root}/hash_id={hash_id}").drop("hash_id")
    enforce(snapshot_audit(logged, objects, "gcs_csv_uri", "csv_size"))


def load_snapshot(tables: Tables, hash_id: str) -> DataFrame:
    """The wide raw table of a snapshot, loaded once."""
    name = f"raw_snapshots/{hash_id}"
    stored = tables.find(name)
    if stored is None or stored.isEmpty():
        member = zips.extract_members(_archive_of(tables, hash_id)).drop("csv_text").first()
        wide = zips.load_csv(
            tables.spark, tables.path(CSV_OBJECTS), [hash_id], list(member["columns"]), member["delimiter"]
        )
        replace_table(wide.drop("hash_id"), tables.path(name))
        stored = tables.source(name)
        _need_rows(stored, name)
    return stored


def _need_rows(df: DataFrame | None, name: str) -> None:
    if df is None or df.isEmpty():
        raise RuntimeError(f"{name} is missing or empty")


def _holds(df: DataFrame | None, hash_id: str) -> bool:
    return df is not None and contains(df, hash_id)


def build_raw_long(tables: Tables, hash_id: str) -> None:
    if _holds(tables.find(RAW_LONG), hash_id):
        return
    wide = load_snapshot(tables, hash_id)
    replace_table(to_long(wide, hash_id), tables.path(RAW_LONG))
    if not _holds(tables.find(RAW_LONG), hash_id):
        raise RuntimeError(f"{RAW_LONG} has no rows of {hash_id}")


def build_stage(tables: Tables, hash_id: str) -> None:
    if _holds(tables.find(STAGE), hash_id):
        return
    raw = tables.find(RAW_LONG)
    if not _holds(raw, hash_id):
        raise RuntimeError(f"{RAW_LONG} has no rows of {hash_id}")
    promote(clean_long(raw, hash_id), lambda written: stage_gates(written, hash_id), tables.path(STAGE))


# --- day steps -------------------------------------------------------------------------------------------

def load_days(
    stage: DataFrame,
    core_path: str,
    meta_path: str,
    params: Params,
    run_type: str,
    days: Sequence[date | str] | None = None,
    strict: bool = True,
    loaded_at: Column | None = None,
) -> None:
    """Replace the given days, or all days of the stage, in core and meta, in one job per table. A day without
    stage rows is left as it is. A day that lacks a required code stops the load if strict; else that day is
    left as it is and the others are loaded. Core is written before meta: the meta row marks a loaded day, and
    both writes replace whole days, so a run after a failure ends in the same state."""
    if days is not None:
        stage = stage.where(F.col("rate_date").isin([to_date(d) for d in days]))
    gate = required_gate(stage, params.required)
    decided = gate.select("rate_date", "status").collect()  # one row per calendar day
    complete = [row["rate_date"] for row in decided if row["status"] == "PASS"]
    if len(complete) < len(decided):
        if strict:
            enforce(gate)
        stage = stage.join(day_frame(stage.sparkSession, complete), "rate_date", "left_semi")
        if "rate_month" in stage.columns:
            stage = stage.where(F.col("rate_month").isin(month_starts(complete)))
    at = F.current_timestamp() if loaded_at is None else loaded_at
    core = stage.select("rate_date", "currency", "rate", "hash_id", at.alias("loaded_at"))
    replace_days(core, core_path, grain=params.core_grain, order=["currency"], days=complete)
    # One row per day: meta is always kept by month.
    replace_days(day_meta(stage, params.required, run_type, at), meta_path, grain="month", days=complete)


def detect_late(tables: Tables, hash_id: str, day: date, params: Params) -> None:
    """Replace the logged differences of this check date, also by none."""
    diff = late_diff(
        tables.source(STAGE), tables.source(CORE), day, params.lookback_days, params.eps, hash_id
    )
    replace_partition(diff, tables.path(LATE), "check_date", day)


def run(
    spark: SparkSession,
    root: str,
    run_type: str,
    rate_date: date | str | None,
    landing: str | DataFrame | None = None,
    params: Params | None = None,
    as_of: date | str | None = None,
) -> str:
    """One batch run for one day; returns the hash_id of its snapshot. Differences are logged on scheduled runs
    only, marts are not built on backfill."""
    params = params or Params()
    day = run_date(run_type, rate_date)
    tables = Tables(spark, root)
    hash_id = ingest(tables, run_type, landing, params)
    extract(tables, hash_id)
    build_raw_long(tables, hash_id)
    build_stage(tables, hash_id)
    stage = tables.source(STAGE).where(F.col("hash_id") == hash_id)
    load_days(stage, tables.path(CORE), tables.path(META), params, run_type, [day])
    if run_type == "scheduled" and params.late_enabled and tables.find(CORE) is not None:
        detect_late(tables, hash_id, day, params)
    meta = tables.find(META)
    checked = expected_days(spark, day, day, params.holidays)
    if meta is None:
        if not checked.where("expected").isEmpty():
            raise GateFailed(f"no meta row for {day}")
    else:
        enforce(quality_gate(meta_around(meta, day, day), checked, params, hash_id))
    if run_type != "backfill" and meta is not None and tables.find(CORE) is not None:
        refresh_marts(tables, params, as_of)
    return hash_id


def backfill(
    spark: SparkSession, root: str, days: Sequence[date | str], params: Params | None = None
) -> str:
    """Load any set of days of the newest logged snapshot in one job and gate all of them: a day without data is left
    as it is, and a working day among them fails. Models are not built."""
    params = params or Params()
    tables = Tables(spark, root)
    hash_id = ingest(tables, "backfill", None, params)
    extract(tables, hash_id)
    build_raw_long(tables, hash_id)
    build_stage(tables, hash_id)
    stage = tables.source(STAGE).where(F.col("hash_id") == hash_id)
    load_days(stage, tables.path(CORE), tables.path(META), params, "backfill", days)
    asked = sorted({to_date(d) for d in days})
    wanted = spark.createDataFrame([(d,) for d in asked], "rate_date date")
    checked = wanted.withColumn("expected", is_expected(F.col("rate_date"), params.holidays))
    meta = tables.find(META)
    if meta is not None and asked:
        enforce(quality_gate(meta_around(meta, asked[0], asked[-1]), checked, params, hash_id))
    elif not checked.where("expected").isEmpty():
        raise GateFailed(f"no meta row for any of {len(asked)} days")
    return hash_id
