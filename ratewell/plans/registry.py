"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.functions.calendars import calendar, day_series, expected_days, is_expected, is_weekday
from ratewell.operators.aggregates import baseline_date, day_meta, diff_summary, duplicate_keys
from ratewell.operators.gates import GateFailed, data_tests, log_gate, quality_gate, required_gate, snapshot_audit, stage_gates
from ratewell.operators.reconcile import late_diff, meta_around, missing_required, rate_jumps, rate_map, with_baseline
from ratewell.operators.reshape import clean_long, to_long
from ratewell.operators.upserts import fill_missing
from ratewell.operators.windows import pct_change, rolling_stats
from ratewell.params import Params
from ratewell.plans import views
from ratewell.plans.daily import CORE, META, backfill, load_days, run
from ratewell.plans.marts import mart_daily, model_tests, quality_daily, stg_rates, stg_rates_wide
from ratewell.plans.views import AS_OF, LINE_CODES, PARAMS, SNAPSHOT, WHOLE_HISTORY_DAYS
from ratewell.schemas import CORE_META
from ratewell.sources import archives as zips
from ratewell.sources.scratch import scratch_folder
from ratewell.sources.sinks import fill_table, insert_missing, materialize, promote, replace_days, replace_partition, replace_table, write_snapshot
from ratewell.sources.tables import Tables, contains, find_table, latest_snapshot, present_keys, scan, table_rows
from ratewell.streaming.landing import FILES, land_stream

# Wider than the default limit: the derived rates move far more from day to day than exchange rates do.
GATE_PARAMS = Params(start_date=views.START, holidays=("1996-12-25", "2000-12-25"), rate_jump=0.5)
#: The days that the backfill gate is asked for.
GATED_YEAR = ("1998-01-01", "1998-12-31")
RUN_PARAMS = Params(start_date=views.START, holidays=(), rate_jump=1e6, core_grain="month", late_enabled=True, lookback_days=3000)
LINE_PARAMS = Params(start_date=views.START, required=LINE_CODES, holidays=(), core_grain="month")


def plain(df: DataFrame) -> DataFrame:
    """Types that every SQL engine prints alike: decimals as double, integers as long, truth values as text."""

    def same(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("long")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[same(f) for f in df.schema.fields])


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_rates(views.rates(spark, sf_dir), PARAMS)


def _meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_meta(views.rates(spark, sf_dir), PARAMS.required, "scheduled")


def _stored(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """df as a written table: computed once, however often the next steps read it."""
    path = scratch_folder(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meta table is a stored table, as in a batch run: one row per day."""
    return _stored(_meta(spark, sf_dir), "core_meta")


# --- staging and marts -----------------------------------------------------------------------------------

def q_stg_rates(spark, sf_dir):
    return plain(_stg(spark, sf_dir))


def q_stg_rates_wide(spark, sf_dir):
    return plain(stg_rates_wide(_stg(spark, sf_dir), PARAMS))


def q_mart_daily(spark, sf_dir):
    return plain(mart_daily(stg_rates_wide(_stg(spark, sf_dir), PARAMS), PARAMS))


def q_pct_change(spark, sf_dir):
    return plain(pct_change(_stg(spark, sf_dir)))


def _large_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_rates(views.large_rates(spark, sf_dir), PARAMS)


def q_pct_change_large(spark, sf_dir):
    """Rates of 10^9 to 10^13."""
    return plain(pct_change(_large_stg(spark, sf_dir)))


def q_mart_daily_large(spark, sf_dir):
    return plain(mart_daily(stg_rates_wide(_large_stg(spark, sf_dir), PARAMS), PARAMS))


def q_rolling_stats(spark, sf_dir):
    return plain(rolling_stats(_stg(spark, sf_dir)))


def q_rolling_stats_blocked(spark, sf_dir):
    return plain(rolling_stats(_stg(spark, sf_dir), block_rows=256))


def q_quality_daily(spark, sf_dir):
    return plain(quality_daily(_stg(spark, sf_dir), None, PARAMS, AS_OF))


def q_rolling_by_supplier(spark, sf_dir):
    return plain(rolling_stats(views.rates_by(spark, sf_dir, "l_suppkey"), key=("series",)))


def q_pct_change_by_part(spark, sf_dir):
    return plain(pct_change(views.rates_by(spark, sf_dir, "l_partkey"), key=("series",)))


def q_pct_change_by_part_blocked(spark, sf_dir):
    return plain(pct_change(views.rates_by(spark, sf_dir, "l_partkey"), key=("series",), block_rows=256))


def q_event_rolling(spark, sf_dir):
    return plain(rolling_stats(views.event_rates(spark, sf_dir), key=("series",)))


def q_data_tests(spark, sf_dir):
    """The 40 declared tests over stored models."""
    stg = _stored(_stg(spark, sf_dir), "stg_rates")
    wide = stg_rates_wide(stg, PARAMS)
    changes = _stored(pct_change(stg), "mart_pct_change")
    models = {
        "stg_rates": stg,
        "stg_rates_wide": wide,
        "mart_daily": mart_daily(wide, PARAMS),
        "mart_pct_change": changes,
        "mart_quality_daily": quality_daily(stg, changes, PARAMS, AS_OF),
        "mart_rolling_stats": rolling_stats(stg),
    }
    return data_tests(models, model_tests(PARAMS))


# --- reshape and clean -----------------------------------------------------------------------------------

def q_unpivot_long(spark, sf_dir):
    return to_long(views.wide_text(spark, sf_dir), SNAPSHOT)


def q_clean_long(spark, sf_dir):
    return plain(clean_long(views.dirty(spark, sf_dir), SNAPSHOT))


def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(clean_long(views.dirty(spark, sf_dir), SNAPSHOT))


def q_stage_gates(spark, sf_dir):
    return stage_gates(clean_long(views.dirty(spark, sf_dir), SNAPSHOT), SNAPSHOT)


def q_stage_promote(spark, sf_dir):
    path = f"{scratch_folder(spark, 'stage')}/stage_long"
    promote(views.rates(spark, sf_dir), lambda written: stage_gates(written, SNAPSHOT), path)
    return plain(find_table(spark, path))


# --- days ------------------------------------------------------------------------------------------------

def _pairs_text(pairs: str):
    """The pair array as text, so that engines without arrays of structs can be compared."""
    return F.array_join(
        F.transform(pairs, lambda p: F.concat_ws("=", p["currency"], p["rate"].cast("decimal(18,2)").cast("string"))),
        ",",
    )


def q_day_meta(spark, sf_dir):
    return _meta(spark, sf_dir).select(
        "rate_date", "run_type", "hash_id", "row_count", "currency_count",
        _pairs_text("rates").alias("rates"), F.array_join("required_curr", ",").alias("required_curr"),
    )


def q_missing_required(spark, sf_dir):
    loaded, published = views.line_publications(spark, sf_dir)
    return missing_required(loaded.unionByName(published), LINE_CODES, ("rate_date", "hash_id"))


def q_required_gate(spark, sf_dir):
    loaded, published = views.line_publications(spark, sf_dir)
    both = loaded.unionByName(published)
    return required_gate(both, LINE_CODES, ("rate_date", "hash_id")).withColumn("missing", F.array_join("missing", ","))


def q_baseline_asof(spark, sf_dir):
    return with_baseline(_stored_meta(spark, sf_dir)).select("rate_date", "baseline_date", "row_count", "base_row_count")


def q_baseline_date(spark, sf_dir):
    """The latest meta day before the last ship day."""
    meta = _stored_meta(spark, sf_dir)
    return baseline_date(meta, meta.agg(F.max("rate_date")).first()[0])


def q_rate_lookup(spark, sf_dir):
    rates_of = rate_map(F.col("rates"))
    return plain(_meta(spark, sf_dir).select(
        "rate_date", F.map_keys(rates_of).alias("_codes"), rates_of["USD"].alias("usd"), rates_of["AUD"].alias("aud"),
    ).select("rate_date", F.size("_codes").alias("codes"), "usd", "aud"))


def q_rate_jumps(spark, sf_dir):
    return plain(rate_jumps(with_baseline(_stored_meta(spark, sf_dir))))


def q_quality_gate(spark, sf_dir):
    """Every calendar day between the first and the last ship day."""
    gated = quality_gate(
        _stored_meta(spark, sf_dir), _shipping_calendar(spark, sf_dir, GATE_PARAMS.holidays), GATE_PARAMS, SNAPSHOT
    )
    return _gate_columns(gated)


def q_backfill_gate(spark, sf_dir):
    """All calendar days of one year, as a backfill asks for them, over the months of a stored meta table that decide them."""
    path = f"{scratch_folder(spark, 'meta')}/core_meta"
    replace_days(_meta(spark, sf_dir), path, grain="month")
    days = expected_days(spark, *GATED_YEAR, GATE_PARAMS.holidays)
    return _gate_columns(quality_gate(meta_around(find_table(spark, path), *GATED_YEAR), days, GATE_PARAMS, SNAPSHOT))


def _gate_columns(gated: DataFrame) -> DataFrame:
    return gated.select(
        "rate_date", "status", "check", "baseline_date", "observed", "threshold",
        F.array_join("missing", ",").alias("missing"),
        F.array_join(F.transform("jumps", lambda j: j["currency"]), ",").alias("jumps"),
    )


def q_quality_gate_spoilt(spark, sf_dir):
    """The same days over a meta table in which some days are of another snapshot, or lack rows, series or rates."""
    on = lambda day: F.dayofmonth("rate_date") == day
    meta = _meta(spark, sf_dir)
    spoilt = meta.withColumns({
        "hash_id": F.when(on(3), "other").otherwise(F.col("hash_id")),
        "row_count": F.when(on(5), 0).otherwise(F.col("row_count")),
        "currency_count": F.when(on(9), 0).otherwise(F.col("currency_count")),
        "rates": F.when(on(13), F.array().cast(meta.schema["rates"].dataType)).otherwise(F.col("rates")),
    })
    days = _shipping_calendar(spark, sf_dir, GATE_PARAMS.holidays)
    return _gate_columns(quality_gate(_stored(spoilt, "core_meta"), days, GATE_PARAMS, SNAPSHOT))


def _shipping_calendar(spark, sf_dir, holidays):
    day = F.col("l_shipdate").cast("date")
    span = views.table(spark, sf_dir, "lineitem").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.select(F.explode(day_series(F.col("lo"), F.col("hi"))).alias("rate_date"))
    return days.withColumn("expected", is_expected(F.col("rate_date"), holidays))


def q_expected_days(spark, sf_dir):
    return plain(_shipping_calendar(spark, sf_dir, GATE_PARAMS.holidays))


# --- reconciliation --------------------------------------------------------------------------------------

def _late(spark, sf_dir):
    loaded, published = views.line_publications(spark, sf_dir)
    return late_diff(published, loaded, AS_OF, WHOLE_HISTORY_DAYS, hash_id="published")


def q_late_diff(spark, sf_dir):
    return plain(_late(spark, sf_dir).drop("detected_at"))


def q_late_diff_summary(spark, sf_dir):
    return diff_summary(_late(spark, sf_dir), AS_OF)


def q_late_diff_by_part(spark, sf_dir):
    loaded, published = views.publications(spark, sf_dir, "l_partkey", "l_extendedprice")
    diff = late_diff(published, loaded, AS_OF, WHOLE_HISTORY_DAYS, eps="25000.5", hash_id="published")
    return plain(diff.select("rate_date", "currency", "stage_rate", "core_rate", "diff_type"))


def q_late_diff_logged(spark, sf_dir):
    """The stored diff log after the same check date was written twice, the second time by its true content."""
    path = f"{scratch_folder(spark, 'late')}/late_data_diff"
    diff = _late(spark, sf_dir).drop("detected_at")
    replace_partition(diff.withColumn("diff_type", F.lit("stale")), path, "check_date", AS_OF)
    replace_partition(diff, path, "check_date", AS_OF)
    return diff_summary(spark.read.parquet(path), AS_OF)


# --- sinks -----------------------------------------------------------------------------------------------

def q_replace_days(spark, sf_dir):
    """The loaded table after its working days were replaced by the published ones."""
    path = f"{scratch_folder(spark, 'core')}/core_daily"
    loaded, published = views.line_publications(spark, sf_dir)
    replace_days(loaded, path, grain="month", order=["currency"])
    replace_days(published.where(is_weekday(F.col("rate_date"))), path, grain="month", order=["currency"])
    return plain(spark.read.parquet(path).drop("rate_month"))


def q_backfill_days(spark, sf_dir):
    """The loaded table after a backfill with the published days that hold every required series."""
    folder = scratch_folder(spark, "backfill")
    core, meta, stage = f"{folder}/core_daily", f"{folder}/core_meta", f"{folder}/stage_long"
    loaded, published = views.line_publications(spark, sf_dir)
    replace_days(loaded.withColumn("loaded_at", F.current_timestamp()), core, grain="month", order=["currency"])
    promote(published, lambda written: stage_gates(written, "published"), stage)
    load_days(find_table(spark, stage), core, meta, LINE_PARAMS, "backfill", strict=False)
    marked = spark.read.schema(CORE_META).parquet(meta).select("rate_date", F.col("row_count").alias("meta_rows"))
    return plain(
        spark.read.parquet(core).select("rate_date", "currency", "rate", "hash_id").join(marked, "rate_date", "left")
    )


def q_insert_missing(spark, sf_dir):
    path = f"{scratch_folder(spark, 'log')}/ingestion_log"
    orders, lines = views.table(spark, sf_dir, "orders"), views.table(spark, sf_dir, "lineitem")

    def snapshots(df, key, status, origin):
        return df.select(
            F.sha2(F.concat_ws("-", F.col(key).cast("string"), status), 256).alias("hash_id"),
            F.lit(origin).alias("origin"),
        )

    insert_missing(snapshots(orders, "o_orderkey", "o_orderstatus", "log"), path)
    insert_missing(snapshots(lines, "l_orderkey", "l_linestatus", "new"), path)
    return find_table(spark, path)


def _extracted(spark, sf_dir):
    """Extraction fields for the snapshots of the lines' orders."""
    key = F.col("l_orderkey").cast("string")
    return views.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("csv_size"), F.max("l_shipdate").alias("unpacked_at")
    ).select(
        views.order_hash(key).alias("hash_id"), F.concat(F.lit("new/"), key).alias("gcs_csv_uri"),
        "csv_size", "unpacked_at",
    )


def _filled_columns(log):
    return log.select(
        "hash_id", "gcs_zip_uri", "gcs_csv_uri", "csv_size", F.col("unpacked_at").cast("date").alias("unpacked_at")
    )


def q_fill_missing(spark, sf_dir):
    return _filled_columns(fill_missing(views.order_log(spark, sf_dir), _extracted(spark, sf_dir)))


def q_fill_table(spark, sf_dir):
    """The same filling of a stored log, prefix by prefix."""
    path = f"{scratch_folder(spark, 'log')}/ingestion_log"
    insert_missing(views.order_log(spark, sf_dir), path)
    fill_table(_extracted(spark, sf_dir), path)
    return _filled_columns(find_table(spark, path))


def q_latest_snapshot(spark, sf_dir):
    newest = latest_snapshot(views.order_log(spark, sf_dir), ["gcs_zip_uri", "zip_size", "ingested_at"])
    return newest.withColumn("ingested_at", F.col("ingested_at").cast("date"))


def q_present_keys(spark, sf_dir):
    """Lines' orders that the log of extracted snapshots holds."""
    extracted = views.order_log(spark, sf_dir).where(F.col("gcs_csv_uri").isNotNull())
    lines = views.table(spark, sf_dir, "lineitem")
    wanted = lines.select("l_orderkey").distinct().select(views.order_hash(F.col("l_orderkey")).alias("hash_id"))
    return present_keys(extracted, wanted, ["hash_id"])


def _line_log(spark, sf_dir):
    """A log with one snapshot per order of the lines; its size is the number of lines."""
    key = F.col("l_orderkey").cast("string")
    return views.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("zip_size"), F.max("l_returnflag").alias("flag")
    ).select(
        views.order_hash(key).alias("hash_id"), "zip_size",
        F.when(F.col("flag") != "A", F.concat(F.lit("zip/"), key)).otherwise("").alias("gcs_zip_uri"),
    )


def q_log_gate(spark, sf_dir):
    wanted = views.table(spark, sf_dir, "orders").select(
        views.order_hash(F.col("o_orderkey")).alias("hash_id"), F.lit(4).cast("long").alias("zip_size")
    )
    return log_gate(wanted, _line_log(spark, sf_dir), ["gcs_zip_uri", "zip_size"], ["zip_size"])


def q_snapshot_audit(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    files = views.table(spark, sf_dir, "orders").select(
        F.concat(F.when(F.col("o_orderstatus") == "P", "gone/").otherwise("zip/"), key).alias("path"),
        F.lit(4).cast("long").alias("size"),
        views.order_hash(F.when(F.col("o_orderpriority").startswith("1"), F.lit("changed")).otherwise(key)).alias(
            "hash_id"
        ),
    )
    return snapshot_audit(_line_log(spark, sf_dir), files)


# --- archives and landing --------------------------------------------------------------------------------

def _with_bad_files(landed: DataFrame) -> DataFrame:
    """Each archive beside a file that is too large and one that is no archive, of the same time."""
    limit = F.lit(PARAMS.max_archive_bytes + 1).cast("long")
    name = F.regexp_extract("path", r"rates-(\d+)\.zip", 1)
    vast = landed.withColumns({"path": F.concat(F.lit("vast-"), name, F.lit(".zip")), "length": limit})
    text = F.encode(F.concat(F.lit("no archive of "), name), "utf-8")
    broken = landed.withColumns({"path": F.concat(F.lit("broken-"), name, F.lit(".zip")), "content": text, "length": F.length(text).cast("long")})
    return landed.unionByName(vast).unionByName(broken)


def q_archive_roundtrip(spark, sf_dir):
    """Rates packed into yearly archives, opened, checked, parsed, made long and typed again, and what was wrong with others."""
    files = _stored(_with_bad_files(views.archives(spark, sf_dir)), "landed")
    found = zips.identify(files, PARAMS.max_archive_bytes)
    members = _stored(zips.extract_members(found), "members")
    rates = clean_long(zips.snapshots_long(members, strict=False)).select("rate_date", "currency", "rate", F.lit(None).cast("string").alias("problem"))
    too_large = zips.refused(files, PARAMS.max_archive_bytes).select(F.col("modified").cast("date").alias("rate_date"), F.col("error").alias("problem"))
    times = found.select("hash_id", F.col("modified").cast("date").alias("rate_date"))
    bad = zips.rejected(members).join(times, "hash_id").select("rate_date", F.regexp_extract("error", r"^(\w+):", 1).alias("problem"))
    return plain(rates.unionByName(too_large.unionByName(bad), allowMissingColumns=True))


def q_land_stream(spark, sf_dir):
    """What a stream stored after every archive landed twice under two names, and the files that it refused, one of which
    landed in two sizes under one name."""
    folder = scratch_folder(spark, "landing")
    files, log = f"{folder}/files", f"{folder}/ingestion_log"
    landed = _with_bad_files(views.archives(spark, sf_dir)).where(~F.col("path").startswith("broken"))
    write_snapshot(landed, files)
    again = spark.read.parquet(files).withColumns({
        "path": F.when(F.col("path").startswith("vast"), F.col("path")).otherwise(F.concat("path", F.lit(".again"))),
        "length": F.when(F.col("path").startswith("vast"), F.col("length") + 1).otherwise(F.col("length")),
    })
    again.write.mode("append").parquet(files)
    stream = spark.readStream.schema(FILES).parquet(files)
    land_stream(stream, log, f"{folder}/checkpoint", PARAMS.max_archive_bytes).awaitTermination()
    kept = find_table(spark, f"{log}__archives").select("hash_id", "origin").join(find_table(spark, log).select("hash_id"), "hash_id")
    kept = kept.select("origin", F.length("hash_id").cast("long").alias("hash_length"), F.lit(None).cast("string").alias("problem"))
    bad = find_table(spark, f"{log}__refused").select(F.col("path").alias("origin"), F.lit(None).cast("long").alias("hash_length"), F.col("error").alias("problem"))
    return kept.unionByName(bad)


# --- stored tables and batch runs ------------------------------------------------------------------------

def q_replace_table(spark, sf_dir):
    """A table after it was written, replaced by a part of itself, and a replacement failed."""
    path = f"{scratch_folder(spark, 'replaced')}/rates"
    replace_table(views.rates(spark, sf_dir), path)
    replace_table(find_table(spark, path).where(F.col("currency") != "AUD"), path)
    try:
        promote(views.rates(spark, sf_dir).withColumn("rate", -F.col("rate")), lambda written: stage_gates(written, SNAPSHOT), path)
    except GateFailed:
        pass
    return plain(find_table(spark, path).select("rate_date", "currency", "rate"))


def q_table_lookups(spark, sf_dir):
    """What the probes say of a stored table, with each code as a snapshot."""
    root = scratch_folder(spark, "lookups")
    tables = Tables(spark, root)
    write_snapshot(views.rates(spark, sf_dir).withColumn("hash_id", F.col("currency")), tables.path("rates"))
    rates = tables.source("rates")
    first = rates.agg(F.min("rate_date")).first()[0]
    found = [
        (code, table_rows(spark, tables.path("rates")), scan(spark, tables.path("rates"), code).count(),
         str(contains(rates, code)).lower(), str(contains(rates, code, first)).lower())
        for code in (*PARAMS.required, "none")
    ]
    return spark.createDataFrame(found, "code string, table_rows long, scanned long, there string, there_on_first_day string")


def q_materialized_marts(spark, sf_dir):
    """The daily mart over a stored staging table and a view."""
    stg = materialize(_stg(spark, sf_dir), "stg_rates", "table", f"{scratch_folder(spark, 'models')}/stg_rates")
    wide = materialize(stg_rates_wide(stg, PARAMS), "stg_rates_wide", "view")
    return plain(mart_daily(wide, PARAMS))


def q_days_to_yesterday(spark, sf_dir):
    """Rows per calendar day from the start date to yesterday."""
    days = calendar(spark, views.START)
    counts = views.rates(spark, sf_dir).groupBy("rate_date").agg(F.count(F.lit(1)).alias("row_count"))
    return days.join(counts, "rate_date", "left").select("rate_date", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def q_run(spark, sf_dir):
    """Core after batch runs of all types over a table of archives: of the newest archive's complete days the first in a
    manual run, the last in a scheduled one, and those between in a backfill."""
    folder = scratch_folder(spark, "run")
    # The line items are read once; what follows has a row per day and code.
    rates = _stored(views.rates(spark, sf_dir), "rates")
    # Raised, so that no rate changes by as much as the declared tests of the marts forbid.
    landed = _stored(views.archives(spark, sf_dir, 100_000, rates), "landed")
    year = landed.agg(F.max(F.year("modificationTime"))).first()[0]
    complete = rates.where(F.year("rate_date") == year).groupBy("rate_date").count().where(F.col("count") == len(RUN_PARAMS.required))
    days = [r[0] for r in complete.orderBy("rate_date").collect()]  # days of one year
    for kind, day in zip(("manual", "scheduled"), (days[:1], days[-1:])):
        if day:
            run(spark, folder, kind, day[0], landed, RUN_PARAMS, AS_OF)
        if kind == "manual" and days[1:-1]:
            backfill(spark, folder, days[1:-1], RUN_PARAMS)
    tables = Tables(spark, folder)
    core, meta = tables.find(CORE), tables.find(META)
    if core is None:
        return spark.createDataFrame([], "rate_date date, currency string, rate double, run_type string")
    return plain(core.join(meta.select("rate_date", "run_type"), "rate_date").select("rate_date", "currency", "rate", "run_type"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}
