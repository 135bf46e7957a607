"""Writes: replace, promote, replace-day, append-missing. All go through Spark writers, so a lost task is redone by
Spark. A table that is replaced as a whole gets a new version beside the old one (`versions`)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.functions.calendars import month_start
from ratewell.operators.gates import enforce
from ratewell.operators.upserts import fill_missing, missing_rows, one_per_key
from ratewell.sources.tables import PREFIX, find_table, prefix_of
from ratewell.sources.versions import current, located, replace

#: Files of one key prefix beyond which its rows are written together.
MOST_FILES = 16


def write_snapshot(df: DataFrame, path: str) -> None:
    """Truncating load; creates the table if needed."""
    df.write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Create or replace; df may read the table it replaces."""
    replace(df.sparkSession, path, lambda folder: write_snapshot(df, folder))


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None) -> DataFrame:
    """A model as a stored table or as a temporary view; returns the frame to read it by."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind != "table" or path is None:
        raise ValueError("kind is 'view', or 'table' with a path")
    replace_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(current(df.sparkSession, path))


def _clustered(df: DataFrame, partition: str, order: Sequence[str]) -> DataFrame:
    """Rows of one partition value together, sorted. The rebalance hint lets Spark split a value that holds
    too many rows for one task and merge small ones."""
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *order)


def write_stage(df: DataFrame, path: str) -> None:
    """Partitioned by month, sorted by date inside the files."""
    monthly = df.withColumn("rate_month", month_start(F.col("rate_date")))
    _clustered(monthly, "rate_month", ["rate_date", "currency"]).write.mode("overwrite").partitionBy(
        "rate_month"
    ).parquet(path)


def promote(
    candidate: DataFrame,
    gates: Callable[[DataFrame], DataFrame],
    path: str,
    write: Callable[[DataFrame, str], None] = write_stage,
) -> None:
    """Write the candidate as a version of the target in its final layout, check what was written, and only then make it
    the current one. A candidate that fails is removed."""
    spark = candidate.sparkSession
    schema = candidate.schema if write is not write_stage else candidate.withColumn("rate_month", month_start(F.col("rate_date"))).schema
    replace(
        spark, path, lambda folder: write(candidate, folder),
        lambda folder: enforce(gates(spark.read.schema(schema).parquet(folder))),
    )


def day_frame(spark: SparkSession, days: Sequence[date], name: str = "rate_date") -> DataFrame:
    """The days as a broadcast frame. A list of calendar days is small by nature: 36,525 in a century."""
    return F.broadcast(spark.createDataFrame([(d,) for d in days], f"{name} date"))


def month_starts(days: Sequence[date]) -> list[date]:
    return sorted({d.replace(day=1) for d in days})


def replace_days(
    df: DataFrame,
    path: str,
    date_column: str = "rate_date",
    grain: str = "day",
    order: Sequence[str] = (),
    days: Sequence[date] | None = None,
) -> None:
    """Delete the days of df from the table and insert df. Days absent from df keep their rows, so an empty df
    changes nothing.

    grain "day": the table has one partition per day and dynamic overwrite touches the given days alone.
    grain "month": one partition per month, for tables whose days are too small for a file each; the other
    days of the touched months are read and written back with the new ones. Which days df holds is looked up
    in it unless the caller names them."""
    if grain == "day":
        _overwrite(df, path, date_column, order)
        return
    if grain != "month":
        raise ValueError(f"unknown grain {grain!r}")
    monthly = df.withColumn("rate_month", month_start(F.col(date_column)))
    stored = find_table(df.sparkSession, path)
    if stored is not None:
        if days is None:
            days = [row[0] for row in df.select(date_column).distinct().collect()]
        # The months are literals, so they prune the partitions of the table.
        kept = stored.where(F.col("rate_month").isin(month_starts(days))).join(
            day_frame(df.sparkSession, days, date_column), date_column, "left_anti"
        )
        monthly = monthly.unionByName(kept)
    _overwrite(monthly, path, "rate_month", [date_column, *order])


def _overwrite(df: DataFrame, path: str, partition: str, order: Sequence[str]) -> None:
    _clustered(df, partition, order).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition).parquet(path)


def replace_partition(df: DataFrame, path: str, column: str, value: date | str) -> None:
    """Replace the rows of one partition value, also by nothing: an empty df leaves an empty partition."""
    df.drop(column).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={value}")


# --- tables by key ---------------------------------------------------------------------------------------

def _prefixes(rows: DataFrame) -> list[str]:
    return [row[0] for row in rows.select(PREFIX).distinct().collect()]  # PREFIXES at most


def insert_missing(new: DataFrame, path: str, key: str = "hash_id", order: Sequence[str] = ("gcs_zip_uri",), most_files: int | None = MOST_FILES) -> None:
    """Append the rows whose key the table lacks, one per key. The table is partitioned by a prefix made of the key; only
    the prefixes of the new rows are read, and those that have got more than `most_files` files are written together."""
    spark = new.sparkSession
    rows = one_per_key(new, key, order).withColumn(PREFIX, prefix_of(F.col(key))).persist()
    try:
        touched = _prefixes(rows)
        stored = find_table(spark, path, keyed=True)
        if stored is None:
            fresh = rows
        elif PREFIX in stored.columns:
            fresh = rows.join(stored.where(F.col(PREFIX).isin(touched)).select(key), key, "left_anti")
        else:
            missing_rows(stored, rows.drop(PREFIX), key).write.mode("append").parquet(path)
            return
        _clustered(fresh, PREFIX, [key]).write.mode("append").partitionBy(PREFIX).parquet(path)
    finally:
        rows.unpersist()
    if most_files is not None:
        compact(spark, path, [p for p in touched if _part_files(spark, path, p) > most_files], key)


def _part_files(spark: SparkSession, path: str, prefix: str) -> int:
    files, pattern = located(spark, f"{path.rstrip('/')}/{PREFIX}={prefix}/part-*")
    return len(files.globStatus(pattern))


def compact(spark: SparkSession, path: str, prefixes: Sequence[str], key: str = "hash_id") -> None:
    """Write the rows of the given prefixes together, one prefix after the other."""
    for prefix in prefixes:
        _overwrite(find_table(spark, path, keyed=True).where(F.col(PREFIX) == prefix), path, PREFIX, [key])


def fill_table(updates: DataFrame, path: str, key: str = "hash_id", guard: str = "gcs_csv_uri", columns: Sequence[str] = ("gcs_csv_uri", "csv_size", "unpacked_at")) -> None:
    """fill_missing on a stored table by key: only prefixes that hold updates are read and written."""
    offered = updates.withColumn(PREFIX, prefix_of(F.col(key))).persist()
    try:
        touched = find_table(updates.sparkSession, path, keyed=True).where(F.col(PREFIX).isin(_prefixes(offered)))
        _overwrite(fill_missing(touched, offered.drop(PREFIX), key, guard, columns), path, PREFIX, [key])
    finally:
        offered.unpersist()
