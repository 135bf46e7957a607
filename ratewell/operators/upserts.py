"""Upserts as frames: what an insert-only or a conditional merge leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(rows: DataFrame, key: str, order: Sequence[str] = ("gcs_zip_uri",)) -> DataFrame:
    """One row per key: the smallest by `order`, then by all other columns, so that a repeated run keeps the same one."""
    first = [c for c in order if c in rows.columns and c != key]
    rest = [c for c in rows.columns if c not in (key, *first)]
    kept = rows.groupBy(key).agg(F.min(F.struct(*first, *rest)).alias("_kept"))
    return kept.select(*[F.col(key) if c == key else F.col("_kept")[c].alias(c) for c in rows.columns])


def missing_rows(log: DataFrame, new: DataFrame, key: str = "hash_id") -> DataFrame:
    """Rows of `new` whose key the log lacks, one per key. Copies of a key collapse before the shuffle."""
    return one_per_key(new, key).join(log.select(key), key, "left_anti")


def fill_missing(
    log: DataFrame,
    updates: DataFrame,
    key: str = "hash_id",
    guard: str = "gcs_csv_uri",
    columns: Sequence[str] = ("gcs_csv_uri", "csv_size", "unpacked_at"),
) -> DataFrame:
    """The log with `columns` taken from the update row of the same key where `guard` is NULL."""
    offered = one_per_key(updates, key, columns).select(
        F.col(key), F.lit(True).alias("_offered"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    fill = F.col(guard).isNull() & F.coalesce(F.col("_offered"), F.lit(False))
    joined = log.join(offered, key, "left")
    return joined.select(
        *[
            F.when(fill, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in log.columns
        ]
    )
