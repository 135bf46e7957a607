"""Row-ordered windows that do not put one whole series, or the whole calendar, into one task.

A window partitioned by series is one task per series. With (rate_date, series) unique that task holds at
most one row per calendar day, which is small; the helpers here serve keys with no such bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ratewell.sources.scratch import scratch_folder


def over_series(
    df: DataFrame,
    key: Sequence[str],
    order: str,
    context: int,
    build: Callable[[WindowSpec], Sequence[dict[str, Column]]],
    block_rows: int | None = None,
) -> DataFrame:
    """Add the columns of build(window), a window over `key` ordered by `order`. build gives steps, each of
    which may use the columns of the step before; all share one shuffle and one sort. A row's values may depend
    on at most `context` rows before it. With block_rows each series is cut into blocks of that many rows; a block also gets
    the `context` rows before it, so the result is the same. The numbered rows are then written when this is called."""
    if block_rows is None:
        return _apply(df, build(Window.partitionBy(*key).orderBy(order)))
    if block_rows < context:
        raise ValueError(f"block_rows must be at least the frame reach {context}, got {block_rows}")
    blocks = Window.partitionBy(*key, "_block").orderBy(order)
    spread = (
        _numbered(df, key, order)
        .withColumn("_first", F.expr(f"_row div {block_rows}"))
        .withColumn("_spill", F.col("_row") % block_rows >= block_rows - context)
        .withColumn(
            "_block",
            F.explode(
                F.when(F.col("_spill"), F.array("_first", F.col("_first") + 1)).otherwise(F.array("_first"))
            ),
        )
    )
    return (
        _apply(spread, build(blocks))
        .where(F.col("_block") == F.col("_first"))
        .drop("_row", "_first", "_spill", "_block")
    )


def _apply(df: DataFrame, steps: Sequence[dict[str, Column]]) -> DataFrame:
    for columns in steps:
        df = df.withColumns(columns)
    return df


def _numbered(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Row number from 0 along each series. Rows are dealt into ranges of (key, order), whatever share one key has, sorted
    there and written once with their place; the input is read once. A range adds one row per key with its first place and
    its count, from which the numbers before it follow."""
    placed = df.repartitionByRange(*key, order).sortWithinPartitions(*key, order).withColumn("_place", F.monotonically_increasing_id())
    path = scratch_folder(df.sparkSession, "numbered")
    placed.write.parquet(path)
    # The id of a row holds its range in the upper bits and its place in the range in the lower 33.
    placed = df.sparkSession.read.schema(placed.schema).parquet(path).withColumn("_range", F.shiftright("_place", 33))
    counts = placed.groupBy(*key, "_range").agg(F.min("_place").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *[F.col(k).alias(f"_at_{k}") for k in key],
        F.col("_range").alias("_at_range"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from")).alias("_shift"),
    )
    same = F.col("_range") == F.col("_at_range")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    return placed.join(shifts, same).withColumn("_row", F.col("_place") + F.col("_shift")).drop(
        "_place", "_range", "_at_range", "_shift", *[f"_at_{k}" for k in key]
    )


def previous_day(days: DataFrame, column: str = "rate_date", name: str = "baseline_date") -> DataFrame:
    """For each distinct day, the latest listed day strictly before it. Days are ordered inside their year;
    the first day of a year takes the last day of the year before, from a frame of at most 9999 year rows."""
    distinct = days.select(column).distinct().withColumn("_year", F.year(column))
    # The one unpartitioned window sees one row per year; a date has at most 9999 years.
    years = distinct.groupBy("_year").agg(F.max(column).alias("_last"))
    carried = years.select("_year", F.lag("_last").over(Window.orderBy("_year")).alias("_carried"))
    inside = Window.partitionBy("_year").orderBy(column)
    return (
        distinct.withColumn("_previous", F.lag(column).over(inside))
        .join(F.broadcast(carried), "_year")
        .select(column, F.coalesce("_previous", "_carried").alias(name))
    )
