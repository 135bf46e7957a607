"""Change against the previous row and rolling statistics, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.numeric import difference, mean, numeric, relative_change, safe_divide
from ratewell.functions.ordering import over_series


def with_change(stg: DataFrame, key: Sequence[str] = ("currency",), block_rows: int | None = None) -> DataFrame:
    """Every row with the previous listed rate of its series and the change; both NULL on the first row."""
    lagged = over_series(
        stg.select("rate_date", *key, numeric(F.col("rate")).alias("rate")),
        key,
        "rate_date",
        1,
        lambda window: [{"prev_rate": F.lag("rate").over(window)}],
        block_rows,
    )
    return lagged.withColumn("pct_change", relative_change(F.col("rate"), F.col("prev_rate")))


def pct_change(stg: DataFrame, key: Sequence[str] = ("currency",), block_rows: int | None = None) -> DataFrame:
    """Change against the previous listed row of the series; the first row of a series gives none."""
    return with_change(stg, key, block_rows).where(F.col("prev_rate").isNotNull())


def rolling_stats(
    stg: DataFrame,
    windows: Sequence[int] = (7, 30),
    key: Sequence[str] = ("currency",),
    block_rows: int | None = None,
) -> DataFrame:
    """First date, minimum, maximum, mean and relative range over the last n rows of the series, for each n.
    Frames count rows, not days; short frames at the start of a series are kept. Dates and means come from
    running values n rows apart, which cost the same for any n; a mean is exact, as its sums are decimals."""

    def steps(window) -> list[dict[str, Column]]:
        so_far = window.rowsBetween(Window.unboundedPreceding, 0)
        running = {
            "_sum": F.coalesce(F.sum("rate").over(so_far), numeric(F.lit(0))),
            "_count": F.count("rate").over(so_far),
            "_start": F.first("rate_date").over(so_far),
        }
        framed = {}
        for n in windows:
            frame = window.rowsBetween(1 - n, 0)
            framed[f"window_start_date_{n}d"] = F.coalesce(
                F.lag("rate_date", n - 1).over(window), F.col("_start")
            )
            framed[f"rate_min_{n}d"] = F.min("rate").over(frame)
            framed[f"rate_max_{n}d"] = F.max("rate").over(frame)
            framed[f"_sum_{n}"] = F.lag("_sum", n, 0).over(window)
            framed[f"_count_{n}"] = F.lag("_count", n, 0).over(window)
        return [running, framed]

    framed = over_series(
        stg.select("rate_date", *key, numeric(F.col("rate")).alias("rate")),
        key,
        "rate_date",
        max(windows) - 1,
        steps,
        block_rows,
    )

    columns = []
    for n in windows:
        low, high = F.col(f"rate_min_{n}d"), F.col(f"rate_max_{n}d")
        columns += [
            F.col(f"window_start_date_{n}d"),
            low,
            high,
            mean(
                difference(F.col("_sum"), F.col(f"_sum_{n}")), F.col("_count") - F.col(f"_count_{n}"), n
            ).alias(f"rate_avg_{n}d"),
            safe_divide(difference(high, low), low).alias(f"range_pct_{n}d"),
        ]
    return framed.select("rate_date", *key, "rate", *columns)
