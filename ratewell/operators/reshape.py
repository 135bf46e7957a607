"""Wide to long, long to wide, typing, and change of base."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.cleaning import clean_code, strict_date, strict_numeric
from ratewell.functions.numeric import numeric, safe_divide

DATE_COLUMN = "Date"
TRAILING_COLUMN = "_trailing_empty"


def stamp(df: DataFrame, **constants) -> DataFrame:
    """Constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def series_columns(wide: DataFrame) -> list[str]:
    names = [c for c in wide.columns if c not in (DATE_COLUMN, TRAILING_COLUMN, "hash_id")]
    if not names:
        raise ValueError("the snapshot has no series columns")
    return names


def to_long(wide: DataFrame, hash_id: str | None = None) -> DataFrame:
    """(date_str, currency, rate_str, hash_id), all text; NULL cells give no row, empty cells do. hash_id is a
    constant for one snapshot, or is taken from the frame's own column for several."""
    names = series_columns(wide)
    owner = F.col("hash_id") if hash_id is None else F.lit(hash_id)
    text = wide.select(
        F.col(DATE_COLUMN).cast("string").alias("date_str"),
        owner.alias("hash_id"),
        *[F.col(f"`{c}`").cast("string").alias(c) for c in names],
    )
    return (
        text.unpivot(["date_str", "hash_id"], [f"`{c}`" for c in names], "currency", "rate_str")
        .where(F.col("rate_str").isNotNull())
        .select("date_str", "currency", "rate_str", "hash_id")
    )


def drop_untyped(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("rate_date").isNotNull()
        & F.col("currency").isNotNull()
        & (F.col("currency") != "")
        & F.col("rate").isNotNull()
    )


def clean_long(raw_long: DataFrame, hash_id: str | None = None) -> DataFrame:
    """Typed rows without exact copies. Copies collapse in the partial aggregation, before the shuffle."""
    if hash_id is not None:
        raw_long = raw_long.where(F.col("hash_id") == hash_id)
    typed = raw_long.select(
        strict_date(F.col("date_str")).alias("rate_date"),
        clean_code(F.col("currency")).alias("currency"),
        strict_numeric(F.col("rate_str")).alias("rate"),
        "hash_id",
    )
    return drop_untyped(typed).distinct()


def wide_name(code: str) -> str:
    return f"rate_{code.lower()}"


def to_wide(stg: DataFrame, listed: Sequence[str], base: str) -> DataFrame:
    """One row per day, one column per listed code; the base is 1. Conditional maxima need one shuffle of
    partial maxima, where a pivot would group twice."""

    def cell(code: str) -> Column:
        rate = F.lit(1) if code == base else F.when(F.col("currency") == code, F.col("rate"))
        return numeric(F.max(rate)).alias(wide_name(code))

    return stg.groupBy("rate_date").agg(*[cell(code) for code in listed])


def rebase(wide: DataFrame, bases: Sequence[str], home: str) -> DataFrame:
    """Each row once per base, every rate divided by the rate of that base; the home base is passed through.
    Bases and divisors are one exploded array, so the wide input is planned and read once and each rate divided in one
    place of the plan."""
    rates = [c for c in wide.columns if c != "rate_date"]
    pairs = F.array(*[F.struct(F.lit(b).alias("base_currency"), numeric(F.col(wide_name(b))).alias("_divisor")) for b in bases])
    rows = wide.select("rate_date", *rates, F.inline(pairs))
    passed = F.col("base_currency") == home
    cells = [F.when(passed, numeric(F.col(c))).otherwise(safe_divide(F.col(c), F.col("_divisor"))).alias(c) for c in rates]
    return rows.select("rate_date", "base_currency", *cells)
