"""Rate tables derived from the order, line-item and event tables, over all of their rows.

The ship day is the rate day. Six series are the pairs of return flag and line status; where a loaded and a
published table are compared, lines of status F stand for what was loaded and lines of status O for the newer
publication, with the line number as the series.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.params import Params
from ratewell.streaming.landing import FILES

# Flag and status pairs and the codes they stand for.
PAIR_CODES = {"AF": "USD", "AO": "GBP", "NF": "JPY", "NO": "CHF", "RF": "CAD", "RO": "AUD"}
LINE_CODES = tuple(f"LN{letter}" for letter in "ABCDEFG")
SNAPSHOT = "snapshot-1"

START, AS_OF = "1995-01-01", "2001-12-31"
WHOLE_HISTORY_DAYS = 3000

PARAMS = Params(start_date=START, holidays=(), core_grain="month")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ship_day() -> Column:
    return F.col("l_shipdate").cast("date").alias("rate_date")


def _best(value: str) -> Column:
    return F.max(value).cast("decimal(18,2)").cast("decimal(38,9)").alias("rate")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rate_date, currency, rate, hash_id): the highest extended price per ship day and pair."""
    codes = F.create_map(*[F.lit(x) for pair in PAIR_CODES.items() for x in pair])
    best = (
        table(spark, sf_dir, "lineitem")
        .groupBy(_ship_day(), "l_returnflag", "l_linestatus")
        .agg(_best("l_extendedprice"))
    )
    # The code is looked up once per aggregated row, not once per line.
    code = codes[F.concat("l_returnflag", "l_linestatus")]
    return best.select("rate_date", code.alias("currency"), "rate", F.lit(SNAPSHOT).alias("hash_id"))


def large_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates, 10^6, 10^7 or 10^8 times as large by the day of the month."""
    factor = F.element_at(F.array(*[F.lit(10**k).cast("decimal(9,0)") for k in (6, 7, 8)]), F.dayofmonth("rate_date") % 3 + 1)
    return rates(spark, sf_dir).withColumn("rate", (F.col("rate").cast("decimal(18,2)") * factor).cast("decimal(38,9)"))


def rates_by(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """(rate_date, series, rate) with a key column of the line items as the series."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(_ship_day(), F.col(key).alias("series"))
        .agg(_best("l_extendedprice"))
    )


def event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("rate_date"), F.col("event_type").alias("series"))
        .agg(_best("value"))
    )


def publications(
    spark: SparkSession, sf_dir: str, key: str, value: str, code: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(loaded, published) tables of (rate_date, currency, rate, hash_id) per key column, or its code."""
    lines = table(spark, sf_dir, "lineitem")

    def one(status: str, hash_id: str) -> DataFrame:
        best = lines.where(F.col("l_linestatus") == status).groupBy(_ship_day(), key).agg(_best(value))
        name = F.col(key) if code is None else code
        return best.select("rate_date", name.alias("currency"), "rate", F.lit(hash_id).alias("hash_id"))

    return one("F", "loaded"), one("O", "published")


def line_publications(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    code = F.concat(F.lit("LN"), F.char(F.col("l_linenumber") + 64))
    return publications(spark, sf_dir, "l_linenumber", "l_quantity", code)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates as provider text, spoilt on some days of the month: blanks, N/A, words, long fractions, partial
    dates, padded codes, zero and negative rates, exact copies and second rates for a key."""
    day = F.dayofmonth("rate_date")

    def spoilt(plain: Column, cases: dict[int, Column]) -> Column:
        result = F.when(day.isNull(), plain)
        for n, value in cases.items():
            result = result.when(day == n, value)
        return result.otherwise(plain)

    def text(copy: Column) -> Column:
        rate = F.col("rate").cast("decimal(18,2)").cast("string")
        second = (F.col("rate") + copy).cast("decimal(18,2)").cast("string")
        iso = F.date_format("rate_date", "yyyy-MM-dd")
        return F.struct(
            spoilt(iso, {
                10: F.date_format("rate_date", "yyyy-MM"),
                11: F.date_format("rate_date", "yyyy-M-d"),
                12: F.concat(iso, F.lit(" 10:00")),
            }).alias("date_str"),
            spoilt(F.col("currency"), {
                13: F.concat(F.lit(" "), F.lower("currency"), F.lit(" ")),
                14: F.concat(F.lit("\t"), F.col("currency"), F.lit("\u00a0")),
            }).alias("currency"),
            spoilt(rate, {
                3: F.lit(""), 4: F.lit("N/A"), 5: F.lit(" N/A "), 6: F.lit("abc"), 7: F.lit("n/a"),
                8: F.concat(F.lit("  "), rate, F.lit("\t")),
                9: F.concat(rate, F.lit("12345675")),
                15: F.lit(None).cast("string"),
                16: F.lit("0"),
                17: F.concat(F.lit("-"), rate),
                19: second,
            }).alias("rate_str"),
        )

    copies = F.when(day.isin(18, 19), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rates(spark, sf_dir).select(F.inline(F.transform(copies, text)), "hash_id")


def wide_text(spark: SparkSession, sf_dir: str, lift: int = 0, found: DataFrame | None = None) -> DataFrame:
    """The rates, each raised by `lift`, as a provider's wide table: Date and one text column per code, NULL where a code has
    none. found: the rates, where they are stored already."""
    cells = [
        F.max(F.when(F.col("currency") == c, (F.col("rate") + lift).cast("decimal(18,2)").cast("string"))).alias(c)
        for c in PARAMS.required
    ]
    found = rates(spark, sf_dir) if found is None else found
    return found.groupBy(F.col("rate_date").cast("string").alias("Date")).agg(*cells)


def archives(spark: SparkSession, sf_dir: str, lift: int = 0, found: DataFrame | None = None) -> DataFrame:
    """One ZIP per ship year with the columns of the binaryFile source; a year has at most 366 lines of six
    values. Even years use semicolons. found: the rates, where they are stored already."""
    codes = list(PARAMS.required)
    delimiter = F.when(F.substring("Date", 4, 1).isin("0", "2", "4", "6", "8"), ";").otherwise(",")
    line = F.array_join(
        F.array("Date", *[F.coalesce(F.col(c), F.lit("N/A")) for c in codes], F.lit("")), "\u0001"
    )
    years = (
        wide_text(spark, sf_dir, lift, found)
        .select(F.substring("Date", 1, 4).alias("year"), F.replace(line, F.lit("\u0001"), delimiter).alias("line"),
                delimiter.alias("delimiter"))
        .groupBy("year", "delimiter")
        .agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("body"))
    )
    header = F.array_join(F.array(*[F.lit(c) for c in ("Date", *codes, "")]), "\u0001")
    text = F.concat(F.replace(header, F.lit("\u0001"), F.col("delimiter")), F.lit("\n"), F.col("body"), F.lit("\n"))

    def zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = [zip_bytes(f"rates-{y}.csv", t) for y, t in zip(batch["year"], batch["text"])]
            yield pd.DataFrame({
                "path": [f"rates-{y}.zip" for y in batch["year"]],
                "modificationTime": pd.to_datetime([f"{y}-12-31" for y in batch["year"]], utc=True),
                "length": [len(c) for c in contents],
                "content": contents,
            })

    return years.select("year", text.alias("text")).mapInPandas(zipped, FILES)


def zip_bytes(name: str, text: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(zipfile.ZipInfo(name, (2000, 1, 1, 0, 0, 0)), text, zipfile.ZIP_DEFLATED)
    return buffer.getvalue()


def order_hash(key: Column) -> Column:
    return F.sha2(key.cast("string"), 256)


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingestion log with one snapshot per order; open orders are not extracted yet."""
    key = F.col("o_orderkey").cast("string")
    extracted = F.col("o_orderstatus") != "O"
    return table(spark, sf_dir, "orders").select(
        order_hash(key).alias("hash_id"),
        F.concat(F.lit("zip/"), key).alias("gcs_zip_uri"),
        F.length("o_orderpriority").cast("long").alias("zip_size"),
        F.col("o_orderdate").alias("ingested_at"),
        F.when(extracted, F.concat(F.lit("csv/"), key)).alias("gcs_csv_uri"),
        F.when(extracted, F.lit(0)).cast("long").alias("csv_size"),
        F.when(extracted, F.col("o_orderdate")).alias("unpacked_at"),
    )
