"""Schemas of the stored tables."""

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)

RATE_PAIR = T.StructType([T.StructField("currency", T.StringType()), T.StructField("rate", NUMERIC)])

INGESTION_LOG = T.StructType([
    T.StructField("hash_id", T.StringType()),
    T.StructField("gcs_zip_uri", T.StringType()),
    T.StructField("zip_size", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("gcs_csv_uri", T.StringType()),
    T.StructField("csv_size", T.LongType()),
    T.StructField("unpacked_at", T.TimestampType()),
])

RAW_LONG = T.StructType([
    T.StructField(name, T.StringType()) for name in ("date_str", "currency", "rate_str", "hash_id")
])

STAGE_LONG = T.StructType([
    T.StructField("rate_date", T.DateType()),
    T.StructField("currency", T.StringType()),
    T.StructField("rate", NUMERIC),
    T.StructField("hash_id", T.StringType()),
])

CORE_DAILY = T.StructType([*STAGE_LONG.fields, T.StructField("loaded_at", T.TimestampType())])

CORE_META = T.StructType([
    T.StructField("rate_date", T.DateType()),
    T.StructField("run_type", T.StringType()),
    T.StructField("hash_id", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("currency_count", T.LongType()),
    T.StructField("rates", T.ArrayType(RATE_PAIR)),
    T.StructField("required_curr", T.ArrayType(T.StringType())),
    T.StructField("inserted_at", T.TimestampType()),
])

LATE_DIFF = T.StructType([
    T.StructField("check_date", T.DateType()),
    T.StructField("lookback_date", T.DateType()),
    T.StructField("rate_date", T.DateType()),
    T.StructField("currency", T.StringType()),
    T.StructField("stage_hash_id", T.StringType()),
    T.StructField("core_hash_id", T.StringType()),
    T.StructField("stage_rate", NUMERIC),
    T.StructField("core_rate", NUMERIC),
    T.StructField("diff_type", T.StringType()),
    T.StructField("detected_at", T.TimestampType()),
])
