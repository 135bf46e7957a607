"""Reading stored tables: existence, emptiness, membership, log lookups."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.functions.calendars import to_date
from ratewell.schemas import INGESTION_LOG
from ratewell.sources.versions import current

#: Partition column of tables that are looked up by key, made of the key's checksum, and how many folders it makes: as many
#: as Spark lists without a job.
PREFIX, PREFIXES = "key_prefix", 32


@dataclass(frozen=True)
class Tables:
    """Parquet tables under one root folder."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def source(self, name: str) -> DataFrame:
        found = self.find(name)
        if found is None:
            raise FileNotFoundError(f"no table {self.path(name)}")
        return found

    def find(self, name: str) -> DataFrame | None:
        return find_table(self.spark, self.path(name))


def find_table(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame | None:
    """The table at `path`, in its current version, or None where nothing is stored yet. The prefix column of a table by
    key is shown if `keyed`."""
    while True:
        version = current(spark, path)
        try:
            df = spark.read.parquet(version or path)
            return df if keyed or PREFIX not in df.columns else df.drop(PREFIX)
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            if current(spark, path) == version:  # else it was replaced twice since it was looked up
                return None


# --- tables by key ---------------------------------------------------------------------------------------

def prefix_of(key: Column) -> Column:
    """A letter, so that no reader takes a folder's name for a number, and two digits of the key's checksum."""
    return F.concat(F.lit("k"), F.lower(F.lpad(F.hex(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % PREFIXES), 2, "0")))


def prefix_of_value(key: str | None) -> str:
    return f"k{zlib.crc32((key or '').encode()) % PREFIXES:02x}"


def rows_of_key(spark: SparkSession, path: str, value: str, key: str = "hash_id") -> DataFrame | None:
    """The rows of one key of a table by key, from the one partition that can hold them."""
    df = find_table(spark, path, keyed=True)
    if df is None:
        return None
    if PREFIX in df.columns:
        df = df.where(F.col(PREFIX) == prefix_of_value(value)).drop(PREFIX)
    return df.where(F.col(key) == value)


def scan(spark: SparkSession, path: str, hash_id: str | None = None) -> DataFrame:
    df = spark.read.parquet(current(spark, path) or path)
    return df if hash_id is None else df.where(F.col("hash_id") == hash_id)


def table_rows(spark: SparkSession, path: str) -> int | None:
    """Row count, None if the table does not exist. Parquet answers the count from its footers."""
    df = find_table(spark, path)
    return None if df is None else df.count()


def contains(df: DataFrame, hash_id: str, rate_date: date | str | None = None) -> bool:
    """Is there a row of this snapshot (and day)? Stops at the first one."""
    hit = df.where(F.col("hash_id") == hash_id)
    if rate_date is not None:
        hit = hit.where(F.col("rate_date") == F.lit(to_date(rate_date)))
    return not hit.isEmpty()


def present_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wanted keys that occur in df: the set form of contains()."""
    return wanted.join(df.select(*keys), list(keys), "left_semi")


def _log_columns(fields: Sequence[str]) -> list[str]:
    """The part of the log's schema that is asked for, always with its key; the schema itself raises on other names."""
    part = T.StructType([INGESTION_LOG["hash_id"]])
    for field in fields:
        if field not in part.names:
            part = part.add(INGESTION_LOG[field])
    if not fields:
        raise ValueError("an empty list of log fields")
    return part.names


def latest_snapshot(log: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The newest log row, as a frame of at most one row; equal times are decided by hash_id."""
    names = _log_columns(fields)
    return log.orderBy(F.col("ingested_at").desc(), F.col("hash_id")).limit(1).select(*names)


def snapshot_by_hash(log: DataFrame, hash_id: str, fields: Sequence[str]) -> DataFrame:
    return log.where(F.col("hash_id") == hash_id).limit(1).select(*_log_columns(fields))
