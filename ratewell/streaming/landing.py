"""Incremental landing: every new archive is logged once, by content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from ratewell.sources.archives import address, identify, log_rows, refused, store_archives
from ratewell.sources.sinks import insert_missing

# Columns of Spark's binaryFile source.
FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def landing_files(spark: SparkSession, directory: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
    )


def land_stream(
    files: DataFrame, log_path: str, checkpoint: str, max_size: int, refused_path: str | None = None, archives_path: str | None = None,
) -> StreamingQuery:
    """Store and log the archives of a stream with the binaryFile columns, up to what is there now. The stream checkpoint
    skips files already seen; tables by key skip contents already seen, also when a batch is run again after a failure, and
    a batch reads only the prefixes of its own keys. Files of a size that no archive may have go to a table of their own, a
    row for each path, size and time. Both tables are beside the log unless their paths are given."""
    beside = log_path.rstrip("/")
    refused_path, archives_path = refused_path or f"{beside}__refused", archives_path or f"{beside}__archives"

    def log_batch(batch: DataFrame, _: int) -> None:
        archives = identify(batch, max_size)
        store_archives(archives, archives_path)
        insert_missing(log_rows(archives.withColumn("path", address(archives_path, F.col("hash_id")))), log_path)
        bad = refused(batch, max_size)
        seen = F.sha2(F.concat_ws("\u0001", "path", F.col("size").cast("string"), F.col("modified").cast("string")), 256)
        insert_missing(bad.withColumn("file_id", seen), refused_path, "file_id")

    return (
        files.writeStream.foreachBatch(log_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
