"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. A temporary one only in local sessions."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append(tempfile.mkdtemp(prefix="ratewell-llm-"))
    return _OWN_FOLDER[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame once to the shared folder and reads it back: cuts the lineage and survives lost executors. The write's
    own shuffle files go when it ends; else they fill disks until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once, however often use refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def wrapped(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns beside the whole row as `row`, so that extra columns can't clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[F.col(n) for n in names])


def doc_hash(column: str = "doc_id") -> Column:
    """crc32 of the id as text; the remainder of a null id is null and counts as training data nowhere."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def one_blas_thread() -> None:
    """Keeps numpy's products in the calling thread. A worker runs one task; threads beside it only wait for each other on
    small matrices, and for the cores of other tasks."""
    with contextlib.suppress(OSError):
        with open("/proc/self/maps") as maps:
            libraries = {line.split()[-1] for line in maps if "openblas" in line}
        for library in map(ctypes.CDLL, libraries):
            for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
                if hasattr(library, name):
                    getattr(library, name)(1)
