"""Tables that are replaced as a whole: versions side by side, and a numbered marker that names the current one.

A version is written into a folder of its own inside the table's folder and becomes current when its marker is created.
Readers follow the highest marker that is whole and never change anything, so they see one version or the other at every
moment, also after a writer was lost at any point. Markers are created only where none stands yet: of two writers that
began with the same version one fails. The version before the current one is kept for readers that still use it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Spark's readers pass over names that begin with an underscore.
MARKERS, VERSION = "_commits", "_v"


class ReplacedMeanwhile(RuntimeError):
    """Another writer replaced the table first."""


def located(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, folder = located(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(folder)) if files.exists(folder) else []


def drop_path(spark: SparkSession, path: str) -> None:
    files, folder = located(spark, path)
    files.delete(folder, True)


def _marked(spark: SparkSession, path: str, marker: str) -> str | None:
    """The folder that a marker names; None where its writer was lost before the closing newline."""
    files, file = located(spark, f"{path}/{MARKERS}/{marker}")
    stream = files.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version, None for a table without versions."""
    path = path.rstrip("/")
    for marker in reversed(names_in(spark, f"{path}/{MARKERS}")):
        if folder := _marked(spark, path, marker):
            return f"{path}/{folder}"
    return None


def replace(spark: SparkSession, path: str, write: Callable[[str], None], check: Callable[[str], None] | None = None) -> None:
    """Write a new version and make it the current one, if it passes the check."""
    path = path.rstrip("/")
    taken = names_in(spark, f"{path}/{MARKERS}")
    marker = f"{int(taken[-1]) + 1 if taken else 1:012d}"
    folder = f"{VERSION}-{marker}-{uuid.uuid4().hex}"
    try:
        write(f"{path}/{folder}")
        if check:
            check(f"{path}/{folder}")
        _mark(spark, path, marker, folder)
    except BaseException:
        if current(spark, path) != f"{path}/{folder}":
            drop_path(spark, f"{path}/{folder}")
        raise
    _sweep(spark, path, marker)


def _mark(spark: SparkSession, path: str, marker: str, folder: str) -> None:
    files, file = located(spark, f"{path}/{MARKERS}/{marker}")
    try:
        stream = files.create(file, False)
    except Py4JJavaError as problem:
        if files.exists(file):
            raise ReplacedMeanwhile(f"{path} was replaced by another writer") from problem
        raise
    stream.write(bytearray(f"{folder}\n".encode()))
    stream.close()


def _sweep(spark: SparkSession, path: str, marker: str) -> None:
    """Remove what no reader or writer can need: markers and versions before the last two. Writers that began with the new
    version have a higher number."""
    past = [(m, _marked(spark, path, m)) for m in names_in(spark, f"{path}/{MARKERS}") if m <= marker]
    whole = [(m, folder) for m, folder in past if folder]
    kept = {folder for _, folder in whole[-2:]}
    for m, folder in past[:-1]:
        if folder not in kept:
            drop_path(spark, f"{path}/{MARKERS}/{m}")
    for name in names_in(spark, path):
        if name.startswith(f"{VERSION}-") and name.split("-")[1] <= marker and name not in kept:
            drop_path(spark, f"{path}/{name}")
