"""Folders for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's checkpoint folder, which every executor shares. Only a local
    session without that setting gets a temporary folder of the machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ratewell-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
