"""A folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; on one machine a temporary one if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tallyfield-')}"
    return f"{base}/{uuid.uuid4().hex}"
