"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from .operators.nearest import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder below the one in ``spark.checkpoint.dir``; nothing is there yet."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
