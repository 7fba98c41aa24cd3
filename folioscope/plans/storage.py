"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local session gets a temporary folder; a cluster raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="folioscope-"))
    return found or spark.sparkContext.getCheckpointDir()
