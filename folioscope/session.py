"""Session builder with the settings that the library's semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Semantics (not tuning): duplicate map keys keep the last value, timestamps are UTC.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
}
#: The most rows and bytes of one Arrow batch, so that Python holds few long texts at a time; a batch has one row at least.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 10000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster, apply ``SEMANTICS`` to the existing one."""
    builder = SparkSession.builder.master(master).appName("folioscope")
    settings = SEMANTICS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to a session made elsewhere, and the bounds of a batch; a stricter bound of the session stays."""
    for key, value in SEMANTICS.items():
        spark.conf.set(key, value)
    for key, most in BATCH.items():
        held = spark.conf.get(key).rstrip("b")
        if not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(key, str(most))
    return spark
