"""Helpers that the corpus operators share: table access, shared storage and batch sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow batch. Texts average a few kilobytes, so a batch is about a megabyte.
BATCH_ROWS = 512
#: Bytes of one Arrow batch; a batch has one row at least, however long its text is.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given directory.

    The Arrow batches of the Python stages that follow are bounded by rows and by bytes, so that very long
    texts travel in batches of few rows. A stricter bound of the session stays.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        held = spark.conf.get(key).rstrip("b")
        if not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(key, str(most))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Where it is unset, a local session gets a temporary one; a cluster raises."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not found and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="folioscope-"))
    return found or context.getCheckpointDir()


class Scratch:
    """Tables of one run in the shared folder, which cut the lineage; each is deleted as soon as it isn't needed.

    A table is written once and read by name, so a lost executor costs its tasks and not the steps before.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder = spark, f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables of these names; without names, everything."""
        for path in [f"{self.folder}/{n}" for n in names] or [self.folder]:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def utf8_size(text: Column | str) -> Column:
    """Bytes of a text in UTF-8; null counts as empty."""
    return F.octet_length(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))).cast("long")


def make_room(df: DataFrame, *outputs: str) -> DataFrame:
    """``df`` without columns that have an output's name in any case: an output replaces an input column of its name."""
    taken = {o.lower() for o in outputs}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def packed(df: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and the whole row as a struct ``document``, so that an operator's outputs can't clash with it."""
    return df.select(*[F.col(f"`{c}`") for c in needed], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("document"))


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of packed rows, some of them replaced."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(f"document.`{c}`").alias(c) for c in columns])


_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "binary": T.BinaryType(), "boolean": T.BooleanType()}


def fields(spec: str) -> T.StructType:
    """A struct of simple types from ``"name type, ..."``; unlike DDL it needs no running session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in spec.split(","))])
