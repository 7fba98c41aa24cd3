"""Writers of result tables, flat reports and versioned state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import merge, report


def write_json(df: DataFrame, path: str, extend: bool = False) -> None:
    df.write.mode("append" if extend else "overwrite").json(path)


def update_json(spark: SparkSession, df: DataFrame, stored: str, path: str, key: str) -> None:
    """The rows of ``stored`` with those of ``df`` in place of rows of their key, written to another path."""
    merge.update_map(spark.read.schema(df.schema).json(stored), df, key).write.mode("overwrite").json(path)


def write_raw(df: DataFrame, path: str, raw: str = "raw") -> None:
    """Raw outputs of a step beside their keys, as JSON rows."""
    df.withColumn(raw, F.to_json(F.col(raw)) if df.schema[raw].dataType.typeName() in ("struct", "map", "array") else F.col(raw)).write.mode("overwrite").json(path)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def split_files(df: DataFrame, folder: str) -> None:
    """One JSON file per record."""
    df.write.mode("overwrite").option("maxRecordsPerFile", 1).json(folder)


def write_report(df: DataFrame, folder: str) -> None:
    """A flat file with list cells as text."""
    report.joined_lists(df).write.mode("overwrite").option("header", True).csv(folder)


def empty_table(spark: SparkSession, folder: str, like: DataFrame) -> None:
    spark.createDataFrame([], like.schema).write.mode("overwrite").parquet(folder)


MERGES = {"category_data": merge.merge_categories, "faculty_data": merge.merge_authors, "article_data": merge.insert_new}


def next_version(spark: SparkSession, folder: str, version: int, new: dict[str, DataFrame]) -> int:
    """Merge new rows into version ``version`` of the stored tables and write the next one.

    A version is a folder of its own, so what is read is never overwritten and a repeated write gives the same rows.
    """
    for name, rows in new.items():
        old = spark.read.parquet(f"{folder}/v{version}/{name}") if version else spark.createDataFrame([], rows.schema)
        merged = MERGES[name](old, rows)
        merged.write.mode("overwrite").parquet(f"{folder}/v{version + 1}/{name}")
    return version + 1
