"""Readers of record files, tagged text, citation tables and stored results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioscope.operators.extract import WORK

STORED = ("article_data", "category_data", "faculty_data")


def works(spark: SparkSession, path: str, schema: T.StructType = WORK) -> DataFrame:
    """Work records of a JSON array file or a folder of JSON files; a damaged file raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", True).json(path)


def table_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def tagged_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, fields map<tag, array<line>>) of two-letter tagged text; continuation lines belong to the tag above."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    records = files.select("path", F.posexplode(F.regexp_extract_all("value", F.lit(r"(?s)(PT .*?\nER)"), F.lit(1))).alias("record", "body"))
    return records.select("path", "record", tagged_fields(F.col("body")).alias("fields"))


def tagged_fields(body: Column) -> Column:
    """A record's lines by tag."""
    joined = F.regexp_replace(body, "\n   ", "\u0001")
    lines = F.filter(F.split(joined, "\n"), lambda x: F.length(x) >= 2)
    entries = F.transform(lines, lambda x: F.struct(F.substring(x, 1, 2).alias("key"), F.split(F.trim(F.substring(x, 3, 1 << 30)), "\u0001").alias("value")))
    return F.map_from_entries(entries)


def rtf_text(value: Column) -> Column:
    """Plain text of RTF: paragraph marks become line ends, other control words and groups go."""
    lines = F.regexp_replace(value, r"\\par[d]?\b ?", "\n")
    return F.regexp_replace(F.regexp_replace(lines, r"\\[a-z]+-?\d* ?", ""), r"[{}]", "")


def citation_table(lines: DataFrame, skip: int = 6) -> DataFrame:
    """(doc, line, section, citation, total) of pipe tables: one cell is a section, two are a citation and its total.

    ``lines`` has doc, line and value; the section is carried forward within a document.
    """
    cells = F.filter(F.transform(F.split("value", r"\|"), lambda c: F.trim(c)), lambda c: c != "")
    cut = lines.where(F.col("line") >= skip).select("doc", "line", cells.alias("cells")).where(F.size("cells").between(1, 3))
    named = cut.withColumn("own", F.when(F.size("cells") == 1, F.get("cells", 0)))
    section = F.last("own", ignorenulls=True).over(Window.partitionBy("doc").orderBy("line"))
    return named.withColumn("section", section).where(F.size("cells") >= 2).select("doc", "line", "section", F.get("cells", 0).alias("citation"), F.element_at("cells", -1).alias("total"))


def snapshot(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three stored tables."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in STORED}


def stored_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of stored articles; only that column is read."""
    return spark.read.parquet(f"{folder}/article_data").select("_id")
