"""Three-level subject taxonomy as a dimension table (top, mid, low)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEVELS = ("top", "mid", "low")


def from_json(spark: SparkSession, document: str) -> DataFrame:
    """The dimension of ``{top: {mid: [low, ...]}}``."""
    parsed = spark.sql("SELECT from_json(:doc, 'map<string, map<string, array<string>>>') AS tree", {"doc": document})
    return parsed.select(F.explode("tree").alias("top", "mids")).select("top", F.explode("mids").alias("mid", "lows")).select("top", "mid", F.explode("lows").alias("low"))


def level_names(taxonomy: DataFrame) -> DataFrame:
    """(level, name) of every label."""
    return taxonomy.select(F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.col(n).alias("name")) for n in LEVELS])).alias("x")).select("x.*").distinct()


def children(taxonomy: DataFrame, parent: str, name: str | None = None) -> DataFrame:
    """Labels below the given one, or below every label of the level."""
    child = LEVELS[LEVELS.index(parent) + 1]
    rows = taxonomy if name is None else taxonomy.where(F.col(parent) == name)
    return rows.select(parent, child).distinct()


def parents(labels: DataFrame, taxonomy: DataFrame, child: str) -> DataFrame:
    """``labels`` (a column named like the level) with the parent level's label; a missing label raises when read."""
    parent = LEVELS[LEVELS.index(child) - 1]
    lookup = taxonomy.groupBy(child).agg(F.min(parent).alias(parent))
    found = labels.join(lookup, child, "left")
    return found.withColumn(parent, F.coalesce(parent, F.raise_error(F.concat(F.lit(f"no {child} label "), child)).cast("string")))


def is_valid(taxonomy: DataFrame, labels: DataFrame, level: str, label: str) -> DataFrame:
    """``labels`` with ``valid``: whether the label exists at the level."""
    if level not in LEVELS:
        raise ValueError(f"no such level: {level}")
    known = taxonomy.select(F.col(level).alias(label)).distinct().withColumn("known", F.lit(True))
    return labels.join(known, label, "left").withColumn("valid", F.coalesce("known", F.lit(False))).drop("known")


def path(*levels: Column) -> Column:
    """Labels from the top down as one key, so that equal names at two levels stay apart."""
    return F.concat_ws("/", *levels)
