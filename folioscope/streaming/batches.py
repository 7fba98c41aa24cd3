"""Micro-batches of new facts merged into stored categories."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import statistics

#: The sets of a category, and which of them keeps a batch from being merged twice.
KINDS, GATE = {"doi_list": "doi", "faculty": "author"}, "doi_list"


def batch_items(facts: DataFrame, *by: str) -> DataFrame:
    """(_id, kind, item, tc), distinct, of a batch's rows (and of every value of ``by``): a category's members, its articles with their citations."""
    kinds = [F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("item"), (F.col("tc") if kind == GATE else F.lit(None).cast("long")).alias("tc")) for kind, c in KINDS.items()]
    rows = facts.select(*by, F.col("category").alias("_id"), F.explode(F.array(*kinds)).alias("m")).select(*by, "_id", "m.*").where("item IS NOT NULL")
    return rows.groupBy(*by, "_id", "kind", "item").agg(F.max("tc").alias("tc"))


def ungated(items: DataFrame, stored: DataFrame) -> DataFrame:
    """A batch's items without those of categories of which some article is stored already."""
    gated = items.where(F.col("kind") == GATE).join(stored.where(F.col("kind") == GATE), ["_id", "kind", "item"], "left_semi").select("_id").distinct()
    return items.join(gated, "_id", "left_anti")


def categories(items: DataFrame) -> DataFrame:
    """Stored categories of all added items: sums, counts, and the faculty as an array."""
    members = items.groupBy("_id", "kind", "item").agg(F.sum("tc").alias("tc"))
    sizes = {"article_count": "doi_list", "faculty_count": "faculty"}
    counts = members.groupBy("_id").agg(F.sum("tc").alias("tc_count"), *[F.count_if(F.col("kind") == kind).alias(name) for name, kind in sizes.items()])
    people = statistics.as_arrays(items.where("kind = 'faculty'").select("_id", "kind", "item").distinct(), "_id", ["faculty"])
    return counts.join(people, "_id").withColumn("citation_average", F.round(F.try_divide("tc_count", "article_count"), 6))


ADDED = "_id string, kind string, item string, tc long"


def merge_stream(facts: DataFrame, state: str, checkpoint: str) -> None:
    """Run all available micro-batches of a streaming frame; ``state`` gets a folder of added items per batch.

    A batch reads nothing of the batches before it, so its cost goes with its own size; what it may add is decided when the state
    is read (``accepted``). A batch that is run again after a crash writes the same folder again.
    """

    def step(batch: DataFrame, number: int) -> None:
        batch_items(batch).write.mode("overwrite").parquet(f"{state}/added/batch={number}")

    facts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def accepted(items: DataFrame) -> DataFrame:
    """Items of numbered batches (``ADDED`` and batch) without those that ``ungated`` would hold back, batch after batch.

    Articles are grouped once for all batches. Only those of several batches go on, as pairs of batches of a category; a batch is
    held back from a category if it shares an article with an earlier one that isn't.
    """
    articles = items.where((F.col("kind") == GATE) & F.col("_id").isNotNull()).select("_id", "item", "batch")
    repeated = articles.groupBy("_id", "item").agg(F.min("batch").alias("lo"), F.max("batch").alias("hi")).where("lo < hi").select("_id", "item")
    together = articles.join(repeated, ["_id", "item"], "left_semi").groupBy("_id", "item").agg(F.sort_array(F.collect_set("batch")).alias("all"))
    each = together.select("_id", "all").distinct().select("_id", "all", F.posexplode("all").alias("at", "batch")).where("at > 0")
    pairs = each.select("_id", "batch", F.explode(F.slice("all", F.lit(1), F.col("at"))).alias("earlier")).distinct()
    shared = pairs.groupBy("_id", "batch").agg(F.collect_list("earlier").alias("earlier")).groupBy("_id").agg(F.sort_array(F.collect_list(F.struct("batch", "earlier"))).alias("all"))

    def judged(held, next):
        met = F.exists(next["earlier"], lambda number: ~F.array_contains(held, number))
        return F.when(met, F.array_append(held, next["batch"])).otherwise(held)

    held = shared.select("_id", F.explode(F.aggregate("all", F.array().cast("array<bigint>"), judged)).alias("batch"))
    return items.join(held, ["_id", "batch"], "left_anti")


def added(spark: SparkSession, state: str) -> DataFrame:
    """All batches' items with the number of their batch."""
    return spark.read.schema(f"{ADDED}, batch long").parquet(f"{state}/added")


def merged_state(spark: SparkSession, state: str) -> DataFrame:
    """The categories that all batches make together."""
    return categories(accepted(added(spark, state)).drop("batch"))


def merged_by_month(spark: SparkSession, facts: DataFrame, folder: str) -> DataFrame:
    """Facts with a ``month`` column run through one stream, a micro-batch per month; the final state."""
    root = f"{folder}/stream-{uuid.uuid4().hex}"
    merge_stream(monthly(spark, facts, f"{root}/facts"), f"{root}/state", f"{root}/checkpoint")
    return merged_state(spark, f"{root}/state")


def monthly(spark: SparkSession, facts: DataFrame, path: str, files: int = 1) -> DataFrame:
    """A stream of the facts that are written to ``path``, a file per month and so many files per micro-batch.

    Row groups are small, so that several tasks read a month's file.
    """
    facts.repartition("month").write.option("parquet.block.size", 4 << 20).partitionBy("month").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).drop("month").schema.add("month", "string")).option("maxFilesPerTrigger", files).parquet(path)


def merged(facts: DataFrame, conditions: list[str], folder: str) -> DataFrame:
    """Facts merged slice by slice, without a stream; they are read once, and every slice's items are kept in ``folder``."""
    slices = F.filter(F.array(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)]), lambda x: x.isNotNull())
    path = f"{folder}/slices-{uuid.uuid4().hex}"
    batch_items(facts.withColumn("slice", F.explode(slices)), "slice").write.partitionBy("slice").parquet(path)
    items = facts.sparkSession.read.schema(f"{ADDED}, slice int").parquet(path)
    stored = items.where("slice = 0").drop("slice")
    for i in range(1, len(conditions)):
        stored = stored.union(ungated(items.where(F.col("slice") == i).drop("slice"), stored))
    return categories(stored)
