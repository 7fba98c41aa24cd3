"""Near-duplicate names: variations, similar pairs within a category, removal and standard spelling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioscope.functions import minhash, text


def variations(values: DataFrame) -> DataFrame:
    """(norm, value, n): in how many categories each spelling occurs. ``values`` has category and value."""
    return values.distinct().groupBy(text.name_form(F.col("value")).alias("norm"), "value").agg(F.count("*").alias("n"))


def most_frequent(counts: DataFrame) -> DataFrame:
    """(norm, best): the spelling of the most categories, of equals the smallest."""
    best = F.min_by("value", F.struct((-F.col("n")).alias("n"), "value"))
    return counts.groupBy("norm").agg(best.alias("best"))


def similar_pairs(values: DataFrame, threshold: float = 0.5, size: int = 3) -> DataFrame:
    """(category, v1, v2, similarity) with v1 < v2 and an exact n-gram Jaccard similarity above the threshold.

    Candidates share one of their rarest n-grams (a prefix filter, which loses no pair), so the join is
    an equality join on (category, n-gram) and not a product of the category with itself.
    """
    grams = values.distinct().select("category", "value", text.ngrams(F.col("value"), size).alias("grams"))
    tokens = grams.select("category", "value", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    frequency = tokens.groupBy("gram").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("category", "value").orderBy("df", "gram"))
    prefix = tokens.join(frequency, "gram").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1)
    a = prefix.select("category", "gram", F.col("value").alias("v1"), F.col("n").alias("n1"))
    b = prefix.select("category", "gram", F.col("value").alias("v2"), F.col("n").alias("n2"))
    near = (F.col("v1") < F.col("v2")) & (F.col("n1") >= threshold * F.col("n2")) & (F.col("n2") >= threshold * F.col("n1"))
    pairs = a.join(b, ["category", "gram"]).where(near).select("category", "v1", "v2").distinct()
    left, right = grams.toDF("category", "v1", "g1"), grams.toDF("category", "v2", "g2")
    scored = pairs.join(left, ["category", "v1"]).join(right, ["category", "v2"]).withColumn("similarity", minhash.jaccard(F.col("g1"), F.col("g2")))
    return scored.where(F.col("similarity") > threshold).select("category", "v1", "v2", "similarity")


def losers(pairs: DataFrame, best: DataFrame) -> DataFrame:
    """(category, value) of each pair's loser: the one that isn't its spelling group's best; else the larger."""
    b1 = best.select(F.col("norm").alias("norm1"), F.col("best").alias("best1"))
    b2 = best.select(F.col("norm").alias("norm2"), F.col("best").alias("best2"))
    keyed = pairs.withColumn("norm1", text.name_form(F.col("v1"))).withColumn("norm2", text.name_form(F.col("v2")))
    first, second = F.col("v1") == F.col("best1"), F.col("v2") == F.col("best2")
    loser = F.when(first & ~second, F.col("v2")).when(second & ~first, F.col("v1")).otherwise(F.greatest("v1", "v2"))
    return keyed.join(b1, "norm1").join(b2, "norm2").select("category", loser.alias("value")).distinct()


def remove_near_duplicates(values: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(category, value) without the losers of similar pairs (not transitive)."""
    values = values.distinct()
    gone = losers(similar_pairs(values, threshold), most_frequent(variations(values)))
    return values.join(gone, ["category", "value"], "left_anti")


def standardise(values: DataFrame, survivors: DataFrame) -> DataFrame:
    """(category, value) of the survivors, each in its most frequent spelling before removal, then after."""
    before = variations(values)
    after = variations(survivors).withColumnRenamed("n", "kept")
    counts = before.join(after, ["norm", "value"], "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    best = counts.groupBy("norm").agg(F.min_by("value", F.struct((-F.col("n")).alias("a"), (-F.col("kept")).alias("b"), "value")).alias("best"))
    return survivors.withColumn("norm", text.name_form(F.col("value"))).join(best, "norm").select("category", F.col("best").alias("value")).distinct()


def rename(stats: DataFrame, standard: DataFrame) -> DataFrame:
    """Statistics rows keyed (category, author, ordinal) under standard spellings; of colliding rows the last stays."""
    best = standard.withColumn("norm", text.name_form(F.col("value"))).groupBy("norm").agg(F.min("value").alias("best"))
    keyed = stats.withColumn("norm", text.name_form(F.col("author"))).join(best, "norm", "left").withColumn("key", F.coalesce("best", "author"))
    last = F.row_number().over(Window.partitionBy("category", "key").orderBy(F.desc("ordinal"), "author"))
    return keyed.withColumn("last", last).where("last = 1").drop("last", "norm", "best")


def minhash_pairs(values: DataFrame, threshold: float = 0.5, size: int = 3, count: int = 100, band: int = 2) -> DataFrame:
    """As ``similar_pairs``, by signatures: candidates agree in a band of ``band`` hashes, similarity is estimated."""
    signed = values.distinct().select("category", "value", minhash.signature(text.ngrams(F.col("value"), size), count).alias("signature")).where(F.length("value") > 0)
    bands = F.transform(F.sequence(F.lit(0), F.lit(count // band - 1)), lambda i: F.struct(i.alias("band"), F.slice("signature", i * band + 1, band).alias("part")))
    cut = signed.select("category", "value", F.explode(bands).alias("b")).select("category", "value", F.col("b.band").alias("band"), F.xxhash64("b.part").alias("part"))
    pairs = cut.withColumnRenamed("value", "v1").join(cut.withColumnRenamed("value", "v2"), ["category", "band", "part"]).where("v1 < v2").select("category", "v1", "v2").distinct()
    left, right = signed.toDF("category", "v1", "s1"), signed.toDF("category", "v2", "s2")
    scored = pairs.join(left, ["category", "v1"]).join(right, ["category", "v2"]).withColumn("similarity", minhash.similarity(F.col("s1"), F.col("s2")))
    return scored.where(F.col("similarity") > threshold).select("category", "v1", "v2", "similarity")
