"""Comparison of two title sets: exact, fuzzy, and what share of one the other has."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import text


def regularised(titles: DataFrame, column: str = "title") -> DataFrame:
    """Distinct regularised titles that aren't empty."""
    return titles.select(text.regularise(F.col(column)).alias("title")).where("title <> ''").distinct()


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(title, side): both, left or right, in one pass over the union."""
    tagged = left.select("title", F.lit(1).alias("l"), F.lit(0).alias("r")).union(right.select("title", F.lit(0), F.lit(1)))
    merged = tagged.groupBy("title").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return merged.select("title", F.when(F.col("l") + F.col("r") == 2, "both").when(F.col("l") == 1, "left").otherwise("right").alias("side"))


def set_candidates(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(chars, other), distinct: all pairs of character sets with at least this Jaccard similarity, and some others.

    Sets of one column ``chars``, distinct characters as text. Two such sets differ by fewer than d + 1 characters, d given
    by the right set's size. With the alphabet dealt into d + 2 parts, at least two parts have no differing character: pairs
    meet where they agree on two parts. Characters are dealt by frequency in turn, so that all parts tell sets apart.
    """
    def tokens(df):
        return df.select("chars", F.explode(F.split("chars", "")).alias("char"))

    # the ranking's one task has a row per character, at most the whole of Unicode
    ranked = tokens(left).union(tokens(right)).groupBy("char").agg(F.count("*").alias("df")).select("char", F.row_number().over(Window.orderBy(F.desc("df"), "char")).alias("rank"))
    differing = lambda m: F.floor(m * (1 - threshold) / threshold + 1e-9).cast("int")

    def numbered(df):
        return tokens(df).join(ranked, "char").groupBy("chars").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))

    def keyed(df):
        """Keys of sets for a partner size ``m``: two parts and what the set has in them."""
        last, part = differing(F.col("m")) + 1, lambda x: x % (differing(F.col("m")) + 2)
        pairs = df.select("chars", "m", "ranks", F.explode(F.sequence(F.lit(0), last - 1)).alias("p"))
        pairs = pairs.select("chars", "m", "ranks", "p", F.explode(F.sequence(F.col("p") + 1, last)).alias("q"))
        own = F.filter("ranks", lambda x: (part(x) == F.col("p")) | (part(x) == F.col("q")))
        return pairs.select("chars", "m", "p", "q", F.array_join(own.cast("array<string>"), ",").alias("own"))

    n = F.size("ranks")
    kept = keyed(numbered(right).withColumn("m", n)).withColumnRenamed("chars", "other")
    sizes = F.sequence(F.ceil(n * threshold - 1e-9).cast("int"), F.floor(n / threshold + 1e-9).cast("int"))
    sought = keyed(numbered(left).withColumn("m", F.explode(sizes)))
    return sought.join(kept, ["m", "p", "q", "own"]).select("chars", "other").distinct()


def fuzzy_semi_join(left: DataFrame, right: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Left titles with a right title whose character sets have at least the given Jaccard similarity.

    Titles with equal character sets are one row; sets meet through ``set_candidates`` and are then compared exactly.
    """
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above 0.5")
    keyed = lambda df: df.withColumn("chars", F.array_join(F.array_sort(F.array_distinct(F.split("title", ""))), ""))
    titles = keyed(left)
    met = set_candidates(titles.select("chars").distinct(), keyed(right).select("chars").distinct(), threshold)
    both = F.size(F.array_intersect(F.split("chars", ""), F.split("other", "")))
    alike = both >= threshold * (F.length("chars") + F.length("other") - both) - 1e-9
    return titles.join(met.where(alike).select("chars").distinct(), "chars", "left_semi").select("title")


def match_candidates(left: DataFrame, right: DataFrame, share: float) -> DataFrame:
    """(block, value, best), distinct: all pairs of a block whose edit distance is at most ``1 - share`` of the longer length, and some others.

    So many edits leave one of a right value's segments whole, if it has one segment more than there can be edits. A
    segment that is whole is found in the left value near its own place: edits before it shift it by one each, and so do
    those behind it, counted from the ends. Pairs meet on (block, length, segment's number, segment's text).
    """
    if not 0.5 < share <= 1:
        raise ValueError("share must be above 0.5")
    whole = lambda c: F.floor(c + 1e-9).cast("int")
    edits = lambda n: whole(n * (1 - share) / share)  # noqa: E731 (at most, in a pair with a value of this length)
    start = lambda i, n: whole(i * n / (edits(n) + 1))
    size = lambda i, n: start(i + 1, n) - start(i, n)
    key = lambda text, m, i, at: F.struct(m.alias("m"), i.alias("i"), text.substr(at + 1, size(i, m)).alias("part"))

    def near(text, n, m, i):
        """Keys of the left text's parts that segment i of a right value of length m can be."""
        own, behind = start(i, m), start(i, m) + n - m
        low = F.greatest(own - i, behind - (edits(m) - i), F.lit(0))
        high = F.least(own + i, behind + (edits(m) - i), n - size(i, m))
        return F.transform(F.filter(F.sequence(low, F.greatest(low, high)), lambda at: at <= high), lambda at: key(text, m, i, at))

    best, value, n = F.col("best"), F.col("value"), F.length("value")
    kept = right.select("block", "best", F.explode(F.transform(F.sequence(F.lit(0), edits(F.length(best))), lambda i: key(best, F.length(best), i, start(i, F.length(best))))).alias("at"))
    lengths = F.sequence(F.ceil(n * share - 1e-9).cast("int"), whole(n / share))
    sought = left.select("block", "value", F.explode(lengths).alias("m"))
    sought = sought.select("block", "value", "m", F.explode(F.sequence(F.lit(0), edits(F.col("m")))).alias("i"))
    sought = sought.select("block", "value", F.explode(near(value, n, F.col("m"), F.col("i"))).alias("at")).distinct()
    return sought.join(kept, ["block", "at"]).select("block", "value", "best").distinct()


def best_match(left: DataFrame, right: DataFrame, block: str, value: str, shares: tuple[float, ...] = (0.9, 0.75)) -> DataFrame:
    """(block, value, best, ratio): of each left value the most similar right value of its block; of equal ones the smallest.

    Values are first looked up among those so similar that an index finds all of them (``match_candidates``), share by
    share downwards: what is found above a share can't be surpassed by what wasn't met. Only values without anything that
    similar are compared with their block's values one by one. Only one row per left value leaves a task, as matches are
    reduced while they are made. Null blocks and null values have no match; a block without right values gives no rows.
    """
    rest = left.select(F.col(f"`{block}`").alias("block"), F.col(f"`{value}`").alias("value")).where("value IS NOT NULL").distinct()
    other = right.select(F.col(f"`{block}`").alias("block"), F.col(f"`{value}`").alias("best")).where("best IS NOT NULL").distinct()

    def best(pairs: DataFrame) -> DataFrame:
        scored = pairs.withColumn("ratio", text.edit_ratio(F.col("value"), F.col("best")))
        top = F.min_by(F.struct("best", "ratio"), F.struct((-F.col("ratio")).alias("r"), "best")).alias("top")
        return scored.groupBy("block", "value").agg(top).select("block", "value", "top.best", "top.ratio")

    found = []
    for share in shares:
        # ratios are rounded, so one at the very edge is left to the next step, which knows its equals
        found.append(best(match_candidates(rest, other, share)).where(F.col("ratio") > 100 * share + 0.01))
        rest = rest.join(found[-1], ["block", "value"], "left_anti")
    found.append(best(rest.join(other, "block")))
    return reduce(DataFrame.union, found).select(F.col("block").alias(block), F.col("value").alias(value), "best", "ratio")


def longest(values: DataFrame, key: str, value: str, shape: str) -> DataFrame:
    """(key, longest): the longest value, one of the given shape before all others; of equal ones the smallest."""
    fits = F.col(value).rlike(shape)
    return values.groupBy(key).agg(F.min_by(value, F.struct((~fits).alias("a"), (-F.length(value)).alias("b"), F.col(value).alias("c"))).alias("longest"))


def roster_join(roster: DataFrame, names: DataFrame, value: str, shape: str) -> DataFrame:
    """``roster`` with ``key`` (last name and initial) and ``standard``: the longest of ``names`` with that key, one of the given shape first.

    Without such a name, and for a null one, ``standard`` is null; every roster row stays, repeated ones too. Names are one
    row per key before they meet the roster, so a frequent key multiplies nothing.
    """
    keyed = lambda df: df.withColumn("key", text.person_key(F.col(f"`{value}`")))
    standard = longest(keyed(names.where(F.col(f"`{value}`").isNotNull())), "key", value, shape).withColumnRenamed("longest", "standard")
    own = keyed(roster.drop("key", "standard")).withColumn("key", F.when(F.col(f"`{value}`").isNotNull(), F.col("key")))
    return own.join(standard, "key", "left")


def same_text(left: DataFrame, right: DataFrame, value: str, key: str) -> DataFrame:
    """``left`` with the ``key`` of the first right row whose cleaned text is equal."""
    first = right.select(text.clean(F.col(value)).alias("_text"), F.col(key).alias("found")).groupBy("_text").agg(F.min("found").alias("found"))
    return left.withColumn("_text", text.clean(F.col(value))).join(first, "_text", "left").drop("_text")


def summary(sides: DataFrame) -> DataFrame:
    """Counts, shares in percent, and the share of the right side that is found."""
    counted = sides.agg(*[F.count_if(F.col("side") == s).alias(n) for s, n in (("both", "found"), ("left", "left"), ("right", "right"))])
    right = F.col("found") + F.col("right")
    return counted.select(
        "found", F.col("left").alias("left_only"), F.col("right").alias("right_only"),
        F.round(100 * F.try_divide(F.col("right"), right), 2).alias("missing_percent"),
        F.round(100 - 100 * F.try_divide(F.col("right"), right), 2).alias("recall_percent"),
        F.floor(F.try_divide(right, F.col("right"))).cast("long").alias("one_in"),
    )
