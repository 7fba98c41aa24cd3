"""Incremental merges of new results into stored ones, safe to replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window


def _both(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    left = old.select(F.col(key), F.struct(*[F.col(c) for c in old.columns]).alias("o"))
    right = new.select(F.col(key), F.struct(*[F.col(c) for c in new.columns]).alias("n"))
    return left.join(right, key, "full_outer")


def _merged(field: str, kind: str, gate: Column) -> Column:
    o, n = F.col(f"o.`{field}`"), F.col(f"n.`{field}`")
    made = {"set": lambda: F.array_sort(F.array_union(o, n)), "sum": lambda: o + n, "kept": lambda: o}[kind]()
    made = made if kind == "sum" else F.coalesce(made, o, n)
    return F.when(F.col("o").isNull(), n).when(F.col("n").isNull() | gate, o).otherwise(made)


def _aligned(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns that only ``other`` has, as nulls."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns})


def _upsert(old: DataFrame, new: DataFrame, key: str, gate_on: str, sums: list[str], made: list[str]) -> DataFrame:
    """Disjoint ``gate_on`` sets are merged; any overlap leaves the stored row as it is.

    All arrays are sets and united; other columns keep the stored value. Columns of ``made`` are computed
    anew by the caller.
    """
    old, new = (df.drop(*made) for df in (_aligned(old, new), _aligned(new, old)))
    gate = F.coalesce(F.arrays_overlap(F.col(f"o.{gate_on}"), F.col(f"n.{gate_on}")), F.lit(False))
    kinds = {f.name: "set" if isinstance(f.dataType, ArrayType) else "sum" if f.name in sums else "kept" for f in old.schema.fields if f.name != key}
    return _both(old, new, key).select(key, *[_merged(c, kind, gate).alias(c) for c, kind in kinds.items()])


def merge_categories(old: DataFrame, new: DataFrame) -> DataFrame:
    """(_id, doi_list, faculty, tc_count), all other columns of either side, and counts; the citation average is over all articles."""
    titled = "titles" in {*old.columns, *new.columns}
    counts = {"article_count": "titles" if titled else "doi_list", "faculty_count": "faculty"}
    if "departments" in {*old.columns, *new.columns}:
        counts["department_count"] = "departments"
    out = _upsert(old, new, "_id", "doi_list", ["tc_count"], [*counts, "citation_average"])
    return recount(out, counts).withColumn("citation_average", F.round(F.try_divide("tc_count", "article_count"), 6))


def merge_authors(old: DataFrame, new: DataFrame) -> DataFrame:
    """(_id, dois, categories, total_citations), all other columns of either side, and the article count."""
    out = recount(_upsert(old, new, "_id", "dois", ["total_citations"], ["article_count", "average_citations"]), {"article_count": "dois"})
    averaged = "average_citations" in {*old.columns, *new.columns}
    return out.withColumn("average_citations", F.try_divide("total_citations", "article_count")) if averaged else out


def merge_rows(old: DataFrame, old_members: DataFrame, new: DataFrame, new_members: DataFrame, gate: str, sums: list[str], key: str = "_id") -> tuple[DataFrame, DataFrame]:
    """Merged (sums, members): as the merges above, with sets held as rows (key, kind, item).

    A key of which some ``gate`` member is stored already stays as it is. No step holds a key's whole set.
    """
    stored = old_members.where(F.col("kind") == gate)
    gated = new_members.where(F.col("kind") == gate).join(stored, [key, "kind", "item"], "left_semi").select(key).distinct()
    fresh, fresh_members = new.join(gated, key, "left_anti"), new_members.join(gated, key, "left_anti")
    both = old.withColumn("_side", F.lit(0)).unionByName(fresh.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    # the stored side's value, where it has one
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_side"))).alias(c) for c in both.columns if c not in (key, "_side", *sums)]
    return both.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums], *first), old_members.unionByName(fresh_members).distinct()


def ungated_facts(facts: DataFrame, key: str, article: str, later: Column) -> DataFrame:
    """The facts that merging those with ``later`` into the others keeps, as ``merge_rows`` does; rows where it is null are in neither.

    A key of which some ``article`` is on both sides takes no later facts. Facts are dealt by key while they are rows, so that sets
    of keys need no further shuffle; a key's facts come to one task, which holds its distinct items on disk if need be.
    """
    known = facts.withColumn("_later", later).where("_later IS NOT NULL")
    sides = known.where(F.col(key).isNotNull() & F.col(article).isNotNull()).groupBy(key, article).agg(F.min("_later").alias("lo"), F.max("_later").alias("hi"))
    gated = sides.where("lo <> hi").select(key).distinct().withColumn("_gated", F.lit(True))
    return known.join(gated, key, "left").where("NOT _later OR _gated IS NULL").drop("_later", "_gated")


def recount(df: DataFrame, counts: dict[str, str]) -> DataFrame:
    """Counts from the sizes of their sets."""
    return df.withColumns({c: F.size(s).cast("long") for c, s in counts.items()})


def insert_new(old: DataFrame, new: DataFrame, key: str = "_id", order: str = "ordinal") -> DataFrame:
    """Stored rows, and of the new ones the first of every key that isn't stored."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(order))
    fresh = new.withColumn("_first", first).where("_first = 1").drop("_first").join(old.select(key), key, "left_anti")
    return old.unionByName(fresh)


def update_map(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with their key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)
