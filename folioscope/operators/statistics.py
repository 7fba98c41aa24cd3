"""Category, author and article statistics from one exploded table of facts.

A fact is one author's part in one article under one category:
(category, doi, title, tc, author, affiliation, theme, journal, ordinal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_stats(facts: DataFrame) -> DataFrame:
    """Counts and citations of every category; an article's citations count once per category.

    Facts are read once: each becomes a row per set that it belongs to, distinct items are counted per kind, and the
    citations ride on the articles' rows. Facts with a ``theme`` add ``theme_count``.
    """
    kinds = {"doi": "doi", "title": "title", "author": "author", "affiliation": "affiliation"} | ({"theme": "theme"} if "theme" in facts.columns else {})
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("item"), (F.col("tc") if kind == "doi" else F.lit(None).cast("long")).alias("tc")) for kind, c in kinds.items()])
    items = facts.select("category", F.explode(pairs).alias("m")).select("category", "m.*").where("item IS NOT NULL")
    distinct = items.groupBy("category", "kind", "item").agg(F.max("tc").alias("tc"))
    counts = {"title": "article_count", "doi": "doi_count", "author": "faculty_count", "affiliation": "department_count", "theme": "theme_count"}
    sized = [F.count_if(F.col("kind") == kind).alias(name) for kind, name in counts.items() if kind in kinds]
    return distinct.groupBy("category").agg(F.sum("tc").alias("tc_count"), *sized).withColumn("citation_average", F.round(F.try_divide(F.col("tc_count"), F.col("article_count")), 6))


def members(facts: DataFrame, key: str, kinds: dict[str, str]) -> DataFrame:
    """(key, kind, item), distinct: the sets of every key as rows; ``kinds`` names each set's column.

    A key's sets can be a large share of the corpus, so they stay rows until a writer builds arrays.
    """
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("item")) for kind, c in kinds.items()])
    return facts.select(key, F.explode(pairs).alias("m")).select(key, "m.kind", "m.item").where("item IS NOT NULL").distinct()


def member_counts(rows: DataFrame, key: str, counts: dict[str, str]) -> DataFrame:
    """(key, counts): sizes of the named sets."""
    return rows.groupBy(key).agg(*[F.count_if(F.col("kind") == kind).alias(name) for name, kind in counts.items()])


def as_arrays(rows: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    """(key, an array for each kind): the shape of stored records, for writers."""
    return rows.groupBy(key).agg(*[F.sort_array(F.collect_set(F.when(F.col("kind") == k, F.col("item")))).alias(k) for k in kinds])


def author_category_stats(facts: DataFrame, last_write: bool = False) -> DataFrame:
    """An author's citations and articles in a category: summed, or with ``last_write`` those of the last article alone."""
    each = facts.groupBy("category", "author", "doi").agg(F.max("tc").alias("tc"), F.max("ordinal").alias("ordinal"))
    if last_write:
        return each.groupBy("category", "author").agg(F.max_by("tc", "ordinal").alias("total_citations"), F.lit(1).cast("long").alias("article_count"))
    return (
        each.groupBy("category", "author").agg(F.sum("tc").alias("total_citations"), F.count("*").alias("article_count"))
        .withColumn("average_citations", F.round(F.try_divide("total_citations", "article_count"), 6))
    )


def author_stats(facts: DataFrame) -> DataFrame:
    """An author's citations, articles and categories overall; every article counts once."""
    each = facts.groupBy("author", "doi").agg(F.max("tc").alias("tc"))
    totals = each.groupBy("author").agg(F.sum("tc").alias("total_citations"), F.count("*").alias("article_count"))
    kinds = facts.groupBy("author").agg(F.collect_set("category").alias("categories"), F.collect_set("journal").alias("journals"))
    return totals.join(kinds, "author").select(
        "author", "total_citations", "article_count",
        F.round(F.try_divide("total_citations", "article_count"), 6).alias("average_citations"),
        F.sort_array("categories").alias("categories"), F.sort_array("journals").alias("journals"),
    )


def article_category(facts: DataFrame) -> DataFrame:
    """One record per category and article: sets united, scalars of the last write."""
    return facts.groupBy("category", "doi").agg(
        F.max_by("title", "ordinal").alias("title"), F.max_by("tc", "ordinal").alias("tc"), F.max_by("journal", "ordinal").alias("journal"),
        F.sort_array(F.collect_set("author")).alias("authors"), F.sort_array(F.collect_set("affiliation")).alias("affiliations"),
    )


def article_details(facts: DataFrame) -> DataFrame:
    """One record per article with its categories."""
    return facts.groupBy("doi").agg(
        F.max_by("title", "ordinal").alias("title"), F.max_by("tc", "ordinal").alias("tc"), F.max_by("journal", "ordinal").alias("journal"),
        F.sort_array(F.collect_set("author")).alias("authors"), F.sort_array(F.collect_set("category")).alias("categories"),
    )


def level_explode(articles: DataFrame) -> DataFrame:
    """Records with ``categories`` {top, mid, low} to rows of (level, category)."""
    def labelled(level: str):
        return F.transform(F.col("categories")[level], lambda c: F.struct(F.lit(level).alias("level"), c.alias("category")))

    levels = F.flatten(F.array(*[labelled(n) for n in ("top", "mid", "low")]))
    return articles.select("*", F.explode(levels).alias("at")).select(*articles.columns, "at.level", "at.category")
