"""Complete stored records: articles, authors and categories with all their sets at the three levels of the taxonomy.

All functions read ``works``, a row per article, author, affiliation and place in the taxonomy:
(doi, title, tc, journal, abstract, license_url, date_published_print, date_published_online, download_url, themes,
author, affiliation, top, mid, low). ``themes`` is an array; the fields of an article are the same in all its rows.

Sets of authors and categories can be a large share of the corpus, so they are rows (key, kind, item). Those of an
article are bounded by its source record and become arrays. Null authors, labels, themes and other items are no members of
a set; a key without members has no rows. Rows without an author, label or DOI give no author, category or article.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import text
from folioscope.operators.taxonomy import LEVELS

ARTICLE_FIELDS = ("title", "tc", "journal", "abstract", "license_url", "date_published_print", "date_published_online", "download_url")


#: (kind, column) of the sets; ``themes`` is last, as its column is an array. Urls follow from distinct labels (``URLS``).
AUTHOR_KINDS = [
    ("titles", "title"), ("dois", "doi"), ("department_affiliations", "affiliation"), ("journals", "journal"),
    *[(f"{level}_level_categories", level) for level in LEVELS], *[("categories", level) for level in LEVELS], ("themes", "themes"),
]
CATEGORY_KINDS = [("faculty", "author"), ("departments", "affiliation"), ("titles", "title"), ("doi_list", "doi"), ("themes", "themes")]
URLS = {"categories": "category_urls", **{f"{level}_level_categories": f"{level}_category_urls" for level in LEVELS}}


def _named(names: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), number + 1)


def _members(rows: DataFrame, keys: list[str], kinds: list[tuple[str, str]], article: str) -> DataFrame:
    """(keys, kind, item, tc): distinct items; citations ride on the articles' own.

    Items are exploded by place and kinds are numbers until they are distinct, so a row costs no lambda and no kind's name.
    """
    names = list(dict.fromkeys(kind for kind, _ in kinds))
    items = F.concat(F.array(*[F.col(c).cast("string") for _, c in kinds[:-1]]), F.coalesce(kinds[-1][1], F.array().cast("array<string>")))
    number = F.element_at(F.array(*[F.lit(names.index(kind)) for kind, _ in kinds]), F.least("place", F.lit(len(kinds) - 1)) + 1)
    found = rows.select(*keys, "tc", F.posexplode(items).alias("place", "item")).where("item IS NOT NULL").withColumn("number", number)
    cited = F.when(F.col("number") == names.index(article), F.col("tc")).alias("tc")
    distinct = found.select(*keys, "number", "item", cited).groupBy(*keys, "number", "item").agg(F.max("tc").alias("tc"))
    return distinct.select(*keys, _named(names, F.col("number")).alias("kind"), "item", "tc")


def _author_members(works: DataFrame) -> DataFrame:
    return _members(works.where("author IS NOT NULL"), ["author"], AUTHOR_KINDS, "dois")


def _by_label(works: DataFrame) -> DataFrame:
    """A row of ``works`` per level, as (level, category)."""
    rows = works.select("doi", "title", "tc", "author", "affiliation", "themes", F.posexplode(F.array(*LEVELS)).alias("at", "category"))
    return rows.where("category IS NOT NULL").withColumn("level", _named(LEVELS, F.col("at"))).drop("at")


def author_sets(works: DataFrame) -> DataFrame:
    """(author, kind, item): an author's thirteen sets as rows. Different labels have different urls, so these need no grouping."""
    kind = F.col("kind")
    of_label = F.struct(F.element_at(F.create_map(*[F.lit(x) for pair in URLS.items() for x in pair]), kind).alias("kind"), text.url_path(F.col("item")).alias("item"))
    own = F.struct("kind", "item")
    each = F.when(kind.isin(*URLS), F.array(own, of_label)).otherwise(F.array(own))
    return _author_members(works).select("author", F.explode(each).alias("m")).select("author", "m.*")


def author_records(works: DataFrame) -> DataFrame:
    """An author's totals, each article once, and the size of each set; the sets themselves are ``author_sets``."""
    kinds = {kind: kind for kind, _ in AUTHOR_KINDS if kind != "dois"} | {url: kind for kind, url in URLS.items()}
    sizes = [F.count_if(F.col("kind") == kind).alias(f"{name}_count") for name, kind in kinds.items()]
    totals = _author_members(works).groupBy("author").agg(F.sum("tc").alias("total_citations"), F.count_if(F.col("kind") == "dois").alias("article_count"), *sizes)
    return totals.withColumn("average_citations", F.round(F.try_divide("total_citations", "article_count"), 6))


def category_sets(works: DataFrame) -> DataFrame:
    """(level, category, kind, item): the sets of every category at its level, as rows."""
    return _members(_by_label(works), ["level", "category"], CATEGORY_KINDS, "doi_list").drop("tc")


def category_records(works: DataFrame) -> DataFrame:
    """A category's record at its level: name, url, counts, citations and their average per article title."""
    counts = {"faculty": "faculty_count", "departments": "department_count", "titles": "article_count", "doi_list": "doi_count", "themes": "theme_count"}
    sized = _members(_by_label(works), ["level", "category"], CATEGORY_KINDS, "doi_list").groupBy("level", "category").agg(
        F.sum("tc").alias("tc_count"), *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in counts.items()]
    )
    return sized.withColumns({"url": text.url_path(F.col("category")), "citation_average": F.round(F.try_divide("tc_count", "article_count"), 6)})


def articles(works: DataFrame) -> DataFrame:
    """A row per article of ``works``: (doi, fields, themes, people, top, mid, low), of which ``themes`` and the levels may hold items twice.

    ``people`` are structs that begin with (author, affiliation). One shuffle by article and one grouping, of plain rows.
    """
    rows = works.where("doi IS NOT NULL").select("doi", *ARTICLE_FIELDS, "themes", F.struct("author", "affiliation", *LEVELS).alias("person"))
    whole = rows.repartition("doi").groupBy("doi").agg(
        *[F.max(c).alias(c) for c in ARTICLE_FIELDS], F.flatten(F.collect_set("themes")).alias("themes"), F.collect_set("person").alias("people")
    )
    return whole.select("*", *[F.col("people")[level].alias(level) for level in LEVELS])


def _distinct(items: Column) -> Column:
    """The sorted items without nulls; all of it is compiled, unlike ``array_compact``."""
    return F.sort_array(F.array_except(items, F.array(F.lit(None).cast("string"))))


def _by_author(people: Column, starts: Column) -> Column:
    """The map from authors to affiliations: each author is a slice of the sorted people, so that the work is linear in their number. Both must be columns."""

    def entry(at: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(people))
        return F.struct(F.get(people, at)["author"].alias("author"), _distinct(F.slice(people, at + 1, end - at)["affiliation"]).alias("affiliations"))

    return F.map_from_entries(F.transform(starts, entry))


def records_of(articles: DataFrame) -> DataFrame:
    """The record of 22 fields of each of ``articles`` (``doi`` is also its ``_id``); sets are sorted arrays, ``faculty_affiliations`` a map."""
    people, starts = F.col("people"), F.col("starts")
    sets = {f"{level}_level_categories": _distinct(F.col(level)) for level in LEVELS} | {"themes": _distinct(F.col("themes"))}
    whole = articles.withColumns(sets | {"people": F.sort_array("people")}).drop(*LEVELS)
    start = F.transform(people, lambda p, at: F.when(p["author"].isNotNull() & ~p["author"].eqNullSafe(F.get(people, at - 1)["author"]), at))
    levels = [F.col(f"{level}_level_categories") for level in LEVELS]
    urls = {f"{level}_category_urls": F.sort_array(F.transform(labels, text.url_path)) for level, labels in zip(LEVELS, levels)}
    named = whole.withColumn("starts", F.array_compact(start)).withColumns({
        "faculty_members": _distinct(people["author"]), "faculty_affiliations": _by_author(people, starts), "categories": F.sort_array(F.array_distinct(F.concat(*levels))),
        "_id": F.col("doi"), "url": text.url_path(F.col("doi").cast("string")),
    } | urls)
    return named.withColumnRenamed("tc", "tc_count").withColumn("category_urls", F.sort_array(F.array_distinct(F.concat(*urls)))).drop("people", "starts")


def article_records(works: DataFrame) -> DataFrame:
    """``records_of`` the articles of ``works``."""
    return records_of(articles(works))


def category_articles(works: DataFrame, shape: Callable[[DataFrame], DataFrame] = lambda whole: whole) -> DataFrame:
    """``under_categories`` of the articles of ``works``."""
    return under_categories(articles(works), shape)


def under_categories(articles: DataFrame, shape: Callable[[DataFrame], DataFrame] = lambda whole: whole) -> DataFrame:
    """The articles' records under each of their categories, at any level; built once per article, and so is what ``shape`` makes of them."""
    shaped = shape(records_of(articles).withColumn("category", F.col("categories")))
    return shaped.withColumn("category", F.explode("category"))


def affiliation_rollup(works: DataFrame, part_of: str, per_author: bool = False) -> DataFrame:
    """(affiliation, article_count, total_citations) of affiliations that contain ``part_of`` but aren't it.

    An article counts once per affiliation; with ``per_author`` once for each of its authors there.
    """
    name = F.col("affiliation")
    rows = works.where(F.contains(name, F.lit(part_of)) & (name != part_of))
    each = rows.groupBy("affiliation", "doi", *["author"] * per_author).agg(F.max("tc").alias("tc"))
    return each.groupBy("affiliation").agg(F.count("*").alias("article_count"), F.sum("tc").alias("total_citations"))


def outer_join(left: DataFrame, right: DataFrame, on: list[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join by name: columns of both sides get the sides' suffixes, null keys meet each other.

    Names are compared as Spark does, without regard to case. A suffix that makes a name anew raises ValueError.
    """
    keys = {c.lower() for c in on}
    both = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - keys

    def out(columns: list[str], suffix: str) -> dict[str, str]:
        return {c: c + suffix if c.lower() in both else c for c in columns if c.lower() not in keys}

    from_left, from_right = out(left.columns, suffixes[0]), out(right.columns, suffixes[1])
    names = [n.lower() for n in [*on, *from_left.values(), *from_right.values()]]
    if len(set(names)) < len(names):
        raise ValueError(f"columns named twice: {sorted({n for n in names if names.count(n) > 1})}")
    a, b = left.alias("a"), right.alias("b")
    same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in on]
    condition = same[0]
    for more in same[1:]:
        condition &= more
    return a.join(b, condition, "full_outer").select(
        *[F.coalesce(F.col(f"a.`{c}`"), F.col(f"b.`{c}`")).alias(c) for c in on],
        *[F.col(f"a.`{c}`").alias(n) for c, n in from_left.items()], *[F.col(f"b.`{c}`").alias(n) for c, n in from_right.items()],
    )
