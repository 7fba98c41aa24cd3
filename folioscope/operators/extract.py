"""Attributes of nested work records: a registry of named expressions, and a quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions import markup, text

_PARTS = T.StructType([T.StructField("date-parts", T.ArrayType(T.ArrayType(T.LongType())))])
_AFFILIATION = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
_LABELS = T.ArrayType(T.StringType())
#: Shape of a raw work record; keys that no expression reads aren't part of it.
WORK = T.StructType(
    [
        T.StructField("DOI", T.StringType()),
        T.StructField("title", _LABELS),
        T.StructField("abstract", T.StringType()),
        T.StructField("author", T.ArrayType(T.StructType([*(T.StructField(n, T.StringType()) for n in ("given", "family", "sequence")), T.StructField("affiliation", _AFFILIATION)]))),
        T.StructField("container-title", _LABELS),
        T.StructField("is-referenced-by-count", T.LongType()),
        T.StructField("license", T.ArrayType(T.StructType([T.StructField("URL", T.StringType())]))),
        *(T.StructField(n, _PARTS) for n in ("published", "published-print", "published-online", "created")),
        T.StructField("URL", T.StringType()),
        T.StructField("categories", T.StructType([T.StructField(n, _LABELS) for n in ("top", "mid", "low")])),
        T.StructField("themes", _LABELS),
        T.StructField("extra_context", T.StringType()),
    ]
)
EXTRACTORS: dict[str, Callable[[], Column]] = {}


def extractor(name: str):
    """Register an attribute under ``name``."""

    def add(build: Callable[[], Column]):
        EXTRACTORS[name] = build
        return build

    return add


def attributes(works: DataFrame, names: list[str]) -> DataFrame:
    """One column per attribute; an attribute that a record lacks is null. Unknown names raise."""
    if unknown := [n for n in names if n not in EXTRACTORS]:
        raise KeyError(f"no such attribute: {unknown}")
    return works.select(*[EXTRACTORS[n]().alias(n) for n in names])


def full_name(author: Column) -> Column:
    return F.concat_ws(" ", author["given"], author["family"])


def complete(author: Column) -> Column:
    """Whether an author has both names and a place in the sequence."""
    return author["given"].isNotNull() & author["family"].isNotNull() & author["sequence"].isNotNull()


def known_authors() -> Column:
    return F.filter(F.coalesce(F.col("author"), F.array().cast(WORK["author"].dataType)), complete)


def quarantined(works: DataFrame) -> DataFrame:
    """(DOI, author, error_id): authors without both names or a place in the sequence; the id is random and no key."""
    return works.select("DOI", F.explode(F.filter("author", lambda a: ~complete(a))).alias("author")).withColumn("error_id", F.uuid())


def _names(kind: str) -> Column:
    return F.transform(F.filter(known_authors(), lambda a: a["sequence"] == kind), full_name)


@extractor("title")
def _title() -> Column:
    stripped = F.transform("title", lambda t: text.strip_tags(t))
    return F.when(F.size(F.filter(stripped, lambda t: t != "")) > 0, stripped)


@extractor("abstract")
def _abstract() -> Column:
    return F.nullif(markup.to_markdown(F.col("abstract")), F.lit(""))


@extractor("authors")
def _authors() -> Column:
    """The first author, then the others; an empty name where nobody is first, the last where several are."""
    return F.concat(F.array(F.coalesce(F.try_element_at(_names("first"), F.lit(-1)), F.lit(""))), _names("additional"))


@extractor("affiliations")
def _affiliations() -> Column:
    """Author -> names of affiliations; of equal names the last record's stay."""
    names = F.transform(known_authors(), full_name)
    places = F.transform(known_authors(), lambda a: F.transform(F.coalesce(a["affiliation"], F.array().cast(_AFFILIATION)), lambda p: p["name"]))
    return F.map_from_arrays(names, places)


#: Of a record without categories: empty lists at every level.
NO_CATEGORIES = "named_struct('top', CAST(array() AS array<string>), 'mid', CAST(array() AS array<string>), 'low', CAST(array() AS array<string>))"
for _name, _path in {"categories": "categories", "themes": "themes"}.items():
    extractor(_name)(lambda p=_path: F.coalesce(F.col(p), F.array().cast(_LABELS) if p == "themes" else F.expr(NO_CATEGORIES)))
extractor("extra_context")(lambda: F.col("extra_context"))
extractor("citations")(lambda: F.coalesce(F.col("is-referenced-by-count"), F.lit(0)))
extractor("license")(lambda: F.nullif(F.get("license", 0)["URL"], F.lit("")))
extractor("journal")(lambda: F.nullif(F.get("`container-title`", 0), F.lit("")))
extractor("url")(lambda: F.nullif(F.col("URL"), F.lit("")))
extractor("doi")(lambda: F.nullif(F.col("DOI"), F.lit("")))
for _name, _path in {"published_print": "published-print", "published_online": "published-online", "created": "created"}.items():
    extractor(_name)(lambda p=_path: text.date_of(F.col(f"`{p}`")["date-parts"]))


def published_between(start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Published from (year, month) to (year, month); on a boundary year the month has to be there."""
    first = F.get(F.col("published")["date-parts"], 0)
    year, month = F.get(first, 0), F.get(first, 1)
    low = (year > start[0]) | ((year == start[0]) & month.isNotNull() & (month >= start[1]))
    high = (year < end[0]) | ((year == end[0]) & month.isNotNull() & (month <= end[1]))
    return F.coalesce(low & high, F.lit(False))


def affiliated_with(phrase: str) -> Column:
    """Some author's affiliation contains the phrase, in any case."""
    return F.coalesce(F.exists("author", lambda a: F.exists(a["affiliation"], lambda p: F.contains(F.lower(p["name"]), F.lit(phrase.lower())))), F.lit(False))


def new_works(works: DataFrame, stored: DataFrame, key: str = "DOI", stored_key: str = "_id") -> DataFrame:
    """Works with a key that isn't stored yet."""
    return works.where(F.col(key).isNotNull()).join(stored.select(F.col(stored_key).alias(key)), key, "left_anti")


def inject(works: DataFrame, results: DataFrame, key: str = "DOI") -> DataFrame:
    """Categories and themes of a classification put into the records."""
    kept = works.drop("categories", "themes")
    return kept.join(results.select(key, F.struct("top", "mid", "low").alias("categories"), "themes"), key, "left")


def general_info(works: DataFrame, prefix: str = "https://doi.org/") -> DataFrame:
    """(title, journal, citations, address): a record's general information, its key as an address."""
    named = attributes(works, ["title", "journal", "citations", "doi"])
    return named.select(F.get("title", 0).alias("title"), "journal", "citations", F.concat(F.lit(prefix), "doi").alias("address"))


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as flat columns."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here))

    return df.select(*leaves(df.schema, ()))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Columns with a value in some row, found in one aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])


def observed_counts(df: DataFrame, kinds: dict[str, Column], name: str = "warnings") -> tuple[DataFrame, Observation]:
    """``df`` as it is, and an observation that counts the rows of every kind while ``df`` is written, in the same pass.

    The counts are there when an action on the returned frame has ended. On a stream, give ``name`` alone to
    ``stream_counts``: observations of a stream arrive with its progress.
    """
    seen = Observation(name)
    return df.observe(seen, *_counters(kinds)), seen


def stream_counts(df: DataFrame, kinds: dict[str, Column], name: str = "warnings") -> DataFrame:
    """A stream whose progress events carry the counts of every kind under ``name`` (``observedMetrics``), batch by batch."""
    return df.observe(name, *_counters(kinds))


def _counters(kinds: dict[str, Column]) -> list[Column]:
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(kind) for kind, c in kinds.items()]


def extracted_lists(df: DataFrame, key: str, lists: dict[str, str]) -> DataFrame:
    """(key, list, item): the non-null values of each named column, or the elements of each named array, as rows without a shuffle."""
    kinds = dict(df.dtypes)

    def tagged(name: str, column: str):
        items = F.col(f"`{column}`")
        items = items.cast("array<string>") if kinds[column].startswith("array") else F.array(items.cast("string"))
        return F.coalesce(F.transform(items, lambda x: F.struct(F.lit(name).alias("list"), x.alias("item"))), F.array().cast("array<struct<list:string,item:string>>"))

    return df.select(key, F.explode(F.flatten(F.array(*[tagged(name, c) for name, c in lists.items()]))).alias("m")).select(key, "m.list", "m.item").where("item IS NOT NULL")
