"""Text expressions: Column in, Column out, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_path(value: Column) -> Column:
    """Percent-encoded path; slashes and tildes stay, spaces become %20."""
    out = F.url_encode(value)
    for code, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return out


def encode_once(value: Column) -> Column:
    """``url_path`` of values that aren't encoded already."""
    decoded = F.try_url_decode(value)
    return F.when(url_path(decoded) == value, value).otherwise(url_path(value))


def normal_id(parts: Column) -> Column:
    """Parts of a name in lower case with hyphens for spaces, joined by underscores."""
    return F.rtrim(F.array_join(F.transform(parts, lambda p: F.replace(F.lower(p), F.lit(" "), F.lit("-"))), "_"), F.lit("_"))


def name_form(value: Column) -> Column:
    """Lower case without spaces: the key under which spellings of a name meet."""
    return F.replace(F.lower(value), F.lit(" "), F.lit(""))


def regularise(value: Column) -> Column:
    """Lower case without anything but letters, digits and underscores of any script."""
    return F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}_]+", "")


def clean(value: Column) -> Column:
    """Lower case, ASCII punctuation dropped, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(value), r"[!-/:-@\[-`{-~]", ""), r"\s+", " "))


def sentence_case(value: Column) -> Column:
    """First letter a capital, the rest small."""
    return F.concat(F.upper(F.substring(value, 1, 1)), F.lower(F.substring(value, 2, 1 << 30)))


def soften_capitals(value: Column) -> Column:
    """Texts all in capitals become title case."""
    return F.when(value == F.upper(value), F.initcap(value)).otherwise(value)


def strip_tags(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, "<[^>]+>", ""))


def shorten(value: Column, length: int = 30) -> Column:
    return F.concat(F.substring(value, 1, length), F.lit("..."))


def word_counts(value: Column) -> Column:
    """Words, tokens (three quarters of the words) and characters."""
    words = F.size(F.filter(F.split(value, r"\s+"), lambda w: w != "")).cast("long")
    return F.struct(words.alias("words"), (words * 0.75).alias("tokens"), F.length(value).cast("long").alias("chars"))


def ngrams(value: Column, size: int) -> Column:
    """Distinct character n-grams; a shorter text is its own only n-gram, an empty one has none."""
    parts = F.transform(F.sequence(F.lit(1), F.length(value) - size + 1), lambda i: F.substr(value, i, F.lit(size)))
    return F.when(F.length(value) >= size, F.array_distinct(parts)).when(F.length(value) > 0, F.array(value)).otherwise(F.array().cast("array<string>"))


def date_of(parts: Column) -> Column:
    """``2021-6`` or ``2021-6-13`` from [[2021, 6, ...]]; null without parts."""
    first = F.get(parts, 0)
    return F.when(F.size(first) > 0, F.array_join(F.transform(first, lambda p: p.cast("string")), "-"))


def parse_date(value: Column) -> Column:
    """Dates with or without a day and leading zeros."""
    return F.coalesce(F.try_to_date(value, "y-M-d"), F.try_to_date(value, "y-M"), F.try_to_date(value, "y"))


def month_end(year: Column, month: Column) -> Column:
    return F.last_day(F.make_date(year, month, F.lit(1)))


def person_key(value: Column) -> Column:
    """``last|initial`` of ``Last, First`` or ``First Last``, lower case."""
    comma = F.instr(value, ",") > 0
    last = F.when(comma, F.trim(F.split_part(value, F.lit(","), F.lit(1)))).otherwise(F.element_at(F.split(F.trim(value), r"\s+"), -1))
    first = F.when(comma, F.trim(F.split_part(value, F.lit(","), F.lit(2)))).otherwise(F.element_at(F.split(F.trim(value), r"\s+"), 1))
    return F.lower(F.concat_ws("|", last, F.substring(first, 1, 1)))


def edit_ratio(a: Column, b: Column) -> Column:
    """Similarity of two texts in percent, from the edit distance and the longer length."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(F.round(100 * (1 - F.levenshtein(a, b) / longest), 2))


def first_part(value: Column, separator: str = ",") -> Column:
    """What stands before the first separator."""
    return F.trim(F.split_part(value, F.lit(separator), F.lit(1)))


def clamped(value: Column, low: float, factor: float = 1) -> Column:
    """``value`` times ``factor``, ``low`` at least."""
    return F.greatest(value * factor, F.lit(low))


def safe_ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.coalesce(F.round(F.try_divide(part, whole), digits), F.lit(0.0))


# Shapes of citations, tried in this order; the first group is the title.
CITATIONS = (
    r"\(\d{4}\)\.\s*(.*?)\.\s*(?:[A-Z][a-z]+\s+)+",  # before a journal's capitalised words
    r"\(\d{4}\)\.\s*(.*?)\.\s*(?:https?://|www\.|\[|$)",  # before an address, a note or the end
    r"\(\d{4}\)\.\s*([A-Z\s]+)\.",  # all capitals
    r"\(\d{4}\)\.\s*(.*?)\.",
    r"\(in press\)\.\s*(.*?)\.",
)


def citation_title(value: Column) -> Column:
    """Title of a citation: bracketed notes and addresses dropped, then the first shape that matches; capitals are softened."""
    bare = F.regexp_replace(F.regexp_replace(value, r"\[[^\]]*\]", ""), r"https?://\S+", "")
    return soften_capitals(F.coalesce(*[F.nullif(F.trim(F.regexp_extract(bare, shape, 1)), F.lit("")) for shape in CITATIONS]))


def tagged_abstract(record: Column) -> Column:
    """Abstract of a tagged text record."""
    return F.nullif(F.regexp_extract(record, r"(?s)AB\s(.+?)(?=\nC1)", 1), F.lit(""))


def tagged_record(authors: Column, title: Column, abstract: Column) -> Column:
    """A tagged text record of the given fields."""
    lines = [F.lit("PT J"), F.concat(F.lit("AU "), F.array_join(authors, "\n   ")), F.concat(F.lit("TI "), F.coalesce(title, F.lit("No title"))), F.concat(F.lit("AB "), F.coalesce(abstract, F.lit("No abstract"))), F.lit("ER")]
    return F.concat_ws("\n", *lines)
