"""HTML and JATS parsing, text folding and matching ratios: Arrow-batched UDFs on the standard library."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.latex import latex_to_text
from folioscope.functions.pagetree import PageTree

# Where abstracts are found on publisher pages, meta names and division classes, in order.
META_NAMES = ("citation_abstract", "description", "og:description")
DIVISION_CLASSES = ("abstract", "article-abstract", "summary")


def candidates(markup: str | None, page: PageTree | None = None) -> list[str]:
    """Texts that may be a page's abstract, most telling kind first."""
    page = page or PageTree(markup)
    named: dict[str, list[str]] = {}
    for e in page.elements:
        if e.tag == "meta":
            named.setdefault((e.attributes.get("name") or "").lower(), []).append(e.attributes.get("content") or "")
    metas = [x for name in META_NAMES for x in named.get(name, [])]
    paragraphs = [x for x in page.texts("p") if "abstract" in x.lower()]
    classed = [(set((e.attributes.get("class") or "").lower().split()), e) for e in page.elements if e.tag == "div" and e.attributes.get("class")]
    divisions = [page.text(e) for name in DIVISION_CLASSES for names, e in classed if name in names]
    return [x for x in [*metas, *paragraphs, *divisions, *page.texts("article"), *page.texts("span")] if x]


def markdown(markup: str | None) -> str | None:
    """Titled sections as headings with their paragraphs; without sections the paragraphs alone, and without those the text."""
    if not markup:
        return None
    lines, page = [], PageTree(markup)
    sectioned = any(e.tag.removeprefix("jats:") == "sec" for e in page.elements)
    for e in page.elements:
        tag = e.tag.removeprefix("jats:")
        if tag in ("title", "p") and (text := page.text(e)) and (tag == "p" or sectioned):
            lines.append(text if tag == "p" else f"## {text.rstrip(':')}:")
    return "\n".join(lines) or page.text() or None


@F.pandas_udf(T.StringType())
def to_markdown(markup: pd.Series) -> pd.Series:
    return markup.map(markdown, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def abstract_candidates(markup: pd.Series) -> pd.Series:
    return markup.map(candidates)


def page_record(markup: str | None) -> dict:
    """A page as {page_content, extra_context}: its candidates as paragraphs, and the named metas (or the title) beside them."""
    context, page = {}, PageTree(markup)
    for e in page.elements:
        if e.tag == "meta" and e.attributes.get("name") and e.attributes.get("content"):
            context.setdefault(e.attributes["name"].lower(), e.attributes["content"])
        elif e.tag == "title" and (text := page.text(e)):
            context.setdefault("title", text)
    return {"page_content": "\n\n".join(dict.fromkeys(candidates(markup, page))), "extra_context": context or {"title": ""}}


@F.pandas_udf(T.StructType([T.StructField("page_content", T.StringType()), T.StructField("extra_context", T.MapType(T.StringType(), T.StringType()))]))
def page_records(markup: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_record(x) for x in markup], columns=["page_content", "extra_context"])


# Letters by their Unicode names.
LETTERS = {
    "AE": "ae", "OE": "oe", "SHARP S": "ss", "ETH": "d", "THORN": "th", "DOTLESS I": "i", "DOTLESS J": "j", "ENG": "ng", "KRA": "q", "LONG S": "s",
    "ALPHA": "a", "BETA": "b", "GAMMA": "g", "DELTA": "d", "EPSILON": "e", "ZETA": "z", "ETA": "e", "THETA": "th", "IOTA": "i", "KAPPA": "k",
    "LAMDA": "l", "MU": "m", "NU": "n", "XI": "x", "OMICRON": "o", "PI": "p", "RHO": "r", "SIGMA": "s", "FINAL SIGMA": "s", "TAU": "t", "UPSILON": "u",
    "PHI": "ph", "CHI": "kh", "PSI": "ps", "OMEGA": "o",
    "A": "a", "BE": "b", "VE": "v", "GHE": "g", "DE": "d", "IE": "e", "ZHE": "zh", "ZE": "z", "I": "i", "SHORT I": "i", "KA": "k", "EL": "l", "EM": "m",
    "EN": "n", "O": "o", "PE": "p", "ER": "r", "ES": "s", "TE": "t", "U": "u", "EF": "f", "HA": "kh", "TSE": "ts", "CHE": "ch", "SHA": "sh",
    "SHCHA": "shch", "HARD SIGN": "", "YERU": "y", "SOFT SIGN": "", "E": "e", "YU": "yu", "YA": "ya", "IO": "io", "UKRAINIAN IE": "ie", "YI": "yi", "BYELORUSSIAN-UKRAINIAN I": "i",
}
LETTER_NAME = re.compile(r"(?:LATIN|GREEK|CYRILLIC) (SMALL|CAPITAL) (?:LETTER|LIGATURE) (.+?)(?: WITH .+)?")


def ascii_of(character: str) -> str:
    """ASCII form of one character: base letters without accents and strokes, spelled letters, plain dashes and quotes; nothing where there is none."""
    plain = unicodedata.normalize("NFKD", character).encode("ascii", "ignore").decode()
    if plain or character.isascii():
        return plain
    base = unicodedata.normalize("NFD", character)[0]
    kind, name = unicodedata.category(base), unicodedata.name(base, "")
    if found := LETTER_NAME.fullmatch(name):
        spelled = LETTERS.get(found[2], found[2].lower() if len(found[2]) == 1 else "")
        return spelled.capitalize() if found[1] == "CAPITAL" else spelled
    if kind == "Pd":
        return "--" if name == "EM DASH" else "-"
    if kind in ("Pi", "Pf"):
        return "'" if "SINGLE" in name else '"' if "QUOTATION MARK" in name and "DOUBLE" in name else "<<" if "LEFT" in name else ">>"
    return {"EURO SIGN": "EUR", "BULLET": "*", "MIDDLE DOT": "*", "MULTIPLICATION SIGN": "x", "DEGREE SIGN": "deg"}.get(name, "")


class _Ascii(dict):
    """Code point -> ASCII form, found when first asked for."""

    def __missing__(self, code: int) -> str:
        self[code] = found = ascii_of(chr(code))
        return found


ASCII = _Ascii()


@F.pandas_udf(T.StringType())
def ascii_fold(text: pd.Series) -> pd.Series:
    """ASCII form of a text."""
    return text.map(lambda x: x if x.isascii() else x.translate(ASCII), na_action="ignore")


@F.pandas_udf(T.StringType())
def latex_text(text: pd.Series) -> pd.Series:
    """LaTeX source as plain text."""
    return text.map(latex_to_text, na_action="ignore")


@F.pandas_udf(T.DoubleType())
def match_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Twice the matched characters over all characters, in percent."""
    return pd.Series([None if a is None or b is None else round(100 * SequenceMatcher(None, a, b, autojunk=False).ratio()) for a, b in zip(left, right)], dtype="float64")
