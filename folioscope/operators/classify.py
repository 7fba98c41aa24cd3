"""Hierarchical classification with a pluggable client, one per partition.

The client is any object with ``choose(text, level, parent, options, banned) -> list[str]``. The
default one is deterministic and offline: it picks the options whose words the text has. The chain
around it (summary, themes, top to low recursion, validation, retries) is the same for any client.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RETRIES = 3
_STRINGS = T.ArrayType(T.StringType())
RESULT = T.StructType([*(T.StructField(n, _STRINGS) for n in ("top", "mid", "low", "themes")), T.StructField("error", T.StringType())])


class KeywordClient:
    """Options that share the most words with the text; the first one where none does."""

    def choose(self, text: str, level: str, parent: str | None, options: list[str], banned: frozenset[str]) -> list[str]:
        words = set(re.findall(r"\w+", text.lower()))
        scores = {o: len(words & set(re.findall(r"\w+", o.lower()))) for o in options if o not in banned}
        best = max(scores.values(), default=0)
        return [o for o, s in scores.items() if s == best and s] or sorted(scores)[:1]

    def themes(self, text: str) -> list[str]:
        words = re.findall(r"[^\W\d_]{6,}", text.lower())
        return [w for w, _ in sorted(Counter(words).items(), key=lambda x: (-x[1], x[0]))[:5]]


def validated(client, text: str, level: str, parent: str | None, options: list[str]) -> list[str]:
    """The client's choice, asked again without invalid labels; ValueError when it never gives valid ones."""
    banned: frozenset[str] = frozenset()
    for _ in range(RETRIES):
        chosen = client.choose(text, level, parent, options, banned)
        invalid = [c for c in chosen if c not in options]
        if chosen and not invalid:
            return list(dict.fromkeys(chosen))
        banned |= frozenset(invalid)
    raise ValueError(f"no valid {level} label below {parent}")


def classify_text(client, text: str, tree: dict[str, dict[str, list[str]]]) -> dict:
    out: dict = {"top": validated(client, text, "top", None, list(tree)), "mid": [], "low": []}
    for top in out["top"]:
        mids = validated(client, text, "mid", top, list(tree[top]))
        out["mid"] += mids
        for mid in mids:
            out["low"] += validated(client, text, "low", mid, tree[top][mid])
    out["low"] = list(dict.fromkeys(out["low"]))
    return out | {"themes": client.themes(text), "error": None}


def classify(df: DataFrame, text: str, taxonomy: dict[str, dict[str, list[str]]], make_client: Callable = KeywordClient) -> DataFrame:
    """``df`` with a struct ``classification``; a failed row has its ``error`` set and is kept for the caller to filter."""

    @F.pandas_udf(RESULT)
    def run(batches: pd.Series) -> pd.DataFrame:
        client, rows = make_client(), []
        for t in batches:
            try:
                if not t:
                    raise ValueError("no text")
                rows.append(classify_text(client, t, taxonomy))
            except ValueError as failed:
                rows.append({"error": str(failed)})
        return pd.DataFrame(rows, columns=RESULT.names).astype(object).where(lambda x: x.notna(), None)

    return df.withColumn("classification", run(F.col(text)))


def label_rows(results: DataFrame, key: str, tree: Column) -> DataFrame:
    """(key, parent, label, level) rows of nested results ``map<top, map<mid, array<low>>>``."""
    tops = results.select(key, F.explode(tree).alias("top", "mids"))
    mids = tops.select(key, "top", F.explode("mids").alias("mid", "lows"))
    lows = mids.select(key, "top", "mid", F.explode("lows").alias("low"))
    return (
        tops.select(key, F.lit("").alias("parent"), F.col("top").alias("label"), F.lit("top").alias("level"))
        .union(mids.select(key, "top", "mid", F.lit("mid")))
        .union(lows.select(key, F.concat_ws("/", "top", "mid"), "low", F.lit("low")))
    )


def collected(classifications: Column) -> Column:
    """All categories of a list of {categories: [...]} results, in order."""
    return F.flatten(F.transform(classifications, lambda c: c["categories"]))
