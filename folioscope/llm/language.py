"""Language identification by rank-order profiles of character n-grams.

Training counts n-grams (1 to 3 characters of lower-cased words with their boundaries) over all
labelled documents; a language's profile is its most frequent n-grams in order. A document's own
most frequent n-grams are ranked the same way and compared to each profile by the out-of-place
distance: the sum of rank differences, with a fixed one for n-grams that the profile lacks.

Defined results: null text, empty text and text without a letter give ``und`` and score 0; ties in counts go by
the n-gram's code, ties in distance to the language that sorts first; without training rows every
text is ``und``; an empty table gives no rows. Rows with a null language aren't trained on; repeated rows count once
each. A very long text is counted whole, at about 60 bytes of memory a character. Workers get the profiles of
about ``LANGUAGES`` languages at once; with more languages, the documents pass through one block of profiles
after another and keep the nearest. Extra columns are carried along; an output replaces a column of its name.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioscope.llm.common import fields, make_room, settle, table

#: n-grams of a profile, in a language and in a document.
PROFILE = 400
#: Languages whose profiles a worker holds at once, on average.
LANGUAGES = 1_000
#: Distinct n-grams of a language that a training task holds before it passes its counts on, and n-grams that it counts at once.
HELD, AT_ONCE = 400_000, 400_000
UND = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text (21 bits a character), empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    c = np.zeros(len(codes) + 2, np.int64)
    c[1:-1] = np.where(letter, codes, 0)
    is_letter = c > 0
    two = c[:-1] << 21 | c[1:]
    pairs = two[is_letter[:-1] | is_letter[1:]]
    three = (two[:-1] << 21 | c[2:])[is_letter[1:-1]]
    return np.concatenate([c[is_letter], pairs | 1 << 62, three])


def ranked(text: str | None, size: int = PROFILE) -> np.ndarray:
    """A text's most frequent n-grams, in order."""
    grams, counts = np.unique(ngrams(text), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:size]]


def _count(batches):
    """Counts of n-grams per language, summed within the task."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows(lang):
        grams, counts = held.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    def add(lang, found):
        grams, counts = np.unique(np.concatenate(found), return_counts=True)
        if lang in held:
            grams, at = np.unique(np.concatenate([held[lang][0], grams]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([held[lang][1], counts]), len(grams)).astype(np.int64)
        held[lang] = grams, counts

    parts: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = ngrams(text.as_py())
            parts.setdefault(lang, []).append(found)
            sizes[lang] = sizes.get(lang, 0) + len(found)
            if sizes[lang] > AT_ONCE:
                add(lang, parts.pop(lang))
                sizes[lang] = 0
                if len(held[lang][0]) > HELD:
                    yield rows(lang)
    for lang, found in parts.items():
        add(lang, found)
    for lang in list(held):
        yield rows(lang)


def train_profiles(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE) -> DataFrame:
    """(lang, gram, rank) of the ``size`` most frequent n-grams of every language, over all rows."""
    labelled = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = labelled.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "gram", "rank")


class Profiles:
    """Rank matrix of all languages' n-grams."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.languages = sorted({lang for lang, _, _ in rows})
        self.size = size
        self.grams = np.array(sorted({gram for _, gram, _ in rows}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int64)
        column = {lang: i for i, lang in enumerate(self.languages)}
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank - 1

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.size)
        if not len(own) or not self.languages:
            return UND, 0.0
        at = np.searchsorted(self.grams, own)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != own] = len(self.grams)
        ranks = self.ranks[at]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(0)
        best = int(distance.argmin())
        return self.languages[best], 1.0 - float(distance[best]) / (len(own) * self.size)


def predict_language(docs: DataFrame, profiles: DataFrame, text: str = "text", size: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (1: the document's order equals the profile's, 0: nothing in common)."""
    docs = make_room(docs, "lang_pred", "score")
    n_blocks = max(1, -(-profiles.select("lang").distinct().count() // LANGUAGES))
    at, out = docs.columns.index(text), docs.select("*", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = T.StructType([*docs.schema.fields, *fields("lang_pred string, score double").fields])
    for b in range(n_blocks):
        rows = profiles.where(F.pmod(F.xxhash64("lang"), F.lit(n_blocks)) == b).collect()  # one block of languages
        model = docs.sparkSession.sparkContext.broadcast(Profiles([tuple(r) for r in rows], size))
        out = out.mapInArrow(_nearest(model, at), schema)
    return out


def _nearest(model, at: int):
    """One block of profiles: the predictions so far, or nearer ones of the block; of equal ones the language that sorts first."""

    def run(batches):
        for batch in batches:
            best = []
            for text, lang, score in zip(batch.column(at), *(batch.column(i).to_pylist() for i in (-2, -1))):
                name, near = model.value.predict(text.as_py())
                better = name != UND and (lang == UND or near > score or near == score and name < lang)
                best.append((name, near) if better else (lang, score))
            names, scores = zip(*best) if best else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(names, pa.string()), pa.array(scores, pa.float64())], batch.schema.names)

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that aren't held out and predict all; adds held_out, lang_pred and score."""
    profiles = settle(train_profiles(docs.where(~held_out())))
    return predict_language(make_room(docs, "held_out"), profiles).withColumn("held_out", held_out())


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
