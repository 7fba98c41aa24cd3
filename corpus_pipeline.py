"""Corpus preparation in stages, each written as Parquet in the shared folder, read again and deleted after the next.

Stages: language identification, near-duplicate removal, benchmark decontamination, pseudonyms,
tokenisation. All but the last return the columns of documents.

Defined results, stage by stage. Null texts and those without a letter have no language and go in the first
stage, so the later ones see none from there; on their own, the near-copy stage keeps null and empty texts and rows
with a null id, decontamination keeps them as they are, pseudonyms leave a null text null, and tokenisation
gives null texts no ids. Repeated rows (one id and one text) stay or go together. Of equal similarity the smallest id
stays. Empty tables give no rows in every stage, and an empty benchmark removes nothing. Very long texts are
handled whole. Extra columns are carried through, whatever their names, up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, decontamination, jaccard, language, pii
from folioscope.llm.common import Scratch, packed, table, unpacked

#: No SQL: language profiles, pseudonyms and token ids aren't SQL expressions; tests compare with brute force.
ORACLE_SQL = None

#: Pre-tokens that a worker remembers; workers keep what they hold from stage to stage, so fewer than the operator's own.
REMEMBERED = 100_000

#: Near copies share so many percent of their distinct shingles of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; ``lang`` becomes the predicted one."""
    found = language.identify(packed(docs, "doc_id", "text", "lang")).where(F.col("lang_pred") != language.UND)
    return unpacked(found, docs.columns, lang=F.col("lang_pred"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays; near is a Jaccard similarity of 0.8 of five-word shingles."""
    return jaccard.keep_one_of_each(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter benchmark spans are cut out of the others."""
    return counted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Validated personal numbers, dates and addresses get pseudonyms, by the key that ``spark.folioscope.pseudonym.key`` holds or one of this run."""
    return counted(unpacked(pii.pseudonym_columns(packed(docs, "text"), pii.session_key(spark)), docs.columns, text=F.col("text")))


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit), their number, and whether decoding gives the text back."""
    path, pattern = bpe.default_files()
    coded = docs.select("doc_id", "lang", "source", bpe.encode_checked(F.col("text"), path, pattern, REMEMBERED).alias("coded"))
    return coded.select(
        "doc_id", "lang", "source", "coded.ids",
        F.expr("CAST(octet_length(coded.ids) div 4 AS BIGINT)").alias("n_tokens"), "coded.round_trip",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_copies),
    ("decontamination", remove_benchmark),
    ("pii", replace_personal_data),
    ("bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents table; a stage's table is deleted when the next one's is written."""
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.settle(stage(spark, docs, sf_dir), f"{i}_{name}")
        if before:
            scratch.drop(before)
        before = f"{i}_{name}"
    return docs
