"""A training corpus from `documents`, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.stage import staged
from tidemark.llm.jaccard_join import keep_one
from tidemark.llm.packing import pack
from tidemark.llm.pii import redact
from tidemark.llm.suffix_dedup import removed_repeats
from tidemark.llm.toxicity import THRESHOLD, fit, scorer

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None
#: A shared passage has at least so many whole words; strings of so many bytes (of which so many are hashed) are looked for,
#: as 51 words of prose with the spaces between them are longer.
PASSAGE_WORDS, PASSAGE_BYTES, PASSAGE_GRAM = 51, 200, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay; an empty or null text is not toxic."""
    score = scorer(spark, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return docs.where(score(F.col("text").cast("string")) < THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of texts alike stays; texts without words are in no class and stay."""
    return keep_one(docs)


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars").cast("long")))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the passages of more than 50 words that two documents share.

    All occurrences go, the first one too: near-copies have left one document each before this stage, so what different
    documents still share at that length is licence, boilerplate, quotation or a benchmark's text, none of which is the
    first document's own. Repeats inside one document, and passages of up to 50 words, stay as they are.
    """
    return _recounted(removed_repeats(docs, length=PASSAGE_BYTES, gram=PASSAGE_GRAM, keep_text=True, across=True, words=PASSAGE_WORDS))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with a mark in place of each piece of personal data."""
    return _recounted(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document in sequences of 2048 ids."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", suffix_dedup),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again as the documents of the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
