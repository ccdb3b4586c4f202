"""Registered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.packing import pack
from tidemark.llm.token_counts import count_edited, quarter_revisions
from tidemark.llm import alignment, line_rules, prefix_trie, sharding
from tidemark.llm.pieces import decode, encode_sampled
from tidemark.llm.language import identify
from tidemark.llm.pii import KINDS, find_pii, of_kind, span_text
from tidemark.llm import toxicity
from tidemark.llm.jaccard_join import jaccard_links
from tidemark.llm.tree_forest import forest_links
from tidemark.llm.suffix_dedup import removed_repeats
from tidemark.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document before and after a revision at its quarters."""
    return count_edited(quarter_revisions(table(spark, folder, "documents")))


@query("op10_packing")
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of 2048 ids."""
    return pack(table(spark, folder, "documents"))


@query("op2_line_rules", line_rules.ORACLE)
def op2_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict for every document."""
    return line_rules.judge_lines(table(spark, folder, "documents"))


@query("op8_sentencepiece")
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """A sampled segmentation of every document, and whether decoding it gives the text again."""
    decoded = decode(encode_sampled(table(spark, folder, "documents")))
    return decoded.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), (F.crc32(F.col("text").cast("binary")) == F.col("text_crc32")).alias("lossless"))


@query("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return identify(table(spark, folder, "documents"))


@query("op6_pii")
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = find_pii(table(spark, folder, "documents"))
    counts = [F.size(F.filter("pii", of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = span_text(F.filter("pii", lambda s: s["base"]))
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), span_text(F.col("pii")).alias("spans"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document."""
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op3_tree_forest")
def op3_tree_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Links, class and keeper of every vector."""
    return forest_links(table(spark, folder, "embeddings"))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Links, class and keeper of every document."""
    return jaccard_links(table(spark, folder, "documents"))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that repeat."""
    return removed_repeats(table(spark, folder, "documents"))


@query("op11_jump_shards", sharding.ORACLE)
def op11_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard_slots(table(spark, folder, "documents"))


@query("op12_prefix_trie", prefix_trie.ORACLE)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the prefix trie of all conversations."""
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


@query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two vocabularies in every document, scored by the whole table."""
    return alignment.alignment_scores(table(spark, folder, "documents"))
