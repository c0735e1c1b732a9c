"""One query for each operator, over its whole table and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspan.llm import chat, decontaminate, language_id, licenses, mixing, near_dedup, quality, secrets, sharding, toxicity

#: The vocabulary of a public byte-level tokenizer, as it lies on every machine.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard of 85 % or more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op1_balanced_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 of equal row counts, copies together where they fit."""
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op8_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that a mix by source weights takes."""
    found = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLES["op8_systematic_mixing"] = mixing.ORACLE


@query
def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) where the item's template windows are in the document."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_perplexity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the perplexity verdict of every document."""
    return quality.quality(table(spark, sf_dir, "documents"))


@query
def op5_centroid_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return language_id.languages(table(spark, sf_dir, "documents"))


@query
def op2_network_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets that rules and network find in every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op9_budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted windows of every conversation hold, read back from them."""
    return chat.read_back(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations")), tokenizer=TOKENIZER))


@query
def op7_patience_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))
