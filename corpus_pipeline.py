"""Documents made ready for training, stage by stage.

Each stage works on all rows its predecessor kept and is written and read again
before the next: toxic documents go, one document of each near-duplicate group
stays, documents that hold benchmark items go, sources are mixed to their target
weights (a document may repeat), and the result is dealt to shards.

Defined cases, beside those of the operators: rows without an id are never taken
for toxic labels, near copies or leaks and stay until mixing; a text that is null,
empty or blank is no copy of another, holds no benchmark item and has size 0, so
mixing takes it as often as others of its source; repeated rows of one id and text
are kept together or go together before mixing; of an id with several texts each
row is judged by its own text. Of near copies the smallest id stays. Further
columns are carried along, whatever their names, until sharding replaces those it
adds. Empty tables give empty results; without labels nothing is toxic, without
benchmark items nothing leaks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilspan.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from veilspan.llm.common import materialize


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those scored toxic by a model learned from their labels."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked at a Jaccard of 0.8 over 5-word shingles."""
    return near_dedup.drop_near_duplicates(docs, k=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that hold a benchmark item, whatever its numbers, names and units."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs, each as often as its source's target asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with their shard and slot."""
    return sharding.shard_documents(docs, shards=40)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned scores and connected components have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
