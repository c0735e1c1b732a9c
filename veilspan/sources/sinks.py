"""Sinks: shareable results, audit tables apart from them, and reports. Each is one distributed write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from veilspan.functions import spans as S
from veilspan.operators import summary

SCHEMA_VERSION = "1.1"


def save_results(results: DataFrame, path: str, mode: str = "append") -> None:
    """The main result of every document as JSON lines; it holds no original text."""
    kept = ["doc_id", "processed_text", "quality_metrics", "recommendations", "text_reduction_percentage", "human_review", "final_review"]
    results.select(F.lit(SCHEMA_VERSION).alias("schema_version"), *[c for c in kept if c in results.columns]).write.mode(mode).json(path)


def save_audit(results: DataFrame, path: str, mode: str = "append") -> None:
    """Stage tables with originals, one folder each: spans, findings, judgements, decisions, issues. Keep them private."""
    for stage in ("spans", "candidates", "contextual", "findings", "judgements", "decisions", "issues"):
        if stage in results.columns:
            S.rows(results, stage, "doc_id").write.mode(mode).parquet(f"{path}/{stage}")


def save_reports(results: DataFrame, path: str, mode: str = "append") -> None:
    """A report per document: counts, metrics, advice and whether a person should look."""
    report = results.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), "doc_id", F.length("text").alias("original_length"), F.length("processed_text").alias("processed_length"), "text_reduction_percentage",
        "quality_metrics", F.size("pseudonym_map").alias("pseudonyms"), F.size("decisions").alias("total_decisions"), F.size("issues").alias("validation_issues"),
        F.size(F.filter("issues", lambda i: i["severity"] == "critical")).alias("critical_issues"), F.size(F.filter("issues", lambda i: i["severity"] == "high")).alias("high_issues"),
        "recommendations", "human_review", "final_review",
    )
    report.write.mode(mode).json(path)


def save_records(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as JSON lines."""
    rows.write.mode(mode).json(path)


def save_summary(results: DataFrame, path: str, *by: str, mode: str = "overwrite") -> None:
    """The corpus summary, and beside it as rows what would grow with the corpus: documents to review, and a line for each document."""
    summary.corpus_summary(results, *by).select(F.lit(SCHEMA_VERSION).alias("schema_version"), "*").coalesce(1).write.mode(mode).json(f"{path}/summary")
    summary.needing_review(results).write.mode(mode).json(f"{path}/needing_review")
    summary.per_document(results).write.mode(mode).json(f"{path}/documents")


def save_mapping(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Every text that a detector pseudonymizes with its pseudonym, once. It holds originals: keep it private."""
    rows = results.select(F.explode_outer("detected_map").alias("original", "pseudonym")).where("original is not null")
    rows.groupBy("original").agg(F.min("pseudonym").alias("pseudonym")).write.mode(mode).json(path)


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """original and pseudonym of a saved map; a missing one is empty."""
    schema = "original string, pseudonym string"
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def apply_mapping(spans: DataFrame, mapping: DataFrame, text: str = "text") -> DataFrame:
    """Span rows with the pseudonym of their text; the planner broadcasts a small map and shuffles for a large one."""
    return spans.join(mapping.withColumnRenamed("original", text), text, "left")
