"""Corpus summaries: plain aggregates, combined before their shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def reduction(before: Column, after: Column) -> Column:
    """Percent by which a text has shrunk; 0 for an empty one, negative if it grew."""
    n = F.length(before)
    return F.when(n > 0, (n - F.length(after)).cast("double") / n * 100).otherwise(F.lit(0.0))


def corpus_summary(results: DataFrame, *by: str) -> DataFrame:
    """Totals of processed rows, for the whole corpus or by columns.

    Lists of ids would grow with the corpus; needing_review() gives them as rows.
    """
    m, ok = F.col("quality_metrics"), F.col("error").isNull() if "error" in results.columns else F.lit(True)
    reviewed = ok & ~F.col("final_review.skipped")
    of = lambda c: F.when(ok, c)
    return results.groupBy(*by).agg(
        F.count("*").alias("total_documents"),
        F.count_if(ok).alias("successful_documents"),
        F.count_if(~ok).alias("failed_documents"),
        F.coalesce(F.avg(of(m["overall_quality_score"])), F.lit(0.0)).alias("average_quality_score"),
        F.coalesce(F.avg(of(F.col("text_reduction_percentage"))), F.lit(0.0)).alias("average_text_reduction"),
        F.coalesce(F.sum(of(F.size("pseudonym_map"))), F.lit(0)).alias("total_pseudonyms_generated"),
        F.coalesce(F.sum(of(F.size("issues"))), F.lit(0)).alias("total_validation_issues"),
        F.coalesce(F.sum(of(F.size(F.filter("issues", lambda i: i["severity"] == "critical")))), F.lit(0)).alias("total_critical_issues"),
        F.count_if(ok & F.col("human_review.needs_review")).alias("documents_needing_review"),
        F.count_if(reviewed).alias("documents_reviewed"),
        F.count_if(reviewed & ~F.col("final_review.is_clean")).alias("documents_flagged"),
    )


def needing_review(results: DataFrame) -> DataFrame:
    return results.where("human_review.needs_review").select("doc_id", "human_review.quality_score", "human_review.reason")


def per_document(results: DataFrame) -> DataFrame:
    """A line for each document: its score, issues and whether it failed or should be seen."""
    error = F.col("error") if "error" in results.columns else F.lit(None).cast("string")
    return results.select(
        "doc_id", error.alias("error"), F.col("quality_metrics.overall_quality_score").alias("quality_score"), F.col("text_reduction_percentage").alias("text_reduction"), F.size("issues").alias("issues"),
        F.coalesce(F.col("human_review.needs_review"), F.lit(False)).alias("needs_review"),
    )


def arbitration_totals(results: DataFrame, *by: str) -> DataFrame:
    """Arbitration counters of all rows added up."""
    names = ("total_entities_processed", "redactions_applied", "pseudonymizations_applied", "retentions_applied", "conflicts_resolved", "force_rules_applied", "context_adjustments", "allowlist_overrides")
    return results.groupBy(*by).agg(*[F.coalesce(F.sum(f"arbitration.{n}"), F.lit(0)).alias(n) for n in names])


def file_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Per collected text file: lines and bytes."""
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return files.groupBy("file").agg(F.count("*").alias("lines"), F.first("bytes").alias("bytes"))
