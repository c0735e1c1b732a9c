"""Collection: records of several platforms, written as JSON lines, with a result row for each platform."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspan.operators import summary

RESULT = "platform string, incidents_collected long, output_path string, collection_time string, success boolean, error_message string"


def collect(spark: SparkSession, platforms: dict[str, Callable[[SparkSession], DataFrame]], path: str, names: list[str] | None = None) -> DataFrame:
    """Write the records of every platform under path and return what came of each.

    A platform is a function that gives a DataFrame of records, such as a read of
    `incident_pages`. One that fails, or that is asked for and unknown, gives a row
    with its error and does not stop the others.
    """
    rows = []
    for name in names if names is not None else list(platforms):
        target, now = f"{path.rstrip('/')}/{name}_incidents.jsonl", datetime.now(UTC).isoformat()
        try:
            if name not in platforms:
                raise ValueError(f"unknown platform {name}; known are {', '.join(sorted(platforms))}")
            platforms[name](spark).write.mode("overwrite").json(target)
            rows.append((name, spark.read.text(target).count(), target, now, True, None))
        except Exception as e:
            rows.append((name, 0, None, now, False, str(e)[:500]))
    return spark.createDataFrame(rows, RESULT)  # one row for each platform


def collection_summary(results: DataFrame) -> DataFrame:
    """One row: how many platforms were collected, and how many records."""
    return results.agg(
        F.count("*").alias("total_platforms"), F.count_if("success").alias("successful_collections"), F.count_if(~F.col("success")).alias("failed_collections"),
        F.coalesce(F.sum("incidents_collected"), F.lit(0)).alias("total_incidents"),
    )


def save_collection_summary(results: DataFrame, path: str) -> None:
    """The summary with a row for each platform in it, as one JSON record."""
    each = results.agg(F.collect_list(F.struct(*results.columns)).alias("platform_results"))  # a row for each platform
    collection_summary(results).join(each).coalesce(1).write.mode("overwrite").json(path)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """Lines and bytes of every file collected under path, by platform."""
    files = summary.file_statistics(spark, f"{path.rstrip('/')}/*_incidents.jsonl")
    return files.withColumn("platform", F.regexp_extract("file", r"([^/]+)_incidents\.jsonl", 1)).groupBy("platform").agg(F.count("*").alias("files"), F.sum("lines").alias("incidents"), F.sum("bytes").alias("bytes"))


def keys_present(keys: dict[str, str], platforms: list[str]) -> dict[str, bool]:
    """Whether each platform has a key of a plausible length; no request is made."""
    return {p: len(keys.get(p) or "") > 10 for p in platforms}


def sample_records(spark: SparkSession, n: int) -> DataFrame:
    """n made-up incident records, to try a pipeline without a platform; equal for equal n."""
    i = F.col("id")
    mail = F.concat(F.lit("user"), i, F.lit("@example.com"))
    person = F.struct(F.concat(F.lit("p"), i).alias("id"), F.concat(F.lit("Person "), i).alias("name"), mail.alias("email"), F.lit("responder").alias("role"))
    text = F.concat(F.lit("Write to "), mail, F.lit(" or call 555-010-"), F.lpad((i % 10_000).cast("string"), 4, "0"), F.lit("."))
    return spark.range(n).select(F.concat(F.lit("sample-"), i).alias("id"), F.concat(F.lit("Incident "), i).alias("title"), F.lit("A made-up incident").alias("summary"), text.alias("description"), F.array(person).alias("participants"))


def read_summary(path: str) -> dict:
    """A saved summary from a local folder."""
    from pathlib import Path

    return json.loads(next(Path(path).glob("part-*")).read_text(encoding="utf-8"))
