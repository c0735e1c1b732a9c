"""Redaction of streams. The pipeline is row-local, so it needs no state and no watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veilspan.plans import pipeline
from veilspan.sources import incidents


def read_incident_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """JSON-lines records that arrive as files."""
    return spark.readStream.schema(incidents.SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(path)


def redact_stream(rows: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Writes doc_id and processed_text of every row (doc_id, text); with a checkpoint each row is written exactly once."""
    out = pipeline.redact(rows).select("doc_id", "processed_text").writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
