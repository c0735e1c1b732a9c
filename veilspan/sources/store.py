"""The processing-history store: incidents and results as Parquet tables of any size.

Incidents are a log; the newest entry of an external id is the incident, so an
upsert appends and never rewrites. Its id is a hash of the external id, so loading
a record again does not orphan its results. Results are appended too, and so are
the ids of those that a clean-up takes away: nothing is ever rewritten, so a
result that arrives during a clean-up is not lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilspan.plans import pipeline
from veilspan.sources import incidents

INCIDENTS = "id string, external_id string, title string, summary string, description string, status string, severity string, created_at string, updated_at string, resolved_at string, raw_data string, loaded_at timestamp"
RESULTS = "id string, incident_id string, original_text string, processed_text string, quality_metrics string, processing_stats string, pseudonym_mapping string, recommendations string, processed_at timestamp"


def latest(log: DataFrame, key: str, *order: Column) -> DataFrame:
    """Of each key the newest row: an upsert's view of a log."""
    n = Window.partitionBy(key).orderBy(*order)
    return log.withColumn("__n", F.row_number().over(n)).where("__n = 1").drop("__n")


def unprocessed(items: DataFrame, results: DataFrame, key: str, ref: str) -> DataFrame:
    """Items without a result."""
    return items.join(results.select(F.col(ref).alias(key)), key, "left_anti")


def without_orphans(results: DataFrame, items: DataFrame, ref: str, key: str) -> DataFrame:
    """Results whose item exists; those with a null reference stay, as NOT IN leaves them."""
    kept = results.join(items.select(F.col(key).alias(ref)), ref, "left_semi").select(*results.columns)
    return kept.unionByName(results.where(F.col(ref).isNull()))


def store_statistics(items: DataFrame, results: DataFrame, key: str, ref: str, quality: Column) -> DataFrame:
    """Totals, how many items have results, and the mean quality of those results: one row."""
    total = items.agg(F.count("*").alias("total"))
    held = results.join(items.select(F.col(key).alias(ref)).distinct(), ref).agg(F.count_distinct(ref).alias("processed"), F.coalesce(F.avg(quality), F.lit(0.0)).alias("average"))
    both = total.join(held)  # one row each
    share = F.when(F.col("total") > 0, F.col("processed") / F.col("total") * 100).otherwise(F.lit(0.0))
    return both.select(F.col("total").alias("total_incidents"), F.col("processed").alias("processed_incidents"), (F.col("total") - F.col("processed")).alias("unprocessed_incidents"), share.alias("processing_percentage"), F.round("average", 3).alias("average_quality_score"))


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _read(self, path: str, schema: str) -> DataFrame:
        if not self._fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def store_incidents(self, records: DataFrame) -> None:
        """Upsert records with an id column; a missing id is the empty one."""
        names = [c.split(" ")[0] for c in INCIDENTS.split(", ")]
        have = {c: F.col(f"`{c}`").cast("string") if c in records.columns else F.lit(None).cast("string") for c in names}
        external = F.coalesce(F.col("id").cast("string"), F.lit("")) if "id" in records.columns else F.lit("")
        have |= {"id": F.sha2(external, 256), "external_id": external, "raw_data": F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns])), "loaded_at": F.current_timestamp()}
        records.select(*[have[c].alias(c) for c in names]).write.mode("append").parquet(f"{self.path}/incidents")

    def store_results(self, results: DataFrame) -> None:
        names = [c.split(" ")[0] for c in RESULTS.split(", ")]
        have = {c: F.col(c) if c in results.columns else F.lit(None).cast("string") for c in names} | {"id": F.expr("uuid()"), "processed_at": F.current_timestamp()}
        results.select(*[have[c].alias(c) for c in names]).write.mode("append").parquet(f"{self.path}/results")

    def incidents(self) -> DataFrame:
        return latest(self._read(f"{self.path}/incidents", INCIDENTS), "external_id", F.desc("loaded_at"), F.desc("raw_data"))

    def results(self) -> DataFrame:
        return self._read(f"{self.path}/results", RESULTS).join(self._read(f"{self.path}/removed", "id string"), "id", "left_anti")

    def get_by_external_id(self, external_id: str) -> DataFrame:
        return self.incidents().where(F.col("external_id") == external_id)

    def get_incident(self, id_: str) -> DataFrame:
        return self.incidents().where(F.col("id") == id_)

    def get_result(self, incident_id: str) -> DataFrame:
        """The newest result of an incident."""
        return self.results().where(F.col("incident_id") == incident_id).orderBy(F.desc("processed_at"), "id").limit(1)

    def list_incidents(self, n: int) -> DataFrame:
        """The n newest incidents."""
        return self.incidents().orderBy(F.desc("loaded_at"), "id").limit(n)

    def unprocessed(self) -> DataFrame:
        return unprocessed(self.incidents(), self.results().withColumnRenamed("incident_id", "ref"), "id", "ref")

    def cleanup_orphaned_results(self) -> int:
        """Takes away results of unknown incidents; returns how many went."""
        old = self.results()
        gone = old.join(without_orphans(old, self.incidents(), "incident_id", "id").select("id"), "id", "left_anti").select("id")
        name = f"{self.path}/removed"
        before = self._read(name, "id string").count()
        gone.write.mode("append").parquet(name)
        return self._read(name, "id string").count() - before

    def process(self, limit: int | None = None, **options) -> int:
        """Process the incidents without a result, newest first, and store what comes out; returns how many.

        options are those of plans.pipeline.process. An incident whose stored record
        cannot be read is stored as a result without text and with its error.
        """
        todo = self.unprocessed()
        if limit is not None:
            todo = todo.orderBy(F.desc("loaded_at"), "id").limit(limit)
        n = todo.count()
        record = F.from_json("raw_data", incidents.SCHEMA + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
        rows = todo.select("id", record.alias("r")).select(F.col("id").alias("store_id"), "r.*")
        bad = F.when(F.col("_corrupt").isNotNull(), F.lit("the stored record is not JSON"))
        docs = rows.select(F.col("store_id").alias("doc_id"), incidents.brief_text(rows).alias("text"), bad.alias("error"))
        out = pipeline.process(docs, **options)
        stats = F.struct("arbitration", "judge_stats", "checks", "text_reduction_percentage", "error")
        self.store_results(out.select(F.col("doc_id").alias("incident_id"), F.col("text").alias("original_text"), "processed_text", F.to_json("quality_metrics").alias("quality_metrics"), F.to_json(stats).alias("processing_stats"), F.to_json("pseudonym_map").alias("pseudonym_mapping"), F.to_json("recommendations").alias("recommendations")))
        return n

    def statistics(self) -> DataFrame:
        quality = F.get_json_object("quality_metrics", "$.overall_quality_score").cast("double")
        return store_statistics(self.incidents(), self.results(), "id", "incident_id", quality)
