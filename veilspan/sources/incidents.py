"""Incident records: JSON sources, their schema, ids and the texts built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PERSON = "struct<id:string,name:string,email:string,role:string>"
_EVENTS = "array<struct<id:string,type:string,title:string,content:string,createdAt:string,timestamp:string,event:string,author:string,description:string,user:struct<id:string,name:string,email:string>>>"
#: Every field is nullable; a field that no record has reads as null.
SCHEMA = (
    "id string, incident_id string, incidentId string, `incident-id` string, ticket_id string, ticketId string, title string, summary string, description string, status string, severity string, severity_key string, "
    f"created_at string, updated_at string, resolved_at string, incidentCommander {_PERSON}, participants array<{_PERSON}>, timelineEvents {_EVENTS}, timeline_events {_EVENTS}, events {_EVENTS}, updates {_EVENTS}, "
    "comments array<struct<content:string>>, tasks array<struct<id:string,title:string,assignee:string,status:string,due_date:string>>, sources array<struct<id:string,name:string,type:string>>, learnedLessons string, followUps string"
)
# Id fields in order of precedence.
ID_FIELDS = ("id", "incident_id", "incidentId", "incident-id", "ticket_id", "ticketId")


def read_incidents(spark: SparkSession, path: str, permissive: bool = False, errors: bool = False) -> DataFrame:
    """Records of .jsonl or .json files. Bad lines fail the read; permissive reads JSON lines only and drops bad ones.

    With errors, a bad line stays as a row without fields whose `error` says what is
    wrong, so that it is counted as a failed document (`error` is null elsewhere).
    """
    if not path.rstrip("/").lower().endswith((".json", ".jsonl")):
        raise ValueError(f"not a .json or .jsonl path: {path}")
    if permissive or errors:
        row = F.from_json("value", SCHEMA + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
        rows = spark.read.text(path).where("trim(value) <> ''").select(row.alias("r"))
        if not errors:
            return rows.where("r._corrupt is null").select("r.*").drop("_corrupt")
        said = F.when(F.col("r._corrupt").isNotNull(), F.concat(F.lit("not a JSON record: "), F.substring("r._corrupt", 1, 80)))
        return rows.select("r.*", said.alias("error")).drop("_corrupt")
    return spark.read.schema(SCHEMA).option("multiLine", path.lower().endswith(".json")).option("mode", "FAILFAST").json(path)


def incident_id(df: DataFrame) -> Column:
    """The first id field that is there, else a name from the title, else one from the record's hash."""
    ids = [F.col(f"`{c}`") for c in ID_FIELDS if c in df.columns]
    title = F.concat(F.lit("incident_"), F.regexp_replace(F.substring("title", 1, 20), r"[^\p{L}\p{N}]", ""))
    return F.coalesce(*ids, title, F.concat(F.lit("incident_"), F.substring(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), 256), 1, 16)))


def _joined(*parts: Column) -> Column:
    return F.array_join(F.array_compact(F.flatten(F.array(*parts))), "\n")


def _one(label: str, value: Column, present: Column) -> Column:
    return F.array(F.when(present, F.concat(F.lit(f"{label}: "), value)))


def _list(header: str, rows: Column, line) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(rows.isNotNull(), F.concat(F.array(F.lit(header)), F.flatten(F.transform(F.filter(rows, lambda x: x.isNotNull()), line)))).otherwise(empty)


def incident_text(df: DataFrame, timeline: bool = False) -> Column:
    """Title, summary, description and participants as lines; timeline adds events and comments."""
    heads = [_one(c.capitalize(), F.col(c), F.col(c).isNotNull()) for c in ("title", "summary", "description")]
    people = _list("Participants:", F.col("participants"), lambda p: F.array(F.when(p["email"].isNotNull(), F.when(p["name"].isNotNull(), F.concat(F.lit("- "), p["name"], F.lit(" ("), p["email"], F.lit(")"))).otherwise(F.concat(F.lit("- "), p["email"])))))
    if not timeline:
        return _joined(*heads, people)
    events = F.coalesce("timelineEvents", "timeline_events", "events", "updates")
    told = _list("Timeline Events:", events, lambda e: F.array(F.concat(F.lit("- "), e["content"]), F.concat(F.lit("  User: "), e["user"]["email"])))
    comments = _list("Comments:", F.col("comments"), lambda c: F.array(F.concat(F.lit("- "), c["content"])))
    return _joined(*heads, people, told, comments)


def brief_text(df: DataFrame) -> Column:
    """The short form: empty fields are left out, participants have defaults and roles."""
    heads = [_one(c.capitalize(), F.col(c), F.col(c) != "") for c in ("title", "summary", "description")]
    person = lambda p: F.concat(F.lit("- "), F.coalesce(p["name"], F.lit("Unknown")), F.lit(" ("), F.coalesce(p["email"], F.lit("")), F.lit(") - "), F.coalesce(p["role"], F.lit("")))
    people = F.when(F.col("participants").isNotNull(), F.array(F.rtrim(F.concat_ws("\n", F.lit("Participants:"), F.transform("participants", person)))))
    return _joined(*heads, F.coalesce(people, F.array().cast("array<string>")))


def documents(df: DataFrame, timeline: bool = False) -> DataFrame:
    """doc_id and text of incident records (and error, if they have it), ready for the redactor."""
    bad = ["error"] if "error" in df.columns else []
    fields = df.drop(*bad)
    return df.select(incident_id(fields).alias("doc_id"), incident_text(fields, timeline).alias("text"), *bad)


_TEAM = "struct<id:string,name:string>"
RETROSPECTIVES = (
    f"id string, title string, summary string, incident struct<id:string,title:string,summary:string>, lessonsLearned struct<template:string,categories:array<string>,questions:array<string>>, "
    f"learnedLessons string, followUps string, createdAt string, updatedAt string, team {_TEAM}, authors array<{_PERSON}>"
)


def parsed(pages: DataFrame, schema: str = SCHEMA) -> DataFrame:
    """Records of rows (id, raw) that a platform's pages gave, by a schema; fields that a record lacks are null."""
    return pages.select(F.from_json("raw", schema).alias("r")).select("r.*")


def retrospective_text(df: DataFrame) -> Column:
    """Title, summary, the incident it looks back on, lessons, follow-ups and authors as lines."""
    heads = [_one(c.capitalize(), F.col(c), F.col(c).isNotNull()) for c in ("title", "summary")]
    heads += [_one("Incident", F.col("incident.title"), F.col("incident.title").isNotNull()), _one("Lessons", F.col("learnedLessons"), F.col("learnedLessons").isNotNull()), _one("Follow-ups", F.col("followUps"), F.col("followUps").isNotNull())]
    authors = _list("Authors:", F.col("authors"), lambda p: F.array(F.when(p["email"].isNotNull(), F.concat(F.lit("- "), F.coalesce(p["name"], F.lit("Unknown")), F.lit(" ("), p["email"], F.lit(")")))))
    return _joined(*heads, authors)


def retrospectives(pages: DataFrame) -> DataFrame:
    """doc_id and text of retrospectives from a platform's pages."""
    df = parsed(pages, RETROSPECTIVES)
    return df.select(F.col("id").alias("doc_id"), retrospective_text(df).alias("text"))


def with_tasks(incidents: DataFrame, tasks: DataFrame) -> DataFrame:
    """incidents with their tasks (incident_id, id, title, ...) as an array; a left join instead of a request for each."""
    rows = tasks.groupBy("incident_id").agg(F.collect_list(F.struct(*[c for c in tasks.columns if c != "incident_id"])).alias("tasks"))
    return incidents.drop("tasks").join(rows.withColumnRenamed("incident_id", "id"), "id", "left")
