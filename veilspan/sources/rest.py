"""Incident platforms as a Python data source: a page of results is a partition.

    spark.dataSource.register(IncidentPages)
    spark.read.format("incident_pages").option("url", "https://host/v1/incidents").option("pages", 20).load()

Options: url, pages (how many are asked for at most), page_size, token_env (name
of the environment variable with the bearer token), created_after, created_before,
query (a GraphQL text: it is posted, and url is read once), retries (3), wait
(seconds before the first retry; doubled each time), on_error (fail or row).
Rows are `id string, raw string, error string`; raw is the record's JSON, parsed
later by schema. An empty page has no rows. A page that still fails after its
retries, or whose GraphQL answer holds errors, fails the read; with on_error=row
it is a row of its own with an error, so no page is lost without a trace.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def graphql(kind: str, fields: str, limit: int = 100) -> str:
    """A GraphQL query for the newest records of a kind."""
    return f"query {{ {kind}(limit: {limit}) {{ {' '.join(fields.split())} }} }}"


INCIDENT_FIELDS = "id title summary description status severity createdAt updatedAt participants { id name email role } timelineEvents { id type title content createdAt user { id name email } }"
RETROSPECTIVE_FIELDS = "id title summary incident { id title summary } lessonsLearned { template categories questions } learnedLessons followUps createdAt updatedAt team { id name } authors { id name email }"


def _items(body) -> list:
    """The records of an answer: a list, or the first list below data or nodes."""
    while isinstance(body, dict):
        body = next((body[k] for k in ("data", "nodes", "incidents", "retrospectives", "items") if k in body), [])
    return body if isinstance(body, list) else []


class IncidentPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "incident_pages"

    def schema(self) -> str:
        return "id string, raw string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [InputPartition(n) for n in range(1, 2 if "query" in self.options else int(self.options.get("pages", "1")) + 1)]

    def read(self, partition):
        o, headers, data = self.options, {"Accept": "application/json"}, None
        if o.get("token_env") and os.environ.get(o["token_env"]):
            headers["Authorization"] = f"Bearer {os.environ[o['token_env']]}"
        url = o["url"]
        if "query" in o:
            data, headers["Content-Type"] = json.dumps({"query": o["query"]}).encode(), "application/json"
        else:
            asked = {"page[number]": partition.value, "page[size]": o.get("page_size", "100"), "filter[created_at][gt]": o.get("created_after"), "filter[created_at][lt]": o.get("created_before")}
            url += "?" + urllib.parse.urlencode({k: v for k, v in asked.items() if v is not None})
        try:
            body = _fetched(urllib.request.Request(url, data, headers), float(o.get("timeout", "30")), int(o.get("retries", "3")), float(o.get("wait", "1")))
        except (urllib.error.URLError, TimeoutError, ValueError) as e:
            if o.get("on_error", "fail") != "row":
                raise
            yield None, None, f"page {partition.value}: {e}"[:500]
            return
        for item in _items(body):
            yield str(item.get("id", "")), json.dumps(item), None


def _fetched(request: urllib.request.Request, timeout: float, retries: int, wait: float):
    for left in range(retries, -1, -1):
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                body = json.load(answer)
            if isinstance(body, dict) and body.get("errors"):
                raise ValueError(f"the answer holds errors: {body['errors']}")
            return body
        except (urllib.error.URLError, TimeoutError, ValueError):
            if not left:
                raise
            time.sleep(wait)
            wait *= 2
