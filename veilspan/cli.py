"""The store and the redactor from a shell.

    python -m veilspan.cli redact IN.jsonl OUT
    python -m veilspan.cli --store DIR load IN.jsonl | process [--limit N] | stats | get --id ID [--results] | list [--limit N] [--unprocessed]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from veilspan.operators.policy import Allowlist, Policy
from veilspan.plans import pipeline
from veilspan.sources import incidents, sinks
from veilspan.sources.store import Store


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="veilspan", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--store", default="incident-store")
    p.add_argument("--policy")
    p.add_argument("--allowlist")
    p.add_argument("--no-allowlist", action="store_true")
    p.add_argument("--people", action="store_true", help="also find names and addresses by their surroundings")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("redact")
    run.add_argument("input")
    run.add_argument("output")
    run.add_argument("--timeline", action="store_true")
    run.add_argument("--threshold", type=float, default=0.7)
    run.add_argument("--audit", action="store_true", help="also write stage tables, which hold originals")
    sub.add_parser("load").add_argument("input")
    sub.add_parser("process").add_argument("--limit", type=int)
    sub.add_parser("stats")
    get = sub.add_parser("get")
    which = get.add_mutually_exclusive_group(required=True)
    which.add_argument("--id")
    which.add_argument("--external-id")
    get.add_argument("--results", action="store_true")
    rows = sub.add_parser("list")
    rows.add_argument("--limit", type=int, default=10)
    rows.add_argument("--unprocessed", action="store_true")
    return p


def options(a: argparse.Namespace) -> dict:
    allowed = Allowlist() if a.no_allowlist else Allowlist.load(a.allowlist) if a.allowlist else None
    return {"policy": Policy.default().load(a.policy) if a.policy else None, "allowlist": allowed, "people": a.people}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("veilspan").getOrCreate()
    if a.command == "redact":
        docs = incidents.documents(incidents.read_incidents(spark, a.input, errors=a.input.endswith(".jsonl")), a.timeline)
        out = pipeline.process(docs, threshold=a.threshold, **options(a)).persist()
        sinks.save_results(out, f"{a.output}/results")
        sinks.save_reports(out, f"{a.output}/reports")
        sinks.save_summary(out, a.output)
        if a.audit:
            sinks.save_audit(out, f"{a.output}/audit")
        print(f"{out.count()} documents")
        out.unpersist()
        return 0
    store = Store(spark, a.store)
    if a.command == "load":
        rows = incidents.read_incidents(spark, a.input, permissive=True)
        store.store_incidents(rows)
        print(f"{rows.count()} incidents loaded")
    elif a.command == "process":
        print(f"{store.process(a.limit, **options(a))} incidents processed")
    elif a.command == "stats":
        store.statistics().show(truncate=False, vertical=True)
    elif a.command == "get":
        one = store.get_incident(a.id) if a.id else store.get_by_external_id(a.external_id)
        row = one.first()
        if row is None:
            print("no such incident", file=sys.stderr)
            return 1
        one.drop("raw_data").show(truncate=False, vertical=True)
        if a.results:
            store.get_result(row["id"]).show(truncate=200, vertical=True)
    else:
        rows = store.unprocessed().orderBy("external_id").limit(a.limit) if a.unprocessed else store.list_incidents(a.limit)
        rows.select("id", "external_id", "title", "status", "severity", "created_at").show(a.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
