"""Detectors and language models as plug-ins: off by default, run in Arrow batches, one client per worker.

A detector factory returns a function from a list of texts to a list of lists of
(start, end, text, type, score). A model factory returns a function from a list
of prompts to a list of answers. Factories are called once per task on the
executors; an error of one row becomes an answer of its own, not a failed job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspan.functions import spans as S
from veilspan.operators import review
from veilspan.shipping import ship

FOUND = "array<struct<start:int,end:int,text:string,type:string,score:double>>"
Detector = Callable[[list[str]], list[list[tuple[int, int, str, str, float]]]]
Model = Callable[[list[str]], list[str]]


def _each(call: Callable[[list], list], rows: list, failed) -> list:
    """call on all rows, or on one after the other if that fails; failed stands for the rows that fail alone."""
    try:
        return call(rows)
    except Exception:
        return [failed] if len(rows) == 1 else [y for x in rows for y in _each(call, [x], failed)]


def detect_with(df: DataFrame, factory: Callable[[], Detector], text: str = "text", out: str = "ner") -> DataFrame:
    """df with what a plug-in detector found; a text on which it fails has nothing."""
    ship(df.sparkSession)

    @F.pandas_udf(FOUND)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        detector = factory()
        for part in parts:
            rows = _each(detector, part.fillna("").tolist(), [])
            yield pd.Series([[{"start": a, "end": b, "text": t, "type": k, "score": s} for a, b, t, k, s in r] for r in rows])

    return df.withColumn(out, found(F.col(f"`{text}`")))


def name_detector(first_names: frozenset[str]) -> Detector:
    """A small dictionary detector: a listed first name and the capitalised word after it."""
    word = re.compile(r"\b([A-Z][a-z]+) ([A-Z][a-z]+)\b")

    def run(texts: list[str]) -> list[list[tuple[int, int, str, str, float]]]:
        return [[(m.start(), m.end(), m[0], "PERSON", 0.85) for m in word.finditer(t) if m[1] in first_names] for t in texts]

    return run


def detect_after(df: DataFrame, factory: Callable[[], Detector], text: str, out: str) -> DataFrame:
    """detect_with for a text that a long plan computes: whole rows pass through Python.

    The optimizer does not work across this step; with a function of the computed
    column inside one plan, planning does not end.
    """
    ship(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T._parse_datatype_string(FOUND))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = factory()
        for batch in batches:
            rows = _each(detector, [t or "" for t in batch[text].to_pylist()], [])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("type", pa.string()), ("score", pa.float64())]))
            found = pa.array([[{"start": a, "end": b, "text": t, "type": k, "score": s} for a, b, t, k, s in r] for r in rows], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


# Words before a name, and the last words of a street.
TITLES = "Mr|Mrs|Ms|Dr|Prof"
ROLES = "employee|engineer|manager|colleague|contractor|analyst|developer|operator|customer|user|contact|by|from|with|named"
STREETS = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Drive|Dr|Court|Ct|Square|Sq"
_NAME = r"\p{Lu}[\p{Ll}'’-]+(?:\s\p{Lu}\.)?(?:\s\p{Lu}[\p{Ll}'’-]+)"
PEOPLE = {
    "PERSON": rf"(?U)(?:(?<=\b(?:{TITLES})\.?\s)\p{{Lu}}[\p{{Ll}}'’-]+(?:\s\p{{Lu}}[\p{{Ll}}'’-]+)?|(?<=\b(?i:{ROLES}):?\s){_NAME}|(?<=(?:^|\n)-\s){_NAME}(?=\s\())(?!\w)",
    "LOCATION": rf"(?U)\b\d{{1,5}}\s(?:\p{{Lu}}[\p{{Ll}}]+\s){{1,3}}(?:{STREETS})\b",
}


def people(text: Column) -> Column:
    """Names of persons and street addresses by their surroundings, as a detector's spans: native, and far from a trained recogniser.

    A name is one or two capitalised words after a title, two after a word for a role,
    or two at the head of a list line before a bracket.
    """
    found = [F.transform(S.find(text, p), lambda h: F.struct(h["start"], h["end"], h["text"], F.lit(kind).alias("type"), F.lit(0.85 if kind == "PERSON" else 0.6).alias("score"))) for kind, p in PEOPLE.items()]  # noqa: B023
    return F.concat(*found).cast(FOUND)


def ask(prompt: Column, factory: Callable[[], Model]) -> Column:
    """A model's answers; null where the call failed."""

    @F.pandas_udf("string")
    def answered(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for part in parts:
            yield pd.Series(_each(model, part.tolist(), None), dtype=object)

    return answered(prompt)


def ask_each(prompts: Column, factory: Callable[[], Model]) -> Column:
    """A model's answers to an array of prompts, in order; null for a null prompt and where the call failed."""

    @F.pandas_udf("array<string>")
    def answered(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for part in parts:
            rows = []
            for asked in part:
                asked = [] if asked is None else list(asked)
                told = iter(_each(model, [x for x in asked if x is not None], None) if any(x is not None for x in asked) else [])
                rows.append([None if x is None else next(told) for x in asked])
            yield pd.Series(rows, dtype=object)

    return answered(prompts)


def final_review(df: DataFrame, factory: Callable[[], Model], key: str = "doc_id", text: str = "processed_text", out: str = "final_review", prompt: Callable[[Column], Column] = lambda piece: piece) -> DataFrame:
    """df with the folded review of all windows of each text. key identifies rows; prompt makes the question from a window."""
    ship(df.sparkSession)
    pieces = review.windows(F.col(f"`{text}`"))
    rows = df.select(F.col(key), F.posexplode_outer(pieces).alias("at", "piece"))
    rows = rows.withColumn("raw", ask(prompt(F.col("piece")), factory)).withColumn("result", F.when(F.col("raw").isNull(), review.skipped("api_error", F.lit(0))).otherwise(review.parsed(F.col("raw"))))
    one = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "result"))).alias("rows"))
    df = df.join(one, key, "left").withColumn("__results", F.transform("rows", lambda r: r["result"]))
    return df.withColumn(out, review.folded(F.col(f"`{text}`"), pieces, F.col("__results"))).drop("rows", "__results")
