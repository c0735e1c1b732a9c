"""A standalone redactor with four ways to treat what a detector found."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspan.functions import pseudonyms as R
from veilspan.functions import spans as S

# Placeholders by type.
NAMED = {"person_name": "[PERSON]", "phone": "[PHONE]", "email": "[EMAIL]", "credit_card": "[CARD]", "ssn": "[SSN]"}


def replacement(span: Column, method: str) -> Column:
    t = span["text"]
    return {
        "replace": lambda: R.lookup(span["entity_type"], NAMED, F.lit("[REDACTED]")),
        "hash": lambda: F.sha2(t, 256),
        "mask": lambda: F.concat(F.repeat(F.lit("*"), F.least(F.lit(4), F.length(t))), F.substring(t, F.lit(5), F.length(t))),
        "remove": lambda: F.lit(""),
    }.get(method, lambda: F.lit("[REDACTED]"))()


def redact(text: Column, spans: Column, method: str = "replace") -> Column:
    """text with all spans replaced by placeholders, their hash, a mask over their first four signs, or nothing."""
    edits = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), replacement(s, method).alias("replacement"))))
    return S.splice(text, edits)
