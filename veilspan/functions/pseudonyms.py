"""Replacement texts: placeholders, and pseudonyms that are functions of the text alone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspan.functions.spans import let

# Placeholders and the parts of pseudonyms.
PLACEHOLDERS = {
    "email": "[REDACTED_EMAIL]", "phone": "[REDACTED_PHONE]", "credit_card": "[REDACTED_CARD]", "ssn": "[REDACTED_SSN]",
    "api_key": "[REDACTED_KEY]", "person_name": "[REDACTED_NAME]", "hostname": "[REDACTED_HOST]", "ip_address": "[REDACTED_IP]",
}
FIRST_NAMES = ("Alex", "Blake", "Casey", "Drew", "Emery", "Finley", "Gray", "Harley")
LAST_NAMES = ("Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis")
SEED = "pseudonym_seed"


def lookup(key: Column, table: Mapping[str, str], default: Column) -> Column:
    out = None
    for name, value in table.items():
        out = F.when(key == name, value) if out is None else out.when(key == name, value)
    return default if out is None else out.otherwise(default)


def chain(key: Column, forms: Mapping[str, Column], default: Column) -> Column:
    """One CASE with a branch for each key."""
    out = F
    for name, form in forms.items():
        out = out.when(key == name, form)
    return out.otherwise(default)


def placeholder(entity_type: Column) -> Column:
    return lookup(entity_type, PLACEHOLDERS, F.lit("[REDACTED]"))


def pseudonym(entity_type: Column, original: Column) -> Column:
    """From the SHA-256 of the lower-cased text: equal texts get equal pseudonyms on every machine."""
    return let(F.struct(F.sha2(F.lower(original), 256).alias("digest"), F.regexp_replace(entity_type, "^custom_", "").alias("kind"), entity_type.alias("type")), _pseudonym)


def _pseudonym(x: Column) -> Column:
    h = lambda n: F.substring(x["digest"], 1, n)
    forms = {
        "email": F.concat(F.lit("user_"), h(4), F.lit("@company.com")),
        "person_name": F.concat(F.lit("Person_"), h(8)),
        "hostname": F.concat(F.lit("server-"), h(3), F.lit(".internal")),
        "ip_address": F.concat(F.lit("192.168.1."), (F.conv(h(1), 16, 10).cast("int") % 254 + 1).cast("string")),
        "phone": F.concat(F.lit("+1-555-"), h(3), F.lit("-"), h(4)),
        "credit_card": F.concat(F.lit("CARD-****-****-****-"), h(4)),
        "ssn": F.concat(F.lit("SSN-***-**-"), h(4)),
        "customer_id": F.concat(F.lit("CUST_"), h(8)),
        "api_key": F.concat(F.lit("API_"), h(12)),
        "jira_ticket": F.concat(F.lit("REF-"), h(6)),
        "slack_channel": F.concat(F.lit("#channel-"), h(4)),
    }
    out = F.concat(F.lit("[PSEUDONYM_"), F.upper(x["type"]), F.lit("_"), h(8), F.lit("]"))
    return chain(x["kind"], forms, out)


def number(original: Column, seed: str = SEED) -> Column:
    """The MD5 of text and seed, modulo a million; the 128 bits are taken 32 at a time."""
    digest, out = F.md5(F.concat(original, F.lit(seed)).cast("binary")), F.lit(0).cast("long")
    for i in range(4):
        out = (out * (2**32 % 1_000_000) + F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")) % 1_000_000
    return out


def numbered_pseudonym(entity_type: Column, original: Column, seed: str = SEED) -> Column:
    """The pseudonyms of the audit rewrite, made from number()."""
    return let(F.struct(number(original, seed).alias("n"), entity_type.alias("type")), _numbered)


def _numbered(x: Column) -> Column:
    n = x["n"]
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    forms = {
        "email": F.concat(F.lit("user"), n.cast("string"), F.lit("@example.com")),
        "phone": F.concat(F.lit("+1-555-"), F.format_string("%04d", n)),
        "person_name": F.concat_ws(" ", pick(FIRST_NAMES, n % 8), pick(LAST_NAMES, F.floor(n / 8) % 8)),
        "hostname": F.concat(F.lit("server"), F.format_string("%03d", n), F.lit(".internal.com")),
        "ip_address": F.concat(F.lit("192.168."), (n % 256).cast("string"), F.lit("."), (n % 255).cast("string")),
        "api_key": F.concat(F.lit("ak_redacted_"), F.format_string("%08d", n)),
        "customer_id": F.concat(F.lit("cust_"), F.format_string("%06d", n)),
    }
    return chain(x["type"], forms, F.concat(F.lit("[REDACTED_"), x["type"], F.lit("]")))
