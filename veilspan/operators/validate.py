"""Validation of rewritten texts: residual and obfuscated identifiers, structure, consistency, metrics and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions import patterns as P
from veilspan.functions import pseudonyms as R
from veilspan.functions import spans as S

ISSUES = "array<struct<issue_type:string,severity:string,description:string,start:int,end:int,text:string,suggested_fix:string,confidence:double,method:string>>"
# Severities and suggested actions by scan.
SEVERITY = {
    "email_fragments": "critical", "ssn_fragments": "critical", "credit_card_fragments": "critical", "api_key_fragments": "critical",
    "phone_fragments": "high", "ip_address_fragments": "high",
}
PSEUDONYMIZED = ("ip_address_fragments", "customer_ids")
PENALTY = {"critical": 0.3, "high": 0.2, "medium": 0.1, "low": 0.05}


def _issue(kind: str, severity, description: Column, fix: Column, confidence, method, start=None, end=None, text=None) -> Column:
    lit = lambda x, t: x.cast(t) if isinstance(x, Column) else F.lit(x).cast(t)
    return F.struct(
        F.lit(kind).alias("issue_type"), lit(severity, "string").alias("severity"), description.alias("description"), lit(start, "int").alias("start"), lit(end, "int").alias("end"),
        lit(text, "string").alias("text"), fix.alias("suggested_fix"), lit(confidence, "double").alias("confidence"), lit(method, "string").alias("method"),
    )


def excluded(text: Column) -> Column:
    """Whether a match holds a marker, a pseudonym, an example or a reference."""
    out = F.lit(False)
    for p in P.EXCLUDED:
        out = out | text.rlike(p)
    return out


def residual_issues(text: Column, issued: Column, allowed: Column, names: Column | None = None, rules: P.Rules = P.UNICODE, signs: Column | None = None) -> Column:
    """Identifiers left in a text, but for issued pseudonyms and allowlisted originals. names: spans of a name detector. signs: see spans.signs."""
    every = []
    for name, pattern in rules.residual.items():
        severity, action, said = SEVERITY.get(name, "medium"), "PSEUDONYMIZE" if name in PSEUDONYMIZED else "REDACT", name.replace("_", " ")
        found = F.filter(S.find(text, pattern, None if signs is None else signs[name]), lambda h: ~(F.array_contains(issued, h["text"]) | F.array_contains(allowed, h["text"]) | excluded(h["text"])))
        row = lambda h: _issue("residual_pii", severity, F.concat(F.lit(f"Residual {said} detected: '"), h["text"], F.lit("'")), F.concat(F.lit(f"Apply {action} to '"), h["text"], F.lit("'")), 0.9, f"residual_pattern_{name}", h["start"], h["end"], h["text"])
        every.append(F.transform(found, row).cast(ISSUES))
    if names is not None:
        left = F.filter(names, lambda h: (h["type"] == "PERSON") & ~F.array_contains(allowed, h["text"]) & ~excluded(h["text"]))
        every.append(F.transform(left, lambda h: _issue("residual_pii", "high", F.concat(F.lit("Residual person name detected: '"), h["text"], F.lit("'")), F.concat(F.lit("Pseudonymize '"), h["text"], F.lit("'")), h["score"], "residual_person_ner", h["start"], h["end"], h["text"])).cast(ISSUES))
    return F.concat(*every)


def _digits(x: Column) -> Column:
    return F.length(F.regexp_replace(x, r"(?U)\D", ""))


def suspicious(name: str, x: Column) -> Column:
    """Whether a match of an adversarial scan looks like an identifier."""
    marked = x.contains("[REDACTED") | x.contains("Person_") | x.contains("server-")
    test = {
        "obfuscated_emails": x.contains("@") & x.contains(".") & (F.length(x) > 10),
        "spaced_phones": _digits(x) >= 10,
        "partial_ssns": _digits(x) == 9,
        "credit_card_variants": _digits(x) >= 13,
        "encoded_data": (F.length(x) > 20) & ~x.rlike(r"[^\p{L}\p{N}]"),
        "hex_patterns": F.length(x) >= 8,
    }[name]
    return test & ~marked


def adversarial_issues(text: Column, rules: P.Rules = P.UNICODE, signs: Column | None = None) -> Column:
    every = []
    for name, pattern in rules.adversarial.items():
        said = name.replace("_", " ")
        found = F.filter(S.find(text, pattern, None if signs is None else signs[name]), lambda h: suspicious(name, h["text"]))
        row = lambda h: _issue("residual_pii", "high", F.concat(F.lit(f"Potential obfuscated {said}: '"), h["text"], F.lit("'")), F.concat(F.lit("Investigate potential obfuscated PII: '"), h["text"], F.lit("'")), 0.8, f"adversarial_{name}", h["start"], h["end"], h["text"])
        every.append(F.transform(found, row).cast(ISSUES))
    return F.concat(*every)


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def structure_counts(text: Column, rules: P.Rules = P.UNICODE) -> dict[str, Column]:
    """Lines, structural patterns, brackets outside markers, and quotes of a text."""
    out = {"lines": _count(text, "\n") + 1}
    out |= {name: F.regexp_count(text, F.lit(p)) for name, p in rules.structure.items()}
    bare = F.regexp_replace(text, P.MARKER, "")
    return out | {"brackets": _count(bare, "[") + _count(bare, "]"), "quotes": _count(text, '"') + _count(text, "'")}


def schema_issues(before: Column, after: Column, rules: P.Rules = P.UNICODE) -> Column:
    """What of a text's structure the rewrite has changed. Markers are taken out of the rewritten text only."""
    counted = [structure_counts(before, rules), structure_counts(after, rules)]
    counted[0]["brackets"] = _count(before, "[") + _count(before, "]")
    return S.let(F.struct(*[F.struct(*[v.alias(k) for k, v in c.items()]).alias(n) for n, c in zip("ab", counted, strict=True)]), lambda x: _schema_issues(x["a"], x["b"]))


def _schema_issues(a: Column, b: Column) -> Column:
    said = lambda word, name, arrow: F.concat(F.lit(word), a[name].cast("string"), F.lit(arrow), b[name].cast("string"))
    row = lambda severity, description, fix, confidence, method: _issue("schema_violation", severity, description, F.lit(fix), confidence, method)
    found = [F.when(a["lines"] != b["lines"], row("high", F.concat(F.lit("Line count mismatch: original "), a["lines"].cast("string"), F.lit(" vs processed "), b["lines"].cast("string")), "Review text processing for line break preservation", 1.0, "schema_validation"))]
    found += [F.when(a[n] != b[n], row("medium", said(f"{n} structure altered: ", n, " → "), f"Preserve {n} structure during redaction", 0.8, "schema_validation")) for n in P.STRUCTURE]
    found.append(F.when(F.abs(a["brackets"] - b["brackets"]) > 2, row("medium", said("Bracket count mismatch: ", "brackets", " → "), "Review bracket/parenthesis preservation", 0.7, "formatting_validation")))
    found.append(F.when(F.abs(a["quotes"] - b["quotes"]) > 2, row("low", said("Quote count mismatch: ", "quotes", " → "), "Review quote preservation", 0.6, "formatting_validation")))
    return F.array_compact(F.array(*found)).cast(ISSUES)


def consistency_issues(d: Column) -> Column:
    """Pseudonym keys with several replacements, and entity types with several actions (allowlisted spans aside)."""
    made = F.filter(d, lambda x: x["pseudonym_key"].isNotNull())
    keys = F.array_distinct(F.transform(made, lambda x: x["pseudonym_key"]))
    used = lambda k: F.array_distinct(F.transform(F.filter(made, lambda x: x["pseudonym_key"] == k), lambda x: x["replacement"]))
    mixed = F.transform(F.filter(keys, lambda k: F.size(used(k)) > 1), lambda k: _issue("inconsistency", "high", F.concat(F.lit("Inconsistent pseudonyms for '"), k, F.lit("': "), F.array_join(used(k), ", ")), F.concat(F.lit("Use consistent pseudonym for '"), k, F.lit("'")), 1.0, "consistency_check")).cast(ISSUES)
    free = F.filter(d, lambda x: ~x["reasoning"].startswith("Allowlist override"))
    types = F.array_distinct(F.transform(free, lambda x: x["entity_type"]))
    acts = lambda t: F.array_distinct(F.transform(F.filter(free, lambda x: x["entity_type"] == t), lambda x: x["final_action"]))
    several = F.transform(F.filter(types, lambda t: F.size(acts(t)) > 1), lambda t: _issue("inconsistency", "medium", F.concat(F.lit("Mixed actions for "), t, F.lit(": "), F.array_join(acts(t), ", ")), F.concat(F.lit("Review "), t, F.lit(" redaction strategy for consistency")), 0.7, "consistency_check")).cast(ISSUES)
    return F.concat(mixed, several)


def count(issues: Column, field: str, value: str) -> Column:
    return F.size(F.filter(issues, lambda x: x[field] == value))


def quality_metrics(n: Column, residual: Column, schema: Column, inconsistent: Column, by_severity: dict[str, Column]) -> Column:
    """Metrics from counts: n decisions, issues by type and by severity."""
    names = {"n": n.cast("double"), "r": residual.cast("double"), "schema": schema, "inconsistent": inconsistent.cast("double")} | {s: c.cast("double") for s, c in by_severity.items()}
    return S.let(F.struct(*[c.alias(k) for k, c in names.items()]), _metrics)


def _metrics(x: Column) -> Column:
    n, r = x["n"], x["r"]
    ratio = lambda a, b, empty: F.when(b > 0, a / b).otherwise(F.lit(empty))
    precision, recall = ratio(F.greatest(F.lit(0.0), n - r), n, 1.0), ratio(n, n + r, 1.0)
    both = precision + recall
    penalty = sum((x[s] * F.lit(w) for s, w in list(PENALTY.items())[1:]), x["critical"] * F.lit(PENALTY["critical"]))
    return F.struct(
        precision.alias("precision"), recall.alias("recall"), F.when(both > 0, 2 * (precision * recall) / both).otherwise(F.lit(0.0)).alias("f1_score"),
        ratio(r, n, 0.0).alias("false_positive_rate"), ratio(r, n + r, 0.0).alias("false_negative_rate"), r.cast("int").alias("residual_pii_count"), x["schema"].cast("int").alias("schema_violations"),
        F.greatest(F.lit(0.0), F.lit(1.0) - x["inconsistent"] / F.greatest(F.lit(1.0), n)).alias("consistency_score"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - penalty)).alias("overall_quality_score"),
    )


def recommendations(issues: Column, m: Column) -> Column:
    critical, residual, schema, mixed = count(issues, "severity", "critical"), count(issues, "issue_type", "residual_pii"), count(issues, "issue_type", "schema_violation"), count(issues, "issue_type", "inconsistency")
    says = lambda word: F.exists(issues, lambda i: i["description"].contains(word))
    numbered = lambda n, before, after: F.when(n > 0, F.concat(F.lit(before), n.cast("string"), F.lit(after)))
    return F.array_compact(F.array(
        F.when(m["overall_quality_score"] < F.lit(0.8), "Overall quality score below threshold (0.8). Review redaction strategy."),
        F.when(m["precision"] < F.lit(0.9), "Precision below 90%. Consider refining detection patterns."),
        F.when(m["recall"] < F.lit(0.95), "Recall below 95%. Consider additional detection methods."),
        numbered(critical, "Address ", " critical issues immediately."),
        numbered(residual, "Review ", " residual PII detections."),
        numbered(schema, "Fix ", " schema integrity issues."),
        numbered(mixed, "Resolve ", " consistency issues."),
        F.when(says("email"), "Review email detection patterns for completeness."),
        F.when(says("phone"), "Review phone number detection patterns."),
        F.when(says("obfuscated"), "Consider additional adversarial detection methods."),
    ))


def validate(df: DataFrame, text: str = "text", processed: str = "processed_text", decisions: str = "decisions", names: str | None = None, rules: P.Rules = P.UNICODE) -> DataFrame:
    """df with issues, quality_metrics and recommendations. names: spans that a name detector found in the processed text."""
    t, p, d = F.col(f"`{text}`"), F.col(f"`{processed}`"), F.col(f"`{decisions}`")
    issued = F.transform(F.filter(d, lambda x: x["final_action"] == "PSEUDONYMIZE"), lambda x: x["replacement"])
    allowed = F.transform(F.filter(d, lambda x: (x["final_action"] == "RETAIN") & x["reasoning"].startswith("Allowlist override")), lambda x: x["original_text"])
    df = df.withColumn("__signs", S.signs(p, rules, *rules.residual, *rules.adversarial)).withColumn("__issued", issued).withColumn("__allowed", allowed)
    df = df.withColumn("__residual", residual_issues(p, F.col("__issued"), F.col("__allowed"), F.col(f"`{names}`") if names else None, rules, F.col("__signs")))
    df = df.withColumn("__adversarial", adversarial_issues(p, rules, F.col("__signs"))).withColumn("__schema", schema_issues(t, p, rules)).withColumn("__consistency", consistency_issues(d))
    df = df.withColumn("issues", F.concat("__residual", "__schema", "__consistency", "__adversarial"))
    i = F.col("issues")
    metrics = quality_metrics(F.size(d), count(i, "issue_type", "residual_pii"), count(i, "issue_type", "schema_violation"), count(i, "issue_type", "inconsistency"), {s: count(i, "severity", s) for s in PENALTY})
    df = df.withColumn("quality_metrics", metrics).withColumn("recommendations", recommendations(i, F.col("quality_metrics")))
    checks = F.struct(
        F.size("__residual").alias("residual_pii_detected"), F.size("__adversarial").alias("adversarial_issues_found"), (F.size("__residual") + F.size("__adversarial")).alias("total_pattern_matches"),
        F.size("__schema").alias("schema_violations"), (F.size("__schema") == 0).alias("structure_preserved"), F.size(F.filter("__schema", lambda x: x["method"].contains("formatting"))).alias("formatting_issues"),
        F.lit(len(P.ADVERSARIAL)).alias("adversarial_patterns_checked"),
    )
    return df.withColumn("checks", checks).drop("__signs", "__issued", "__allowed", "__residual", "__adversarial", "__schema", "__consistency")
