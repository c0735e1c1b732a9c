"""SQL for the engine's main results: detection, arbitration, rewriting, validation and summaries of a table `documents`.

Everything is written from the semantics of the stages, not from their column
expressions: one common table expression for each stage. RE2 has no lookaround;
the patterns below stand for those of functions/patterns.py wherever no letter
stands directly beside a number and no sign of a word beside a host or ticket.
"""

from __future__ import annotations

import re

from veilspan.functions import patterns as P
from veilspan.functions import pseudonyms as R
from veilspan.operators import decide, detect, judge, validate
from veilspan.operators.policy import Allowlist, Policy

# Next to a digit, "no word sign" is a word boundary; next to a bracket or a plus it is its absence.
PLAIN = {
    "phone": r"(?:\B\+1[-.\s]?\(?|\b1[-.\s]?\(?|\B\(|\b)\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "credit_card": r"\b(?:\d{4}[- ]?){3}\d{4}\b",
    "hostname": r"(?i)\b(?:[a-z0-9][a-z0-9-]*\.)+(?:internal|local|corp|svc|cluster|(?:us|eu|ap)-[a-z]+-\d)\b",
    "jira_ticket": r"\b[A-Z]{2,}-\d+\b",
}


def sql_pattern(pattern: str) -> str:
    """A pattern for SQL: without the flags that only Java knows, as the body of a string literal."""
    m = re.match(r"\(\?([a-zA-Z]+)\)", pattern)
    if m:
        kept = "".join(c for c in m[1] if c in "ims")
        pattern = (f"(?{kept})" if kept else "") + pattern[m.end() :]
    return pattern.replace("++", "+").replace("*+", "*").replace("'", "''")


def hits_sql(pattern: str, text: str = "text") -> str:
    return f"coalesce(regexp_extract_all({text}, '{sql_pattern(pattern)}'), [])"


def spans_sql(pattern: str, more: str = "", table: str = "documents") -> str:
    """Rows (doc_id, start, end, text) of all matches; offsets are running lengths of gaps and matches."""
    p = sql_pattern(pattern)
    return f"""
WITH m AS (SELECT doc_id, text AS whole, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS gaps FROM {table}),
k AS (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM m),
s AS (
  SELECT doc_id, whole, hits[k] AS text,
    (list_sum(list_transform(gaps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda x: length(x))), 0))::INTEGER AS start
  FROM k
)
SELECT doc_id, start, (start + length(text))::INTEGER AS "end", text{more} FROM s"""


_APART = 'NOT EXISTS (SELECT 1 FROM {old} o WHERE o.doc_id = n.doc_id AND o.start < n."end" AND n.start < o."end")'


def _rule(name: str, pattern: str, entity_type: str, confidence: float, method: str, category: str, action: str, rank: int) -> str:
    kind = f"'{entity_type}' AS entity_type, {confidence}::DOUBLE AS confidence, '{method}' AS method, '{category}' AS category, '{action}' AS action, {rank} AS rank"
    return f"{name} AS (SELECT n.*, {kind} FROM ({spans_sql(PLAIN.get(entity_type.removeprefix('custom_'), pattern))}) n)"


def detected_ctes() -> list[str]:
    """spans(doc_id, start, end, text, entity_type, confidence, method, category, action): all rules, priorities and overlaps."""
    policy = Policy.default()
    ctes = [_rule("a0", P.IPV4, "ip_address", 0.6, "ipv4", policy.category("ip_address"), policy.action("ip_address"), 0), "u0 AS (SELECT * FROM a0)"]
    n = 0
    for name, pattern in P.SAFETY.items():
        n += 1
        ctes.append(_rule(f"f{n}", pattern, name, 0.95, "regex_fallback", policy.category(name), policy.action(name), n))
        ctes.append(f"u{n} AS (SELECT * FROM u{n - 1} UNION ALL SELECT n.* FROM f{n} n WHERE {_APART.format(old=f'u{n - 1}')})")
    safe = n
    for name, pattern in P.CUSTOM.items():
        n += 1
        ctes.append(_rule(f"f{n}", pattern, f"custom_{name}", 0.8, "regex", *detect.CUSTOM_KIND[name], n))
        ctes.append(f"u{n} AS (SELECT * FROM u{n - 1} UNION ALL SELECT n.* FROM f{n} n WHERE {_APART.format(old=f'u{safe}')})")
    n += 1
    ctes.append(_rule(f"f{n}", P.SECRET_ASSIGNMENT, "api_key", 0.9, "keyword_assignment", "SECRETS", "REDACT", n))
    ctes.append(f"u{n} AS (SELECT * FROM u{n - 1} UNION ALL SELECT n.* FROM f{n} n WHERE {_APART.format(old=f'u{n - 1}')})")
    # Of two that overlap the surer stays, else the shorter, else the first; each is held against the last one kept.
    better = "x[1].s.confidence > acc[-1].s.confidence OR (x[1].s.confidence = acc[-1].s.confidence AND length(x[1].s.text) < length(acc[-1].s.text))"
    step = f'CASE WHEN x[1].s.start >= acc[-1].s."end" THEN list_concat(acc, x) WHEN {better} THEN list_concat(acc[:-2], x) ELSE acc END'
    ctes.append(f'g AS (SELECT doc_id, list([{{s: u}}] ORDER BY start, rank) AS l FROM (SELECT doc_id, start, rank, {{start: start, "end": "end", text: text, entity_type: entity_type, confidence: confidence, method: method, category: category, action: action}} AS u FROM u{n}) GROUP BY doc_id)')
    ctes.append(f"r AS (SELECT doc_id, unnest(list_reduce(l, lambda acc, x: {step})) AS v FROM g)")
    ctes.append('spans AS (SELECT doc_id, v.s.start AS start, v.s."end" AS "end", v.s.text AS text, v.s.entity_type AS entity_type, v.s.confidence AS confidence, v.s.method AS method, v.s.category AS category, v.s.action AS action FROM r)')
    return ctes


def _with(ctes: list[str], select: str) -> str:
    # Each stage is computed once: a stage is read by several later ones, and inlining it would double the work with each.
    return "WITH " + ",\n".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes) + "\n" + select


def _any(words, text: str) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


WINDOW = "lower(substr(whole, greatest(0, start - 100) + 1, least(length(whole), start + length(text) + 100) - greatest(0, start - 100)))"
SNIPPET = "CASE WHEN start > 75 THEN '...' ELSE '' END || substr(whole, greatest(0, start - 75) + 1, least(length(whole), start + length(text) + 75) - greatest(0, start - 75)) || CASE WHEN start + length(text) + 75 < length(whole) THEN '...' ELSE '' END"
SCORE = "0.5::DOUBLE" + "".join(f" + CASE WHEN {_any(w, 'w')} THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END" for w in detect.KEYWORDS.values())
SCORE += f" + CASE WHEN {_any(detect.PRIVACY_WORDS, 'w')} THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN {_any(detect.INCIDENT_WORDS, 'w')} THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END"
SCORE += " + CASE WHEN length(text) > 20 THEN 0.1::DOUBLE WHEN length(text) < 5 THEN -0.1::DOUBLE ELSE 0.0::DOUBLE END"
SCORE = f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, {SCORE}))"


def contextual_ctes() -> list[str]:
    """contextual(doc_id, start, end, text, entity_type, confidence, span_id, rank), beside spans."""
    each = [f"SELECT n.doc_id, n.start, n.\"end\", n.text, n.snippet, 'contextual_{name}' AS entity_type, {SCORE} AS confidence, 'llm_{name}_' || start || '_' || \"end\" AS span_id, {k} AS rank FROM ({spans_sql(pattern, f', {WINDOW} AS w, {SNIPPET} AS snippet')}) n" for k, (name, pattern) in enumerate(P.CONTEXTUAL.items())]
    return ["context_found AS (" + "\nUNION ALL ".join(each) + ")", f"contextual AS (SELECT n.* FROM context_found n WHERE confidence >= 0.6::DOUBLE AND {_APART.format(old='spans')})"]


def _case(column: str, table: dict[str, str], default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {default} END"


def _pseudonym(kind: str, h: str) -> str:
    part = lambda n: f"substr({h}, 1, {n})"
    forms = {
        "person_name": f"'Person_' || {part(8)}", "hostname": f"'server-' || {part(3)} || '.internal'", "ip_address": f"'192.168.1.' || (('0x' || {part(1)})::INTEGER % 254 + 1)", "customer_id": f"'CUST_' || {part(8)}", "jira_ticket": f"'REF-' || {part(6)}",
    }
    return f"CASE regexp_replace({kind}, '^custom_', '') " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in forms.items()) + f" ELSE '[PSEUDONYM_' || upper({kind}) || '_' || {part(8)} || ']' END"


def decided_ctes() -> list[str]:
    """decisions, one for each detected and contextual span, in order within a document.

    A judge has no vote, so the finder's vote of 2 always outweighs the detector's of 1.
    """
    allowed = Allowlist.default()
    match = "CASE " + (f"WHEN lower(trim(text)) IN ({', '.join(repr(x) for x in allowed.literals)}) THEN lower(trim(text)) " if allowed.literals else "") + " ".join(f"WHEN regexp_matches(trim(text), '{p}') THEN '{p}'" for p in allowed.patterns) + " END"
    forced, protected = ("entity_type IN (" + ", ".join(f"'{x}'" for x in kinds) + ")" for kinds in (decide.FORCED, decide.PROTECTED))
    votes = "CASE WHEN action IS NOT NULL THEN 'deterministic: ' || action || ' (weight: 1); ' ELSE '' END || 'llm_finder: ' || finder || ' (weight: 2)'"
    first = 'SELECT *, row_number() OVER (PARTITION BY doc_id, start, "end" ORDER BY confidence DESC, rank) AS k FROM contextual'
    return [
        f"every AS (SELECT doc_id, start, \"end\", text, entity_type, confidence, action, false AS from_context, 0 AS part, start AS ordinal, 0 AS rank, 0.0::DOUBLE AS less FROM spans UNION ALL SELECT doc_id, start, \"end\", text, entity_type, confidence, NULL, true, 1, start, rank, -confidence FROM ({first}) WHERE k = 1)",
        f"voted AS (SELECT *, {_case('entity_type', decide.FINDER, chr(39) + 'RETAIN' + chr(39))} AS finder, {match} AS matched FROM every)",
        f"settled AS (SELECT *, CASE WHEN {forced} THEN 'REDACT' ELSE finder END AS decided, CASE WHEN {forced} THEN 'Forced rule: ' || entity_type || ' entities are always REDACT' ELSE 'Arbitration result: ' || {votes} || CASE WHEN {protected} THEN '; Context-adjusted to: ' || finder ELSE '' END END AS reason FROM voted)",
        "final AS (SELECT *, CASE WHEN matched IS NOT NULL AND decided <> 'RETAIN' THEN 'RETAIN' ELSE decided END AS final_action, CASE WHEN matched IS NOT NULL AND decided <> 'RETAIN' THEN 'Allowlist override (matched ''' || matched || '''): ' || reason ELSE reason END AS reasoning, sha256(lower(text)) AS h FROM settled)",
        f"""decisions AS (SELECT doc_id, 'arbitration_' || (row_number() OVER (PARTITION BY doc_id ORDER BY part, less, rank, ordinal) - 1) AS entity_id, entity_type, text AS original_text, start, "end", final_action, confidence AS final_confidence, action AS deterministic_action, finder AS finder_action, reasoning,
  CASE WHEN from_context THEN 'llm_finder' ELSE 'deterministic,llm_finder' END AS sources,
  CASE final_action WHEN 'REDACT' THEN {_case("entity_type", R.PLACEHOLDERS, "'[REDACTED]'")} WHEN 'PSEUDONYMIZE' THEN {_pseudonym("entity_type", "h")} ELSE text END AS replacement,
  CASE WHEN final_action = 'PSEUDONYMIZE' THEN entity_type || ':' || lower(text) END AS pseudonym_key, {_case("final_action", decide.REDACTION_TYPE, "'contextual_retain'")} AS redaction_type FROM final)""",
    ]


def rewritten_ctes() -> list[str]:
    """processed(doc_id, before, text): the text with every edit in its place."""
    return [
        "edits AS (SELECT doc_id, start, \"end\", replacement, coalesce(lag(\"end\") OVER (PARTITION BY doc_id ORDER BY start), 0) AS at FROM decisions WHERE final_action <> 'RETAIN')",
        "parts AS (SELECT e.doc_id, string_agg(substr(d.text, e.at + 1, e.start - e.at) || e.replacement, '' ORDER BY e.start) AS head, max(e.\"end\") AS done FROM edits e JOIN documents d USING (doc_id) GROUP BY e.doc_id)",
        "processed AS (SELECT d.doc_id, d.text AS before, CASE WHEN p.doc_id IS NULL THEN coalesce(d.text, '') ELSE p.head || substr(d.text, p.done + 1) END AS text FROM documents d LEFT JOIN parts p USING (doc_id))",
    ]


RESIDUAL = {n: hits_sql(p) for n, p in P.RESIDUAL.items()} | {"internal_paths": r"coalesce(regexp_extract_all(text, '(?:^|\W)(/[a-zA-Z0-9_.-]+(?:/[a-zA-Z0-9_.-]+)+)', 1), [])"}
EXCLUDED = " OR ".join(f"regexp_matches(x, '{sql_pattern(p)}')" for p in P.EXCLUDED)
SUSPICIOUS = {
    "obfuscated_emails": "contains(x, '@') AND contains(x, '.') AND length(x) > 10",
    "spaced_phones": r"length(regexp_replace(x, '\D', '', 'g')) >= 10",
    "partial_ssns": r"length(regexp_replace(x, '\D', '', 'g')) = 9",
    "credit_card_variants": r"length(regexp_replace(x, '\D', '', 'g')) >= 13",
    "encoded_data": "length(x) > 20 AND NOT regexp_matches(x, '[^A-Za-z0-9]')",
    "hex_patterns": "length(x) >= 8",
}
MARKED = "contains(x, '[REDACTED') OR contains(x, 'Person_') OR contains(x, 'server-')"


def count_sql(c: str, t: str = "text") -> str:
    return f"(length({t}) - length(replace({t}, '{c}', '')))"


def structure_sql(t: str, bare: bool) -> dict[str, str]:
    inner = f"regexp_replace({t}, '{sql_pattern(P.MARKER)}', '', 'g')" if bare else t
    return {"lines": f"({count_sql(chr(10), t)} + 1)"} | {n: f"len({hits_sql(p, t)})" for n, p in P.STRUCTURE.items()} | {"brackets": f"({count_sql('[', inner)} + {count_sql(']', inner)})", "quotes": f"({count_sql(chr(34), t)} + {count_sql(chr(39) * 2, t)})"}


def validated_ctes() -> list[str]:
    """metrics(doc_id, ...): counts of issues of the processed texts and the metrics made from them."""
    issued = "SELECT doc_id, list(replacement) FILTER (WHERE final_action = 'PSEUDONYMIZE') AS issued, list(original_text) FILTER (WHERE final_action = 'RETAIN' AND starts_with(reasoning, 'Allowlist override')) AS allowed, count(*) AS n FROM decisions GROUP BY doc_id"
    residual = ", ".join(f"len(list_filter({h}, lambda x: NOT ({EXCLUDED}) AND NOT coalesce(list_contains(issued, x), false) AND NOT coalesce(list_contains(allowed, x), false))) AS {n}" for n, h in RESIDUAL.items())
    adversarial = ", ".join(f"len(list_filter({hits_sql(p)}, lambda x: {SUSPICIOUS[n]} AND NOT ({MARKED}))) AS {n}" for n, p in P.ADVERSARIAL.items())
    a, b = structure_sql("before", False), structure_sql("text", True)
    changed = [f"CASE WHEN {a[n]} <> {b[n]} THEN 1 ELSE 0 END" for n in P.STRUCTURE]
    brackets, quotes, lines = (f"CASE WHEN abs({a[n]} - {b[n]}) > {k} THEN 1 ELSE 0 END" for n, k in (("brackets", 2), ("quotes", 2), ("lines", 0)))
    by = {s: " + ".join(n for n in P.RESIDUAL if validate.SEVERITY.get(n, "medium") == s) for s in ("critical", "high", "medium")}
    tricks = " + ".join(P.ADVERSARIAL)
    return [
        f"known AS ({issued})",
        f"counted AS (SELECT p.doc_id, p.before, p.text, coalesce(k.n, 0)::DOUBLE AS n, {residual}, {adversarial}, ({lines}) AS line_issues, ({' + '.join(changed)}) AS pattern_issues, ({brackets}) AS bracket_issues, ({quotes}) AS quote_issues FROM (SELECT doc_id, coalesce(before, '') AS before, text FROM processed) p LEFT JOIN known k USING (doc_id))",
        "mixed AS (SELECT doc_id, count(*) AS mixed FROM (SELECT doc_id, entity_type FROM decisions WHERE NOT starts_with(reasoning, 'Allowlist override') GROUP BY doc_id, entity_type HAVING count(DISTINCT final_action) > 1) GROUP BY doc_id)",
        f"added AS (SELECT c.*, coalesce(m.mixed, 0) AS inconsistent, ({' + '.join(P.RESIDUAL)}) AS residual, ({tricks}) AS adversarial, line_issues + pattern_issues + bracket_issues + quote_issues AS schema_n FROM counted c LEFT JOIN mixed m USING (doc_id))",
        f"weighed AS (SELECT *, (residual + adversarial)::DOUBLE AS r, ({by['critical']}) AS critical, ({by['high']} + {tricks} + line_issues) AS high, ({by['medium']} + pattern_issues + bracket_issues + inconsistent) AS medium, quote_issues AS low FROM added)",
        "rates AS (SELECT *, CASE WHEN n > 0 THEN greatest(0.0::DOUBLE, n - r) / n ELSE 1.0::DOUBLE END AS precision, CASE WHEN n + r > 0 THEN n / (n + r) ELSE 1.0::DOUBLE END AS recall FROM weighed)",
        """metrics AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * (precision * recall) / (precision + recall) ELSE 0.0::DOUBLE END AS f1_score, CASE WHEN n > 0 THEN r / n ELSE 0.0::DOUBLE END AS false_positive_rate,
  CASE WHEN n + r > 0 THEN r / (n + r) ELSE 0.0::DOUBLE END AS false_negative_rate, greatest(0.0::DOUBLE, 1.0::DOUBLE - inconsistent / greatest(1.0::DOUBLE, n)) AS consistency_score,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - (critical * 0.3::DOUBLE + high * 0.2::DOUBLE + medium * 0.1::DOUBLE + low * 0.05::DOUBLE))) AS overall_quality_score,
  CASE WHEN length(before) > 0 THEN (length(before) - length(text))::DOUBLE / length(before) * 100 ELSE 0.0::DOUBLE END AS reduction FROM rates)""",
    ]


LOW = "(" + " OR ".join(f"{m} < 0.7::DOUBLE" for m in ("overall_quality_score", "precision", "recall", "f1_score")) + ")"
SERIOUS = "(critical > 0 OR high > 0 OR r > 0 OR schema_n > 0)"
REASON = f"""CASE WHEN {LOW} OR {SERIOUS} THEN concat_ws('; ', CASE WHEN {LOW} THEN 'one or more quality metrics below threshold 0.70' END, CASE WHEN {SERIOUS} THEN 'validation found residual PII, schema violations, or high-severity issues' END)
  ELSE 'quality score ' || printf('%.3f', overall_quality_score) || ' meets threshold 0.70' END"""


def detected() -> str:
    return _with(detected_ctes(), "SELECT * FROM spans")


def arbitrated() -> str:
    return _with([*detected_ctes(), *contextual_ctes(), *decided_ctes()], "SELECT * FROM decisions")


def redacted() -> str:
    ctes = [*detected_ctes(), "contextual AS (SELECT doc_id, start, \"end\", text, entity_type, confidence, '' AS span_id, 0 AS rank FROM spans WHERE false)", *decided_ctes(), *rewritten_ctes()]
    return _with(ctes, "SELECT p.doc_id, p.text AS redacted_text, coalesce(s.n, 0)::INTEGER AS n_entities FROM processed p LEFT JOIN (SELECT doc_id, count(*) AS n FROM spans GROUP BY doc_id) s USING (doc_id)")


_ALL = [*detected_ctes(), *contextual_ctes(), *decided_ctes(), *rewritten_ctes(), *validated_ctes()]


def processed() -> str:
    return _with(
        _ALL,
        f"""SELECT doc_id, text AS processed_text, (residual + adversarial + schema_n + inconsistent)::INTEGER AS n_issues, precision, recall, f1_score, false_positive_rate, false_negative_rate, r::INTEGER AS residual_pii_count, schema_n::INTEGER AS schema_violations, consistency_score, overall_quality_score,
  residual::INTEGER AS residual_pii_detected, adversarial::INTEGER AS adversarial_issues_found, schema_n = 0 AS structure_preserved, {LOW} OR {SERIOUS} AS needs_review, {REASON} AS reason FROM metrics""",
    )


def summarized() -> str:
    return _with(
        [*_ALL, "pseudo AS (SELECT doc_id, count(DISTINCT pseudonym_key) AS k FROM decisions GROUP BY doc_id)"],
        f"""SELECT lang, count(*) AS total_documents, count(*) AS successful_documents, 0::BIGINT AS failed_documents, round(avg(overall_quality_score), 6) AS average_quality_score, round(avg(reduction), 6) AS average_text_reduction, coalesce(sum(k), 0)::BIGINT AS total_pseudonyms_generated,
  sum(residual + adversarial + schema_n + inconsistent)::BIGINT AS total_validation_issues, sum(critical)::BIGINT AS total_critical_issues, count(*) FILTER (WHERE {LOW} OR {SERIOUS}) AS documents_needing_review, 0::BIGINT AS documents_reviewed, 0::BIGINT AS documents_flagged
FROM metrics JOIN documents USING (doc_id) LEFT JOIN pseudo USING (doc_id) GROUP BY lang""",
    )


def counters() -> str:
    kinds = ("REDACT", "redactions_applied"), ("PSEUDONYMIZE", "pseudonymizations_applied"), ("RETAIN", "retentions_applied")
    parts = ", ".join(f"count(e.doc_id) FILTER (WHERE final_action = '{a}') AS {n}" for a, n in kinds)
    return _with(
        [*detected_ctes(), *contextual_ctes(), *decided_ctes()],
        f"SELECT d.lang, count(e.doc_id) AS total_entities_processed, {parts}, count(*) FILTER (WHERE contains(sources, ',')) AS conflicts_resolved, count(*) FILTER (WHERE contains(reasoning, 'Forced rule')) AS force_rules_applied, count(*) FILTER (WHERE contains(reasoning, 'Context-adjusted')) AS context_adjustments, count(*) FILTER (WHERE starts_with(reasoning, 'Allowlist override')) AS allowlist_overrides FROM documents d LEFT JOIN decisions e USING (doc_id) GROUP BY d.lang",
    )


def findings_ctes() -> list[str]:
    """findings(doc_id, span_id, text, entity_type, confidence): candidates and contextual spans."""
    return ["findings AS (SELECT doc_id, 'span_' || start || '_' || \"end\" AS span_id, text, entity_type, confidence FROM spans UNION ALL SELECT doc_id, span_id, text, entity_type, confidence FROM contextual)"]


def finder() -> str:
    band = lambda test: f"count(f.doc_id) FILTER (WHERE {test})::INTEGER"
    return _with(
        [*detected_ctes(), *contextual_ctes(), *findings_ctes()],
        f"""SELECT d.doc_id, count(f.doc_id)::INTEGER AS llm_detections_found, {band("contains(span_id, 'llm_')")} AS additional_contextual_detections, round(coalesce(avg(confidence), 0.0), 6) AS avg_confidence, {band("confidence >= 0.8::DOUBLE")} AS high_confidence_detections,
  {band("confidence >= 0.6::DOUBLE AND confidence < 0.8::DOUBLE")} AS medium_confidence_detections, {band("confidence < 0.6::DOUBLE")} AS low_confidence_detections, {band("NOT contains(span_id, 'llm_')")} AS enhanced_deterministic FROM documents d LEFT JOIN findings f USING (doc_id) GROUP BY d.doc_id""",
    )


def _judged_ctes() -> list[str]:
    low = "lower(entity_type)"
    hard, soft, secret = _any(("email", "credit_card", "ssn"), low), _any(("person_name", "salary"), low), f"contains({low}, 'secret')"
    auto = f"(confidence >= 0.95::DOUBLE AND NOT {secret})"
    return [
        *detected_ctes(), *contextual_ctes(), *findings_ctes(),
        f"judged AS (SELECT doc_id, entity_type, {auto} AS auto, CASE WHEN {auto} THEN CASE WHEN contains({low}, 'email') THEN 'REDACT' WHEN contains({low}, 'person_name') THEN 'PSEUDONYMIZE' ELSE 'RETAIN' END WHEN {hard} THEN 'REDACT' WHEN {soft} THEN 'PSEUDONYMIZE' ELSE 'RETAIN' END AS action, CASE WHEN {auto} THEN confidence ELSE 0.85::DOUBLE END AS sure FROM findings)",
    ]


def judged() -> str:
    count = lambda a: f"count(*) FILTER (WHERE action = '{a}') AS {a.lower()}"
    return _with(_judged_ctes(), f"SELECT entity_type, count(*) AS decisions, {count('REDACT')}, {count('PSEUDONYMIZE')}, {count('RETAIN')}, count(*) FILTER (WHERE auto) AS auto_decisions, round(avg(sure), 6) AS avg_decision_confidence FROM judged GROUP BY entity_type")


def policy_kept() -> str:
    level = "CASE WHEN NOT auto AND action = 'REDACT' THEN 'HIGH' ELSE 'MEDIUM' END"
    risk = ", ".join(f"count(*) FILTER (WHERE {level} = '{x}') AS risk_{x.lower()}" for x in judge.LEVELS)
    acts = ", ".join(f"count(*) FILTER (WHERE action = '{a}') AS {a.lower()}" for a in ("REDACT", "PSEUDONYMIZE", "RETAIN"))
    return _with(_judged_ctes(), f"SELECT lang, count(*) AS total_decisions, 1.0::DOUBLE AS policy_compliance_rate, {risk}, {acts}, string_agg(DISTINCT CASE WHEN auto THEN 'policy_auto' ELSE 'simulated_strict' END, ',' ORDER BY CASE WHEN auto THEN 'policy_auto' ELSE 'simulated_strict' END) AS models FROM judged JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) GROUP BY lang")
