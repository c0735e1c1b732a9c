"""Detection: spans of a text column, found natively.

Every function adds or reads array columns of one row. `ner` is an optional array
of spans from a plug-in detector (operators/plugins.py); it comes before all rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions import patterns as P
from veilspan.functions import spans as S
from veilspan.operators.policy import Policy

# Category and action of the custom patterns, and the entity names of plug-in detectors.
CUSTOM_KIND = {
    "internal_url": ("SECRETS", "REDACT"), "jira_ticket": ("OPERATIONAL_IDENTIFIERS", "PSEUDONYMIZE"), "aws_arn": ("SECRETS", "REDACT"),
    "kubernetes_pod": ("OPERATIONAL_IDENTIFIERS", "PSEUDONYMIZE"), "slack_channel": ("CUSTOMER_ORG_INFO", "RETAIN"), "docker_image": ("OPERATIONAL_IDENTIFIERS", "PSEUDONYMIZE"),
}
NER_TYPES = {
    "EMAIL_ADDRESS": "email", "PHONE_NUMBER": "phone", "PERSON": "person_name", "CREDIT_CARD": "credit_card",
    "US_SSN": "ssn", "LOCATION": "address", "IP_ADDRESS": "ip_address",
}
KEYWORDS = {
    "sensitive": ("confidential", "private", "restricted", "classified", "security breach", "data leak"),
    "internal": ("internal meeting", "team chat", "staff discussion", "employee review", "company policy"),
    "financial": ("revenue", "profit", "loss", "budget", "expense", "investment", "cost"),
    "operational": ("incident response", "crisis management", "business continuity", "disaster recovery"),
}
PRIVACY_WORDS = ("pii", "gdpr", "ccpa", "sox", "hipaa", "compliance", "privacy", "protection")
INCIDENT_WORDS = ("incident", "breach", "outage", "failure", "issue", "problem", "alert")
CANDIDATES = "array<struct<span_id:string,start:int,end:int,text:string,entity_type:string,confidence:double,method:string,context:string,requires_review:boolean>>"
CONTEXTUAL = "array<struct<span_id:string,start:int,end:int,text:string,entity_type:string,confidence:double,snippet:string>>"


def ner_spans(found: Column, policy: Policy) -> Column:
    """Spans of a plug-in's array<struct<start,end,text,type,score>>; types without a policy pattern are dropped."""
    known = {k: v for k, v in NER_TYPES.items() if v in policy.categories}

    def pick(x: Column, table: dict[str, str]) -> Column:
        return F.element_at(F.create_map(*[F.lit(y) for kv in table.items() for y in kv]), x["type"])

    names, kinds, actions = known, {k: policy.category(v) for k, v in known.items()}, {k: policy.action(v) for k, v in known.items()}
    kept = F.filter(F.coalesce(found, F.array().cast("array<struct<start:int,end:int,text:string,type:string,score:double>>")), lambda x: x["type"].isin(*known))
    return F.transform(kept, lambda x: F.struct(x["start"], x["end"], x["text"], pick(x, names).alias("entity_type"), x["score"].alias("confidence"), F.lit("ner").alias("method"), pick(x, kinds).alias("category"), pick(x, actions).alias("action"))).cast(S.SPANS)


def ipv4_spans(text: Column, policy: Policy, rules: P.Rules = P.UNICODE, may: Column | None = None) -> Column:
    """Dotted quads of octets, in place of a library's recogniser."""
    return S.typed(S.find(text, rules.ipv4, may), "ip_address", 0.6, "ipv4", policy.category("ip_address") or "OPERATIONAL_IDENTIFIERS", policy.action("ip_address"))


def detect(df: DataFrame, text: str = "text", policy: Policy | None = None, ner: str | None = None, out: str = "spans", rules: P.Rules = P.UNICODE) -> DataFrame:
    """df with `out`: all deterministic spans of `text`, disjoint and in order.

    Rules come in a fixed order. A safety pattern yields to spans found before it;
    a host name may replace a person's name. Custom patterns yield to those but
    not to each other, secret assignments yield to everything. rules: the reading
    of the patterns, see functions/patterns.py.
    """
    policy = policy or Policy.default()
    t = F.col(f"`{text}`")
    ner_, safe, custom, signs = (f"__{out}_{x}" for x in ("ner", "safe", "custom", "signs"))
    df = df.withColumn(signs, S.signs(t, rules, "ipv4", *rules.safety, *rules.custom, "secret"))
    extra = ner_spans(F.col(f"`{ner}`"), policy) if ner else S.none()
    ip = ipv4_spans(t, policy, rules, F.col(signs)["ipv4"]) if "ip_address" in policy.categories else S.none()
    df = df.withColumn(ner_, F.concat(extra, S.apart(ip, extra)) if ner else ip).withColumn(safe, S.none()).withColumn(custom, S.none())
    for name, pattern in rules.safety.items():
        if name in policy.categories:
            found = S.apart(S.typed(S.find(t, pattern, F.col(signs)[name]), name, 0.95, "regex_fallback", policy.category(name), policy.action(name)), F.col(safe))
            before = F.filter(ner_, lambda s: s["entity_type"] != "person_name") if name == "hostname" else F.col(ner_)
            df = df.withColumn(safe, F.concat(safe, S.apart(found, before)))
    for name, pattern in rules.custom.items():
        found = S.typed(S.find(t, pattern, F.col(signs)[name]), f"custom_{name}", 0.8, "regex", *CUSTOM_KIND[name])
        df = df.withColumn(custom, F.concat(custom, S.apart(S.apart(found, F.col(safe)), F.col(ner_))))
    df = df.withColumn(safe, F.concat(ner_, safe, custom))
    secret = S.apart(S.typed(S.find(t, rules.secret, F.col(signs)["secret"]), "api_key", 0.9, "keyword_assignment", "SECRETS", "REDACT"), F.col(safe))
    return df.withColumn(out, S.resolve(F.concat(safe, secret))).drop(ner_, safe, custom, signs)


def candidates(df: DataFrame, text: str = "text", spans: str = "spans", out: str = "candidates") -> DataFrame:
    """df with every span's id, context and whether a reviewer should see it."""
    t = F.col(f"`{text}`")
    row = lambda s: F.struct(
        F.concat(F.lit("span_"), s["start"].cast("string"), F.lit("_"), s["end"].cast("string")).alias("span_id"), s["start"], s["end"], s["text"], s["entity_type"], s["confidence"], s["method"],
        S.snippet(t, s["start"], s["end"], 50).alias("context"), ((s["confidence"] < F.lit(0.7)) | (s["method"] == "keyword")).alias("requires_review"),
    )
    return df.withColumn(out, F.transform(F.col(f"`{spans}`"), row).cast(CANDIDATES))


def contextual_confidence(text: Column, start: Column, match: Column) -> Column:
    """0.5 and a sum for the words around a match, in a fixed order of additions, within 0 and 1."""
    a = F.greatest(F.lit(0), start - 100)
    window = F.lower(F.substring(text, a + 1, F.least(F.length(text), start + F.length(match) + 100) - a))
    score = F.lit(0.5)
    for words in KEYWORDS.values():
        score = score + F.when(S.contains_any(window, words), F.lit(0.2)).otherwise(F.lit(0.0))
    score = score + F.when(S.contains_any(window, PRIVACY_WORDS), F.lit(0.15)).otherwise(F.lit(0.0))
    score = score + F.when(S.contains_any(window, INCIDENT_WORDS), F.lit(0.1)).otherwise(F.lit(0.0))
    score = score + F.when(F.length(match) > 20, F.lit(0.1)).when(F.length(match) < 5, F.lit(-0.1)).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))


def contextual(df: DataFrame, text: str = "text", spans: str = "spans", out: str = "contextual", least: float = 0.6, rules: P.Rules = P.UNICODE) -> DataFrame:
    """df with spans that their context makes sensitive; they yield to the deterministic ones, not to each other."""
    t, every, signs = F.col(f"`{text}`"), [], f"__{out}_signs"
    df = df.withColumn(signs, S.signs(t, rules, *rules.contextual))
    for name, pattern in rules.contextual.items():
        found = S.apart(S.find(t, pattern, F.col(signs)[name]), F.col(f"`{spans}`"))
        row = lambda h: F.struct(
            F.concat(F.lit(f"llm_{name}_"), h["start"].cast("string"), F.lit("_"), h["end"].cast("string")).alias("span_id"), h["start"], h["end"], h["text"], F.lit(f"contextual_{name}").alias("entity_type"),
            contextual_confidence(t, h["start"], h["text"]).alias("confidence"), S.snippet(t, h["start"], h["end"], 75).alias("snippet"),
        )
        every.append(F.transform(found, row).cast(CONTEXTUAL))
    return df.withColumn(out, F.concat(*every)).withColumn(out, F.filter(out, lambda s: s["confidence"] >= F.lit(float(least)))).drop(signs)
