"""Decisions and rewriting: what happens to each span, and the text that comes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions import pseudonyms as R
from veilspan.functions import spans as S
from veilspan.operators.policy import ACTIONS, Allowlist

# Which kinds are always redacted, which may change with the context, and the finder's view of each.
FORCED = ("email", "phone", "credit_card", "ssn", "api_key")
PROTECTED = ("person_name", "hostname", "ip_address", "customer_id")
FINDER = {
    "email": "REDACT", "phone": "REDACT", "credit_card": "REDACT", "ssn": "REDACT", "custom_internal_url": "REDACT", "custom_aws_arn": "REDACT",
    "person_name": "PSEUDONYMIZE", "hostname": "PSEUDONYMIZE", "ip_address": "PSEUDONYMIZE", "customer_id": "PSEUDONYMIZE",
    "custom_jira_ticket": "PSEUDONYMIZE", "custom_kubernetes_pod": "PSEUDONYMIZE", "custom_docker_image": "PSEUDONYMIZE",
}
SECURITY_WORDS = ("breach", "security incident", "unauthorized access", "data leak", "compromise")
INTERNAL_WORDS = ("internal discussion", "team meeting", "employee review", "confidential")
REDACTION_TYPE = {"REDACT": "hard_redact", "PSEUDONYMIZE": "pseudonymize"}
DECISIONS = (
    "array<struct<entity_id:string,entity_type:string,original_text:string,start:int,end:int,final_action:string,final_confidence:double,deterministic_action:string,"
    "finder_action:string,judge_action:string,reasoning:string,sources:array<string>,replacement:string,pseudonym_key:string,redaction_type:string>>"
)


def finder_action(entity_type: Column) -> Column:
    return R.lookup(entity_type, FINDER, F.lit("RETAIN"))


def final_action(entity_type: Column, deterministic: Column, finder: Column, judge: Column, alarm: Column, inner: Column) -> Column:
    """A struct of action and reasoning: forced kinds first, then votes of weight 3, 2 and 1, protection of identifiers, then the context.

    Votes are cast in the order deterministic, finder, judge; of equal sums the first cast wins.
    """
    names = {"deterministic": 1, "llm_finder": 2, "judge": 3}
    weights = {a: sum((F.when(v == a, w).otherwise(0) for v, w in zip((deterministic, finder, judge), names.values(), strict=True)), F.lit(0)) for a in ACTIONS}
    weight = lambda v: R.chain(v, weights, F.lit(0))
    cast = F.array(*[F.when(v.isNotNull(), F.struct(v.alias("action"), weight(v).alias("weight"))) for v in (deterministic, finder, judge)])
    best = F.aggregate(F.array_compact(cast), F.lit(None).cast("struct<action:string,weight:int>"), lambda acc, v: F.when(acc.isNull() | (v["weight"] > acc["weight"]), v).otherwise(acc), lambda acc: acc["action"])
    said = [F.when(v.isNotNull(), F.concat(F.lit(f"{name}: "), v, F.lit(f" (weight: {w})"))) for v, (name, w) in zip((deterministic, finder, judge), names.items(), strict=True)]
    protected = entity_type.isin(*PROTECTED)
    voted = S.let(F.struct(best.alias("winner"), protected.alias("protected")), lambda x: F.struct(x["winner"].alias("winner"), x["protected"].alias("protected"), F.coalesce(x["protected"] & (deterministic == "PSEUDONYMIZE") & (x["winner"] == "RETAIN"), F.lit(False)).alias("saved")))

    def adjusted(x: Column) -> Column:
        moved = x["protected"] & (alarm | (inner & (entity_type == "person_name")))
        action = F.when(x["winner"].isNull(), "RETAIN").when(x["saved"] | (moved & (x["winner"] == "RETAIN")), "PSEUDONYMIZE").otherwise(x["winner"])
        return F.struct(action.alias("action"), x["winner"].alias("winner"), x["protected"].alias("protected"), x["saved"].alias("saved"))

    def told(x: Column) -> Column:
        more = [F.when(x["saved"], F.concat(F.lit("confirmed "), entity_type, F.lit(" requires pseudonymization"))), F.when(x["protected"], F.concat(F.lit("Context-adjusted to: "), x["action"]))]
        reason = F.when(x["winner"].isNull(), "No stage decisions available, using policy default: RETAIN").otherwise(F.concat(F.lit("Arbitration result: "), F.concat_ws("; ", *said, *more)))
        return F.struct(x["action"].alias("action"), reason.alias("reasoning"))

    forced = F.struct(F.lit("REDACT").alias("action"), F.concat(F.lit("Forced rule: "), entity_type, F.lit(" entities are always REDACT")).alias("reasoning"))
    return F.when(entity_type.isin(*FORCED), forced).otherwise(S.let(S.let(voted, adjusted), told))


def decide(df: DataFrame, text: str = "text", spans: str = "spans", contextual: str | None = "contextual", allowlist: Allowlist | None = None, judged: str | None = None, honour_policy: bool = False, double_confidence: bool = False, out: str = "decisions") -> DataFrame:
    """df with a decision for every deterministic and contextual span.

    Deterministic and contextual spans are merged by their exact offsets. judged
    names an optional map from "start:end" to a judge's action; without it the
    judge has no vote. honour_policy lets the policy's action stand in for the
    finder's. double_confidence reports the finder's confidence as twice the
    detector's, as the compared results do.
    """
    allowlist = allowlist if allowlist is not None else Allowlist.default()
    t, alarm, inner, rows = F.col(f"`{text}`"), f"__{out}_alarm", f"__{out}_inner", f"__{out}_rows"
    df = df.withColumn(alarm, F.coalesce(S.contains_any(F.lower(t), SECURITY_WORDS), F.lit(False))).withColumn(inner, F.coalesce(S.contains_any(F.lower(t), INTERNAL_WORDS), F.lit(False)))
    merged = "array<struct<start:int,end:int,text:string,entity_type:string,confidence:double,action:string,from_context:boolean>>"
    own = F.transform(F.col(f"`{spans}`"), lambda s: F.struct(s["start"], s["end"], s["text"], s["entity_type"], s["confidence"], s["action"], F.lit(False).alias("from_context"))).cast(merged)
    if contextual:
        # The surest of those that share offsets stays; ties keep the order of the patterns.
        ranked = F.array_sort(F.transform(F.col(f"`{contextual}`"), lambda s, i: F.struct((-s["confidence"]).alias("less"), i.alias("i"), s.alias("s"))))
        more = F.transform(ranked, lambda r: F.struct(r["s"]["start"], r["s"]["end"], r["s"]["text"], r["s"]["entity_type"], r["s"]["confidence"], F.lit(None).cast("string").alias("action"), F.lit(True).alias("from_context"))).cast(merged)
        one = F.aggregate(more, S.none(merged), lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] == x["start"]) & (y["end"] == x["end"])), acc).otherwise(F.concat(acc, F.array(x))))
        own = F.concat(own, one)
    df = df.withColumn(rows, own)

    def arbitrate(s: Column) -> Column:
        finder = F.coalesce(s["action"], finder_action(s["entity_type"])) if honour_policy else finder_action(s["entity_type"])
        judge = F.try_element_at(F.col(f"`{judged}`"), F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))) if judged else F.lit(None).cast("string")
        return F.struct(s.alias("s"), finder.alias("finder"), judge.alias("judge"), allowlist.match(s["text"]).alias("allowed"))

    def settle(x: Column) -> Column:
        s = x["s"]
        return F.struct(x.alias("x"), final_action(s["entity_type"], s["action"], x["finder"], x["judge"], F.col(alarm), F.col(inner)).alias("f"))

    def override(y: Column) -> Column:
        x, f = y["x"], y["f"]
        kept = x["allowed"].isNotNull() & (f["action"] != "RETAIN")
        return F.struct(x.alias("x"), F.when(kept, "RETAIN").otherwise(f["action"]).alias("action"), F.when(kept, F.concat(F.lit("Allowlist override (matched '"), x["allowed"], F.lit("'): "), f["reasoning"])).otherwise(f["reasoning"]).alias("reasoning"))

    def row(z: Column, i: Column) -> Column:
        x, s, action = z["x"], z["x"]["s"], z["action"]
        replacement = F.when(action == "REDACT", R.placeholder(s["entity_type"])).when(action == "PSEUDONYMIZE", R.pseudonym(s["entity_type"], s["text"])).otherwise(s["text"])
        key = F.when(action == "PSEUDONYMIZE", F.concat_ws(":", s["entity_type"], F.lower(s["text"])))
        sources = F.array_compact(F.array(F.when(~s["from_context"], "deterministic"), F.lit("llm_finder"), F.when(x["judge"].isNotNull(), "judge")))
        sure = s["confidence"] * 2 if double_confidence else s["confidence"]
        return F.struct(F.concat(F.lit("arbitration_"), i.cast("string")).alias("entity_id"), s["entity_type"], s["text"].alias("original_text"), s["start"], s["end"], action.alias("final_action"), sure.alias("final_confidence"), s["action"].alias("deterministic_action"), x["finder"].alias("finder_action"), x["judge"].alias("judge_action"), z["reasoning"].alias("reasoning"), sources.alias("sources"), replacement.alias("replacement"), key.alias("pseudonym_key"), R.lookup(action, REDACTION_TYPE, F.lit("contextual_retain")).alias("redaction_type"))

    settled = F.transform(F.transform(F.transform(rows, arbitrate), settle), override)
    return df.withColumn(out, F.transform(settled, row).cast(DECISIONS)).drop(alarm, inner, rows)


def _quoted(text: Column) -> Column:
    """A pattern that matches a text literally, whatever it holds."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def rewrite(df: DataFrame, text: str = "text", decisions: str = "decisions", out: str = "processed_text") -> DataFrame:
    """df with the rewritten text: edits are spliced in, then each pseudonymized name is replaced wherever it still stands, longest first."""
    t, d = F.col(f"`{text}`"), F.col(f"`{decisions}`")
    edits = F.array_sort(F.transform(F.filter(d, lambda x: x["final_action"] != "RETAIN"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["replacement"].alias("replacement"))))
    names = F.filter(d, lambda x: (x["entity_type"] == "person_name") & (x["final_action"] == "PSEUDONYMIZE") & (x["original_text"] != x["replacement"]))
    names = F.array_distinct(F.transform(names, lambda x: F.struct((-F.length(x["original_text"])).alias("less"), x["original_text"].alias("name"), x["replacement"].alias("new"))))
    spliced = f"__{out}"
    df = df.withColumn(spliced, S.splice(t, edits))
    # Pseudonyms of names are plain letters and digits, so they need no quoting as a replacement.
    done = F.aggregate(F.array_sort(names), F.col(spliced), lambda acc, n: F.regexp_replace(acc, F.concat(F.lit(r"(?U)(?<!\w)"), _quoted(n["name"]), F.lit(r"(?!\w)")), n["new"]))
    return df.withColumn(out, done).drop(spliced)


def audit_rewrite(df: DataFrame, text: str = "text", spans: str = "spans", least: float = 0.8, out: str = "audit_text", known: dict[str, str] | None = None) -> DataFrame:
    """df with the detector's own rewrite: sure spans that the policy does not retain, with numbered pseudonyms.

    known is a loaded map of pseudonyms (sources.sinks.load_mapping); it goes before the computed ones.
    """
    kept = F.filter(F.col(f"`{spans}`"), lambda s: (s["confidence"] >= F.lit(float(least))) & (s["action"] != "RETAIN"))
    given = F.create_map(*[F.lit(x) for kv in known.items() for x in kv]) if known else None
    made = lambda s: R.numbered_pseudonym(s["entity_type"], s["text"]) if given is None else F.coalesce(F.try_element_at(given, s["text"]), R.numbered_pseudonym(s["entity_type"], s["text"]))
    new = lambda s: F.when(s["action"] == "PSEUDONYMIZE", made(s)).otherwise(F.concat(F.lit("[REDACTED_"), F.upper(s["entity_type"]), F.lit("]")))
    edits = F.array_sort(F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), new(s).alias("replacement"))))
    return df.withColumn(out, S.splice(F.col(f"`{text}`"), edits))


def pseudonym_map(decisions: Column) -> Column:
    """type:text -> replacement of every pseudonymized span; equal keys have equal values."""
    made = F.filter(decisions, lambda d: d["pseudonym_key"].isNotNull())
    return F.map_from_entries(F.array_distinct(F.transform(made, lambda d: F.struct(d["pseudonym_key"], d["replacement"]))))


def detected_map(spans: Column) -> Column:
    """text -> numbered pseudonym of every detected span that the policy pseudonymizes; of equal texts the first span's kind counts."""
    made = F.transform(F.filter(spans, lambda s: s["action"] == "PSEUDONYMIZE"), lambda s: F.struct(s["text"].alias("k"), R.numbered_pseudonym(s["entity_type"], s["text"]).alias("v")))

    def first(made: Column) -> Column:
        return S.let(F.transform(made, lambda m: m["k"]), lambda keys: F.filter(made, lambda m, i: F.array_position(keys, m["k"]) == i + 1))

    return F.map_from_entries(S.let(made, first))


def arbitration_stats(d: Column) -> Column:
    count = lambda test: F.size(F.filter(d, test))
    return F.struct(
        F.size(d).alias("total_entities_processed"),
        count(lambda x: x["final_action"] == "REDACT").alias("redactions_applied"),
        count(lambda x: x["final_action"] == "PSEUDONYMIZE").alias("pseudonymizations_applied"),
        count(lambda x: x["final_action"] == "RETAIN").alias("retentions_applied"),
        count(lambda x: F.size(x["sources"]) > 1).alias("conflicts_resolved"),
        count(lambda x: x["reasoning"].contains("Forced rule")).alias("force_rules_applied"),
        count(lambda x: x["reasoning"].contains("Context-adjusted")).alias("context_adjustments"),
        count(lambda x: x["reasoning"].startswith("Allowlist override")).alias("allowlist_overrides"),
    )
