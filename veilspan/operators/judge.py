"""Finder and judge: what a language model's stages report, simulated when no model is connected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions import pseudonyms as R
from veilspan.functions import spans as S
from veilspan.operators import models, plugins

# Words and classes of the simulated stages.
HIGH_WORDS, MEDIUM_WORDS = ("breach", "security", "incident", "report"), ("internal", "team", "meeting", "discussion")
ALTERNATIVE = {"email": "person_contact", "person_name": "employee_name", "custom_jira_ticket": "internal_reference", "custom_hostname": "infrastructure_element"}
FINDINGS = "array<struct<span_id:string,start:int,end:int,text:string,entity_type:string,confidence:double,reasoning:string,needs_expert:boolean,alternative:string,sensitivity:string>>"


def sensitivity(text: Column) -> Column:
    low = F.lower(text)
    return F.when(S.contains_any(low, HIGH_WORDS), "high").when(S.contains_any(low, MEDIUM_WORDS), "medium").otherwise("low")


def reasoning(entity_type: Column, text: Column) -> Column:
    said = lambda before, after: F.concat(F.lit(before), text, F.lit(after))
    return (
        F.when(entity_type.startswith("email"), said("The text '", "' appears to be an email address. Email addresses are considered PII data."))
        .when(entity_type.startswith("person_name"), said("The text '", "' represents a person's name, which is sensitive personal information."))
        .when(entity_type.startswith("phone"), said("The string '", "' appears to be a telephone number, categorized as PII."))
        .when(entity_type.startswith("custom_"), F.concat(said("The text '", "' appears to reference "), F.replace(entity_type, F.lit("custom_"), F.lit("")), F.lit(" information.")))
        .when(entity_type.startswith("internal_"), F.concat(said("The term '", "' suggests "), F.replace(entity_type, F.lit("internal_"), F.lit("")), F.lit(" data that may be sensitive.")))
        .otherwise(said("I detected '", "' which appears to contain sensitive information based on context."))
    )


def find(df: DataFrame, text: str = "text", candidates: str = "candidates", contextual: str = "contextual", double_confidence: bool = False, out: str = "findings") -> DataFrame:
    """df with all findings, the surest first; of equals the candidates come first, in order."""
    level, times = f"__{out}", 2.0 if double_confidence else 1.0
    df = df.withColumn(level, sensitivity(F.col(f"`{text}`")))
    known = lambda c: F.struct(c["span_id"], c["start"], c["end"], c["text"], c["entity_type"], (c["confidence"] * F.lit(times)).alias("confidence"), reasoning(c["entity_type"], c["text"]).alias("reasoning"), (c["confidence"] < F.lit(0.8)).alias("needs_expert"), R.lookup(c["entity_type"], ALTERNATIVE, F.lit(None).cast("string")).alias("alternative"), F.col(level).alias("sensitivity"))
    more = lambda c: F.struct(c["span_id"], c["start"], c["end"], c["text"], c["entity_type"], c["confidence"], F.concat(F.lit("Contextual analysis detected potential "), F.regexp_replace(c["entity_type"], "^contextual_", "")).alias("reasoning"), F.lit(False).alias("needs_expert"), F.lit(None).cast("string").alias("alternative"), F.col(level).alias("sensitivity"))
    every = F.concat(F.transform(F.col(f"`{candidates}`"), known).cast(FINDINGS), F.transform(F.col(f"`{contextual}`"), more).cast(FINDINGS))
    ranked = F.array_sort(F.transform(every, lambda f, i: F.struct((-f["confidence"]).alias("less"), i.alias("i"), f.alias("f"))))
    return df.withColumn(out, F.transform(ranked, lambda r: r["f"])).drop(level)


def finder_stats(f: Column) -> Column:
    n = F.size(f)
    of = lambda test: F.size(F.filter(f, test))
    total = F.aggregate(f, F.lit(0.0), lambda a, x: a + x["confidence"])
    return F.struct(
        n.alias("llm_detections_found"), of(lambda x: x["span_id"].contains("llm_")).alias("additional_contextual_detections"), F.when(n > 0, total / n).otherwise(F.lit(0.0)).alias("avg_confidence"),
        of(lambda x: x["confidence"] >= F.lit(0.8)).alias("high_confidence_detections"), of(lambda x: (x["confidence"] >= F.lit(0.6)) & (x["confidence"] < F.lit(0.8))).alias("medium_confidence_detections"),
        of(lambda x: x["confidence"] < F.lit(0.6)).alias("low_confidence_detections"), of(lambda x: ~x["span_id"].contains("llm_")).alias("enhanced_deterministic"),
    )


#: What a judgement says of a finding, whoever judged.
JUDGEMENTS = (
    "array<struct<span_id:string,original_text:string,entity_type:string,start:int,end:int,action:string,confidence:double,auto:boolean,keep_redaction:boolean,"
    "reasoning:string,policy_violation_level:string,risk_factors:array<string>,policy_alignment:boolean,judge_model:string>>"
)
ANSWER = "struct<decision:string,confidence:string,reasoning:string,legal_reasoning:string,policy_violation_level:string,compliance_assessment:string,risk_factors:array<string>,policy_alignment:boolean>"
LEVELS = ("HIGH", "MEDIUM", "LOW", "NONE")


def verdict(entity_type: Column, flavour: str = "strict") -> Column:
    """(action, confidence) of a simulated judge. strict and lax are two models' stand-ins; fallback is what an error gives."""
    t = F.lower(entity_type)
    has = lambda *words: S.contains_any(t, words)
    hard = has("email", "credit_card") if flavour == "lax" else has("email", "credit_card", "ssn")
    soft = has("person_name", "salary") if flavour == "strict" else has("person_name")
    return F.struct(F.when(hard, "REDACT").when(soft, "PSEUDONYMIZE").otherwise("RETAIN").alias("action"), F.lit({"strict": 0.85, "lax": 0.7, "fallback": 0.6}[flavour]).alias("confidence"))


def _settled(f: Column) -> Column:
    """Whether a finding is decided without a judge: 0.95 and surer, unless it is a secret."""
    return (f["confidence"] >= F.lit(0.95)) & ~F.lower(f["entity_type"]).contains("secret")


def _row(f: Column, auto: Column, action: Column, confidence: Column, reasoning: Column, level: Column, factors: Column, aligned: Column, model: Column) -> Column:
    return F.struct(
        f["span_id"], f["text"].alias("original_text"), f["entity_type"], f["start"], f["end"], action.alias("action"), confidence.alias("confidence"), auto.alias("auto"), (action != "RETAIN").alias("keep_redaction"),
        reasoning.alias("reasoning"), level.alias("policy_violation_level"), factors.cast("array<string>").alias("risk_factors"), aligned.alias("policy_alignment"), model.alias("judge_model"),
    )


def _by_policy(f: Column) -> Column:
    """The judgement of a finding that needs no judge."""
    t = F.lower(f["entity_type"])
    action = F.when(t.contains("email"), "REDACT").when(t.contains("person_name"), "PSEUDONYMIZE").otherwise("RETAIN")
    said = F.concat(F.lit("Decided by policy at a confidence of "), F.format_string("%.2f", f["confidence"]))
    return _row(f, F.lit(True), action, f["confidence"], said, F.lit("MEDIUM"), F.array(F.lit("high_confidence")), F.lit(True), F.lit("policy_auto"))


def _simulated(f: Column, flavour: str) -> Column:
    v = verdict(f["entity_type"], flavour)
    level = F.when(v["action"] == "REDACT", "HIGH").otherwise("MEDIUM") if flavour == "strict" else F.lit("MEDIUM")
    factors = {"strict": ("simulated_analysis",), "lax": (), "fallback": ("llm_unavailable",)}[flavour]
    said = F.concat(F.lit("Decided by entity type "), f["entity_type"], F.lit(" without a model"))
    model = F.lit("fallback_policy" if flavour == "fallback" else f"simulated_{flavour}")
    return _row(f, F.lit(False), v["action"], v["confidence"], said, level, F.array(*map(F.lit, factors)), F.lit(True), model)


def judge(df: DataFrame, findings: str = "findings", flavour: str = "strict", out: str = "judgements") -> DataFrame:
    """df with a simulated judgement of every finding; the surest are decided by policy, secrets never."""
    row = lambda f: F.when(_settled(f), _by_policy(f)).otherwise(_simulated(f, flavour))
    return df.withColumn(out, F.transform(F.col(f"`{findings}`"), row).cast(JUDGEMENTS))


def parsed(raw: Column, f: Column, model: str) -> Column:
    """A model's JSON answer about a finding as a judgement; an answer that cannot be read, or none, gives the fallback's."""
    a = F.from_json(F.regexp_extract(raw, r"(?s)\{.*\}", 0), ANSWER)

    def read(a: Column) -> Column:
        action = F.when(F.upper(a["decision"]).isin("REDACT", "PSEUDONYMIZE"), F.upper(a["decision"])).otherwise("RETAIN")
        level = F.upper(F.coalesce(a["policy_violation_level"], a["compliance_assessment"], F.lit("MEDIUM")))
        sure, said = F.coalesce(a["confidence"], F.lit("0.9")).try_cast("double"), F.coalesce(a["reasoning"], a["legal_reasoning"], F.lit("No reasoning provided"))
        # An answer without a decision retains; one whose confidence is no number is no answer.
        good = F.coalesce(raw.rlike(r"(?s)\{.*\}") & (a.isNotNull()) & sure.isNotNull() & level.isin(*LEVELS) & (a["decision"].isNotNull() | a["confidence"].isNotNull()), F.lit(False))
        mine = _row(f, F.lit(False), action, sure, said, level, F.coalesce(a["risk_factors"], F.array().cast("array<string>")), F.coalesce(a["policy_alignment"], F.lit(True)), F.lit(model))
        return F.when(good, mine).otherwise(_simulated(f, "fallback"))

    return S.let(a, read)


def judge_with(df: DataFrame, factory, text: str = "text", findings: str = "findings", model: str = "model", policy: str = models.POLICY, out: str = "judgements") -> DataFrame:
    """df with a model's judgement of every finding that needs one.

    A row's prompts go to the model together, inside Arrow batches; a prompt on
    which it fails is asked alone and then falls back. The text is not exploded.
    """
    f = F.col(f"`{findings}`")
    prompts = F.transform(f, lambda x: F.when(~_settled(x), models.judge_prompt(F.col(f"`{text}`"), x, policy)))
    answers = f"__{out}_answers"
    df = df.withColumn(answers, plugins.ask_each(prompts, factory))
    row = lambda x, i: F.when(_settled(x), _by_policy(x)).otherwise(parsed(F.get(F.col(answers), i), x, model))
    return df.withColumn(out, F.transform(f, row).cast(JUDGEMENTS)).drop(answers)


def votes(judgements: Column) -> Column:
    """start:end -> action of judgements that a judge made, as decide(judged=) takes them; of several the first counts."""
    made = F.transform(F.filter(judgements, lambda j: ~j["auto"]), lambda j: F.struct(F.concat_ws(":", j["start"].cast("string"), j["end"].cast("string")).alias("k"), j["action"].alias("v")))
    first = F.filter(made, lambda m, i: F.array_position(F.transform(made, lambda x: x["k"]), m["k"]) == i + 1)
    return F.map_from_entries(first)


def judge_stats(findings: Column, judgements: Column) -> Column:
    """A row's judge statistics."""
    judged = F.filter(judgements, lambda j: ~j["auto"])
    n = lambda a: F.size(F.filter(judged, lambda j: j["action"] == a))
    total = F.aggregate(judged, F.lit(0.0), lambda a, j: a + j["confidence"])
    failed = F.size(F.filter(judged, lambda j: j["judge_model"] == "fallback_policy"))
    return F.struct(
        F.size(findings).alias("input_detections"), F.size(judged).alias("judgements_required"), (F.size(findings) - F.size(judged)).alias("auto_decisions"),
        n("REDACT").alias("redaction_decisions"), n("PSEUDONYMIZE").alias("pseudonymize_decisions"), n("RETAIN").alias("retain_decisions"),
        F.when(F.size(judged) > 0, total / F.size(judged)).otherwise(F.lit(0.0)).alias("avg_decision_confidence"), failed.alias("fallbacks"),
        ((F.size(judged) - failed) / F.greatest(F.lit(1), F.size(judged))).alias("api_success_rate"), F.array_sort(F.array_distinct(F.transform(judged, lambda j: j["judge_model"]))).alias("models_used"),
    )


def judge_summary(df: DataFrame, judgements: str = "judgements") -> DataFrame:
    """Per entity type, how often each action was judged; a partial and a final count, whatever the corpus."""
    rows = S.rows(df, F.col(f"`{judgements}`"))
    actions = {a: F.count_if(F.col("action") == a).alias(a.lower()) for a in ("REDACT", "PSEUDONYMIZE", "RETAIN")}
    return rows.groupBy("entity_type").agg(F.count("*").alias("decisions"), *actions.values(), F.count_if("auto").alias("auto_decisions"), F.avg("confidence").alias("avg_decision_confidence"))


def policy_summary(df: DataFrame, judgements: str = "judgements", *by: str) -> DataFrame:
    """How judgements keep to the policy: the rate of compliance, and counts by risk, action and model, for the corpus or by columns."""
    rows = S.rows(df, F.col(f"`{judgements}`"), *by)
    risk = [F.count_if(F.col("policy_violation_level") == x).alias(f"risk_{x.lower()}") for x in LEVELS]
    actions = [F.count_if(F.col("action") == a).alias(a.lower()) for a in ("REDACT", "PSEUDONYMIZE", "RETAIN")]
    return rows.groupBy(*by).agg(
        F.count("*").alias("total_decisions"), F.coalesce(F.avg(F.col("policy_alignment").cast("double")), F.lit(0.0)).alias("policy_compliance_rate"), *risk, *actions,
        F.array_sort(F.collect_set("judge_model")).alias("models_used"),
    )


def risk_factors(df: DataFrame, judgements: str = "judgements") -> DataFrame:
    """How often each risk factor was named."""
    rows = S.rows(df, F.col(f"`{judgements}`")).select(F.explode_outer("risk_factors").alias("risk_factor")).where("risk_factor is not null")
    return rows.groupBy("risk_factor").agg(F.count("*").alias("n"))
