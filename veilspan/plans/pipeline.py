"""Whole pipelines: from texts to redacted texts, and from records to reports. All row-local, so no shuffle.

Filter the input, not the result: what these functions return does not let filters
through (spans.held says why), so a filter above them saves no work below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.functions import patterns as P
from veilspan.functions import spans as S
from veilspan.operators import decide, detect, judge, models, plugins, review, summary, validate
from veilspan.operators.policy import Allowlist, Policy


#: Bytes, by the planner's estimate, that one task works on at most.
PIECE = 4 << 20


#: Columns that process() makes beside the texts, metrics and reviews.
MADE = ("spans", "candidates", "contextual", "findings", "judgements", "judge_stats", "decisions", "arbitration", "detected_map", "pseudonym_map", "text_reduction_percentage", "issues", "checks")


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly to all cores, in pieces of PIECE bytes at most.

    A row group is one task's work as it lies, whatever its size, and these pipelines
    cost more than the shuffle of their input. So the longest task does not grow
    with the input: there are more of them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(2 * cores, -(-size // PIECE)))


def named(df: DataFrame, text: str, out: str, detector=None, people: bool = False, find=plugins.detect_with) -> DataFrame:
    """df with what a plug-in detector (a factory) and the native rules for names and addresses find in a text."""
    if detector:
        df = find(df, detector, text, out)
        own = F.col(out)
        return df.withColumn(out, F.concat(own, S.apart(plugins.people(F.col(f"`{text}`")), own))) if people else df
    return df.withColumn(out, plugins.people(F.col(f"`{text}`")))


def redact(df: DataFrame, text: str = "text", policy: Policy | None = None, allowlist: Allowlist | None = None, ner: str | None = None, detector=None, people: bool = False, rules: P.Rules = P.UNICODE) -> DataFrame:
    """df with spans, decisions and processed_text: the short way to a redacted corpus.

    Contextual spans are always retained, so they are not searched for here. A
    null text counts as empty. The input's other columns are kept. ner names a
    column of spans found elsewhere; detector is a plug-in's factory; people adds
    the native rules for names and addresses. rules: the reading of the patterns.
    """
    df = df.withColumn(text, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    if not ner and (detector or people):
        df, ner = named(df, text, "ner", detector, people), "ner"
    df = detect.detect(df, text, policy, ner, rules=rules)
    df = decide.decide(df, text, contextual=None, allowlist=allowlist)
    df = decide.rewrite(df, text)
    return df.withColumns({c: S.held(F.col(c)) for c in ("spans", "decisions", "processed_text")})


def process(
    df: DataFrame, text: str = "text", policy: Policy | None = None, allowlist: Allowlist | None = None, ner: str | None = None, threshold: float = 0.7, reviewed: str | None = None,
    double_confidence: bool = False, honour_policy: bool = False, detector=None, people: bool = False, judge_model=None, judge_votes: bool = False, review_model=None, key: str = "doc_id", rules: P.Rules = P.UNICODE,
) -> DataFrame:
    """df with every stage: spans, candidates, contextual spans, findings, judgements, decisions, texts, issues, metrics and reviews.

    detector and people find names, in the text and again in what is left of it.
    judge_model is a model's factory; judge_votes lets its verdicts count, which the
    compared results do not. reviewed names a column that already holds a final
    review, review_model asks one for it; without either it is recorded as disabled.
    rules: the reading of the patterns.
    A row whose `error` column is set (see sources.incidents) is passed on unread.
    """
    bad = F.col("error").isNotNull() if "error" in df.columns else None
    df = df.withColumn(text, F.coalesce(F.col(f"`{text}`") if bad is None else F.when(~bad, F.col(f"`{text}`")), F.lit("")))
    if not ner and (detector or people):
        df, ner = named(df, text, "ner", detector, people), "ner"
    df = detect.contextual(detect.candidates(detect.detect(df, text, policy, ner, rules=rules), text), text, rules=rules)
    df = judge.find(df, text, double_confidence=double_confidence)
    df = judge.judge_with(df, judge_model, text) if judge_model else judge.judge(df)
    df = df.withColumn("judge_stats", judge.judge_stats(F.col("findings"), F.col("judgements")))
    votes = None
    if judge_votes:
        df, votes = df.withColumn("__votes", judge.votes(F.col("judgements"))), "__votes"
    df = decide.decide(df, text, allowlist=allowlist, judged=votes, double_confidence=double_confidence, honour_policy=honour_policy)
    df = df.drop("__votes").withColumn("arbitration", decide.arbitration_stats(F.col("decisions")))
    df = decide.audit_rewrite(decide.rewrite(df, text), text).withColumn("detected_map", decide.detected_map(F.col("spans")))
    df = df.withColumn("pseudonym_map", decide.pseudonym_map(F.col("decisions"))).withColumn("text_reduction_percentage", summary.reduction(F.col(f"`{text}`"), F.col("processed_text")))
    left = None
    if detector or people:
        df, left = named(df, "processed_text", "__left", detector, people, plugins.detect_after), "__left"
    df = validate.validate(df, text, names=left, rules=rules).drop("__left")
    if reviewed:
        df = df.withColumnRenamed(reviewed, "final_review")
    elif review_model:
        df = plugins.final_review(df, review_model, key, prompt=models.review_prompt)
    else:
        df = review.without_review(df)
    i = F.col("issues")
    df = df.withColumn("human_review", review.human_review(F.col("quality_metrics"), validate.count(i, "severity", "critical"), validate.count(i, "severity", "high"), F.col("final_review"), threshold))
    ok = F.lit(True) if bad is None else F.col("error").isNull()
    whole = ("processed_text", "audit_text", "quality_metrics", "recommendations", "human_review", "final_review")
    return df.withColumns({c: S.held(F.when(ok, F.col(c)) if c in whole and bad is not None else F.col(c)) for c in (*MADE, *whole)})
