"""Final review in windows, and the decision whether a person should look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, OVERLAP = 8000, 300
RESULT = "struct<is_clean:boolean,confidence:double,overall_assessment:string,issues:array<struct<snippet:string,issue_type:string,severity:string,reasoning:string>>,skipped:boolean,skip_reason:string,reviewed_chars:int,total_chars:int,chunks_reviewed:int>"
ANSWER = "struct<is_clean:boolean,confidence:double,overall_assessment:string,issues:array<struct<snippet:string,issue_type:string,severity:string,reasoning:string>>>"
SKIPPED = {"disabled": "Final review disabled", "no_api_client": "No API client available", "api_error": "LLM review call failed", "parse_error": "Failed to parse LLM response"}


def windows(text: Column, size: int = WINDOW, overlap: int = OVERLAP) -> Column:
    """Overlapping pieces that cover every character; an empty text is one empty piece."""
    if size <= overlap:
        raise ValueError("the overlap must be smaller than the window")
    n = F.length(text)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size - overlap)), lambda z: (z == 0) | (z + overlap < n))
    return F.transform(starts, lambda z: F.substring(text, z + 1, F.lit(size)))


def parsed(raw: Column) -> Column:
    """A reviewer's JSON answer as a RESULT; without a boolean verdict and a list of objects it is skipped."""
    body = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    verdict, listed = F.get_json_object(body, "$.is_clean"), F.get_json_object(body, "$.issues")
    a = F.from_json(body, ANSWER.replace("is_clean:boolean,confidence:double", "is_clean:string,confidence:string"))
    objects = F.coalesce(F.forall(F.from_json(listed, "array<string>"), lambda x: F.ltrim(x).startswith("{")), F.lit(False))
    good = verdict.isin("true", "false") & ~body.rlike(r'"is_clean"\s*:\s*"') & listed.startswith("[") & objects
    cut = lambda x, default: F.substring(F.coalesce(x, F.lit(default)), 1, 500)
    issues = F.transform(a["issues"], lambda i: F.struct(cut(i["snippet"], "").alias("snippet"), F.coalesce(i["issue_type"], F.lit("ambiguous")).alias("issue_type"), F.coalesce(i["severity"], F.lit("medium")).alias("severity"), cut(i["reasoning"], "").alias("reasoning")))
    fine = F.struct((verdict == "true").alias("is_clean"), F.coalesce(a["confidence"].try_cast("double"), F.lit(0.5)).alias("confidence"), cut(a["overall_assessment"], "").alias("overall_assessment"), issues.alias("issues"), F.lit(False).alias("skipped"), F.lit(None).cast("string").alias("skip_reason"), F.lit(0).alias("reviewed_chars"), F.lit(0).alias("total_chars"), F.lit(1).alias("chunks_reviewed"))
    return F.when(F.coalesce(good, F.lit(False)), fine.cast(RESULT)).otherwise(skipped("parse_error", F.lit(0)))


def skipped(reason: str, total: Column) -> Column:
    return F.struct(F.lit(False), F.lit(0.0), F.lit(SKIPPED.get(reason, reason)), F.array().cast("array<struct<snippet:string,issue_type:string,severity:string,reasoning:string>>"), F.lit(True), F.lit(reason), F.lit(0), total.cast("int"), F.lit(0)).cast(RESULT)


def folded(text: Column, pieces: Column, results: Column) -> Column:
    """One result from those of all windows: clean if all are, as sure as the least sure; the first skipped one ends the review."""
    n = F.size(results)
    first = F.array_position(F.transform(results, lambda r: r["skipped"]), True).cast("int")
    done = F.when(first > 0, first - 1).otherwise(n)
    read = F.slice(results, F.lit(1), done)
    issues, total = F.flatten(F.transform(read, lambda r: r["issues"])), F.length(text)
    chars = F.least(total, F.aggregate(F.slice(pieces, F.lit(1), done), F.lit(0), lambda a, p: a + F.length(p)))
    whole = F.struct((F.forall(read, lambda r: r["is_clean"]) & (F.size(issues) == 0)).alias("a"), F.array_min(F.transform(read, lambda r: r["confidence"])), F.substring(F.array_join(F.transform(read, lambda r: r["overall_assessment"]), "; "), 1, 500), issues, F.lit(False), F.lit(None).cast("string"), total, total, n).cast(RESULT)
    stop = F.get(results, first - 1)
    part = F.struct(F.lit(False), F.lit(0.0), stop["overall_assessment"], issues, F.lit(True), stop["skip_reason"], chars, total, done).cast(RESULT)
    return F.when(first > 0, part).otherwise(whole)


def without_review(df: DataFrame, text: str = "processed_text", reason: str = "disabled", out: str = "final_review") -> DataFrame:
    return df.withColumn(out, skipped(reason, F.length(F.col(f"`{text}`"))))


def human_review(metrics: Column, critical: Column, high: Column, final_review: Column | None = None, threshold: float = 0.7) -> Column:
    """Whether and why a person should look: a metric below the threshold, a serious issue, or a final review that is not clean or could not be made."""
    signals = F.array_compact(F.array(*[F.when(metrics[m] < F.lit(float(threshold)), F.lit(m)) for m in ("overall_quality_score", "precision", "recall", "f1_score")]))
    low = (metrics["overall_quality_score"] < F.lit(float(threshold))) | (F.size(signals) > 0)
    serious = (critical > 0) | (high > 0) | (metrics["residual_pii_count"] > 0) | (metrics["schema_violations"] > 0)
    r = final_review
    flagged = F.coalesce(~r["skipped"] & ~r["is_clean"], F.lit(False)) if r is not None else F.lit(False)
    gone = F.coalesce(r["skipped"] & (F.coalesce(r["skip_reason"], F.lit("unknown")) != "disabled"), F.lit(False)) if r is not None else F.lit(False)
    reasons = [
        F.when(low, f"one or more quality metrics below threshold {threshold:.2f}"),
        F.when(serious, "validation found residual PII, schema violations, or high-severity issues"),
        F.when(flagged, F.concat(F.lit("LLM final review flagged "), F.size(r["issues"]).cast("string"), F.lit(" issue(s)"))) if r is not None else F.lit(None).cast("string"),
        F.when(gone, F.concat(F.lit("LLM final review unavailable ("), F.coalesce(r["skip_reason"], F.lit("unknown")), F.lit(")"))) if r is not None else F.lit(None).cast("string"),
    ]
    fine = F.concat(F.lit("quality score "), F.format_string("%.3f", metrics["overall_quality_score"]), F.lit(f" meets threshold {threshold:.2f}"))
    needs = low | serious | flagged | gone
    return F.struct(needs.alias("needs_review"), F.lit(float(threshold)).alias("confidence_threshold"), metrics["overall_quality_score"].alias("quality_score"), signals.alias("low_confidence_signals"), serious.alias("validation_flag"), flagged.alias("final_review_flag"), gone.alias("final_review_unavailable"), F.when(needs, F.concat_ws("; ", *reasons)).otherwise(fine).alias("reason"))
