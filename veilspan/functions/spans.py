"""Spans of a text as an array column, and the algebra on them.

Offsets count code points, start at 0 and exclude the end. Everything here is a
Column expression of one row: no shuffle, no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.functions import patterns as P

HIT = "array<struct<start:int,end:int,text:string>>"
SPANS = "array<struct<start:int,end:int,text:string,entity_type:string,confidence:double,method:string,category:string,action:string>>"


def none(kind: str = SPANS) -> Column:
    return F.array().cast(kind)


def let(value: Column, body) -> Column:
    """body(value) with the value computed and written into the plan once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held(value: Column) -> Column:
    """value behind a condition that is always true and that the optimizer does not see through.

    A filter on a computed column would otherwise be pushed down through every step
    that made it, with a copy of all of them for each mention: planning would not end.
    """
    return F.when(F.spark_partition_id() >= 0, value)


#: Elements of an array that a fold works on at once, and code points of a text that are cut out at once.
BLOCK, PIECE = 64, 4096


def sums(values: Column) -> Column:
    """Running sums of an array of integers, without the element itself: block by block, so that no fold copies a long array."""
    last = lambda a: F.element_at(a, F.lit(-1))
    run = lambda a: F.aggregate(a, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(last(acc) + x)))

    def whole(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK))
        return let(F.transform(starts, lambda k: run(F.slice(v, k + 1, F.lit(BLOCK)))), joined)

    def joined(blocks: Column) -> Column:
        return let(run(F.transform(blocks, last)), lambda base: F.flatten(F.transform(blocks, lambda b, k: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x: x + F.get(base, k)))))

    return let(values, whole)


def find(text: Column, pattern: str, may: Column | None = None) -> Column:
    """All matches of a pattern with their offsets, left to right. may: whether the text can have any, if that is known.

    split() and regexp_extract_all() alternate gap and match, so running lengths
    give the offsets. A text without a match, or null, costs one search and gives
    an empty array. The pattern must not match the empty string.
    """
    found = F.struct(F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap)).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))

    def placed(x: Column) -> Column:
        steps = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["hits"])), x["hits"], lambda gap, hit: gap + F.length(hit))
        pairs = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["hits"])), x["hits"], lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
        row = lambda before, p: F.struct((before + p["gap"]).alias("start"), (before + p["gap"] + F.length(p["hit"])).alias("end"), p["hit"].alias("text"))
        return F.zip_with(sums(steps), pairs, row)

    return F.when(text.rlike(pattern) if may is None else may & text.rlike(pattern), let(found, placed)).otherwise(none(HIT)).cast(HIT)


def typed(hits: Column, entity_type: str, confidence: float, method: str, category: str, action: str) -> Column:
    """Hits as spans of one kind."""
    rest = {"entity_type": F.lit(entity_type), "confidence": F.lit(float(confidence)), "method": F.lit(method), "category": F.lit(category), "action": F.lit(action)}
    return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), h["text"].alias("text"), *[v.alias(k) for k, v in rest.items()])).cast(SPANS)


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def apart(new: Column, old: Column) -> Column:
    """The new spans that overlap none of the old ones: an interval anti join within the row.

    A block of new spans is held only against the old ones between its first start
    and its last end; new spans come from left to right.
    """

    def block(part: Column, old: Column) -> Column:
        near = F.filter(old, lambda o: (o["start"] < F.array_max(F.transform(part, lambda n: n["end"]))) & (o["end"] > F.get(part, F.lit(0))["start"]))
        return let(near, lambda near: F.filter(part, lambda n: ~F.exists(near, lambda o: overlap(n, o))))

    def blocks(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(x["new"]) - 1, F.lit(BLOCK))
        return F.flatten(F.transform(starts, lambda k: let(F.slice(x["new"], k + 1, F.lit(BLOCK)), lambda part: block(part, x["old"]))))

    few = lambda x: F.filter(x["new"], lambda n: ~F.exists(x["old"], lambda o: overlap(n, o)))
    return let(F.struct(new.alias("new"), old.alias("old")), lambda x: F.when(F.size(x["new"]) * F.size(x["old"]) <= BLOCK * BLOCK, few(x)).otherwise(blocks(x)))


def resolve(spans: Column) -> Column:
    """Disjoint spans, from left to right: of two that overlap the surer stays, else the shorter, else the first.

    Each span is held against the last one kept only.
    """
    numbered = F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), i.alias("i"), s.alias("span")))

    def step(kept: Column, x: Column) -> Column:
        new, last = x["span"], F.try_element_at(kept, F.lit(-1))
        better = (new["confidence"] > last["confidence"]) | ((new["confidence"] == last["confidence"]) & (F.length(new["text"]) < F.length(last["text"])))
        swapped = F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(new))
        return F.when((F.size(kept) == 0) | (new["start"] >= last["end"]), F.concat(kept, F.array(new))).when(better, swapped).otherwise(kept).cast(SPANS)

    return F.aggregate(F.array_sort(numbered), none(), step)


def splice(text: Column, edits: Column) -> Column:
    """text with each edit (start, end, replacement) put in; edits are disjoint and in order.

    The text is cut into pieces once; a gap is then taken from the pieces it lies in,
    not counted off from the start of the text.
    """

    def cut(x: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        near = F.array_join(F.slice(x["pieces"], first + 1, F.greatest(F.ceil(end / PIECE).cast("int") - first, F.lit(0))), "")
        return F.substring(near, start - first * PIECE + 1, end - start)

    def joined(x: Column) -> Column:
        before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(x["edits"], i - 1)["end"])
        parts = F.transform(x["edits"], lambda e, i: F.concat(cut(x, before(i), e["start"]), e["replacement"]))
        return F.concat(F.array_join(parts, ""), cut(x, F.element_at(x["edits"], F.lit(-1))["end"], x["n"]))

    whole = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"), edits.alias("edits"), F.length(text).alias("n"))
    return F.when(F.size(edits) > 0, let(whole, joined)).otherwise(text)


def snippet(text: Column, start: Column, end: Column, size: int) -> Column:
    """The text around a span, with dots where something was left out."""
    a, b = F.greatest(F.lit(0), start - size), F.least(F.length(text), end + size)
    return F.concat(F.when(a > 0, "...").otherwise(""), F.substring(text, a + 1, b - a), F.when(b < F.length(text), "...").otherwise(""))


def signs(text: Column, rules: P.Rules, *names: str) -> Column:
    """A struct that tells for each pattern whether the text may match it.

    Words are looked for in the text's bytes, in lower case where the pattern folds
    it; a regular expression, which costs ten times as much or more, then runs only
    on the texts that hold what it needs.
    """
    shapes = sorted({rules.shapes[n] for n in names if n in rules.shapes})
    seen = let(F.lower(text), lambda low: F.struct(low.alias("low"), contains_any(low, P.ODD).alias("odd"), *[text.rlike(s).alias(f"s{i}") for i, s in enumerate(shapes)]))

    def told(x: Column) -> Column:
        hint = lambda n: x["odd"] | contains_any(x["low"], P.HINTS[n]) if n in P.HINTS else F.lit(True)
        shape = lambda n: x[f"s{shapes.index(rules.shapes[n])}"] if n in rules.shapes else F.lit(True)
        return F.struct(*[(shape(n) & hint(n)).alias(n) for n in names])

    return let(seen, told)


def contains_any(text: Column, words) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def rows(df: DataFrame, array: Column | str, *keep: str) -> DataFrame:
    """keep and the fields of every element of an array of structs.

    An inner explode would make the optimizer infer a filter on the array's size
    and push a copy of the whole computation below every step that made it.
    """
    return df.select(*keep, F.explode_outer(array).alias("__row")).where("__row is not null").select(*keep, "__row.*")
