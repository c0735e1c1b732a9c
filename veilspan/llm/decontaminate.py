"""Benchmark decontamination over canonical template windows.

Texts are canonicalised: units after numbers, numbers and names become typed
placeholders, letters are lower-cased and everything else separates tokens. There
are two readings: in one, names are capitalised words inside a sentence; in the
other, capitalised words anywhere, up to four in a row being one name. Either may
find an item. Windows of five consecutive canonical tokens
are hashed and joined with the windows of the benchmark. An item is found in a
document when at least 80 % of its windows are there and its slots are filled
consistently in one of its occurrences (one alignment, near alignments, or the
first places): wherever the item repeats a value, the document repeats one too.
So is an item of which an unbroken passage holds 13 tokens of equal value, if the
whole passage that they share is consistent. A question that was only given other numbers, names or units is so caught, and
one that merely has the same shape in another sense is not.

The main path is DataFrame functions only: no Python runs on the executors.

Defined cases: a null or empty text has no windows. An item of fewer than five
tokens matches a document that has the same canonical tokens and no others; one
without tokens matches nothing. Documents without an id are never reported.
Repeated rows of a document or an item count once. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspan.llm.common import materialize

WINDOW, PERCENT = 5, 80
#: Tokens of equal value in one unbroken passage of an item that are a finding, whatever the item's length.
RUN = 13
#: Benchmark windows of at most this many rows (24 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Of the item values that stand in several slots, the share that must have one counterpart each.
CONSISTENT = 0.8

_UNITS = "km/h|m/s|kilomet(?:er|re)s?|centimet(?:er|re)s?|met(?:er|re)s?|miles?|feet|foot|inch(?:es)?|kilograms?|grams?|pounds?|ounces?|lit(?:er|re)s?|hours?|minutes?|seconds?|days?|weeks?|months?|years?|percent|dollars?|euros?|cents?|km|cm|mm|kg|mg|lbs?|oz|ml|mph|kmh|hz|kb|mb|gb|m|g|l|h|s"
#: Placeholders are letters of the private use area, so that no text token equals one by chance.
NUM, UNIT, NAME = "\ue000", "\ue001", "\ue002"
_NUMBER = r"\p{Nd}+(?:[.,:/]\p{Nd}+)*"
_SPLIT = rf"[^\p{{L}}\p{{M}}\p{{Nd}}{NUM}-{NAME}]+"


def _marked(text: Column, keep: bool) -> Column:
    """text with placeholders; keep leaves the value behind its placeholder, joined to it."""
    unit, num, name = (f" {p}{v} " for p, v in ((UNIT, "$2"), (NUM, "$0"), (NAME, "$0"))) if keep else (f" {p} " for p in (UNIT, NUM, NAME))
    text = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{NUM}-{NAME}]", " ")
    text = F.regexp_replace(text, r"\p{Lu}(?<=[\p{Ll}\p{Nd},;] \p{Lu})\p{Ll}+(?![\p{L}\p{M}])", name)
    text = F.regexp_replace(text, rf"(\p{{Nd}})\s?((?i:{_UNITS})|%)(?![\p{{L}}\p{{M}}])", f"$1{unit}")
    return F.regexp_replace(text, _NUMBER, num)


def tokens(text: Column) -> Column:
    """Canonical tokens of a text."""
    return _split(_marked(text, keep=False))


def _split(marked: Column) -> Column:
    return F.filter(F.split(F.lower(marked), _SPLIT), lambda t: t != "")


def valued_tokens(text: Column) -> Column:
    """The same tokens, each placeholder followed by the value that it stands for."""
    return _split(_bare(_marked(text, keep=True)))


def _bare(valued: Column) -> Column:
    """A marked text with its values free of separators."""
    return F.regexp_replace(valued, rf"(?<=\p{{Nd}})[.,:/](?=\p{{Nd}})|(?<={UNIT}(?:km|m))/(?=[hs])", "")


def _named(marked: Column, keep: bool) -> Column:
    """A marked text where capitalised words anywhere are names too, and up to four in a row are one."""
    word = r"\p{Lu}\p{Ll}+(?![\p{L}\p{M}])"
    one = f"{NAME}?({word})" if keep else f"(?:{NAME}|{word})"
    return F.regexp_replace(marked, rf"(?<![\p{{L}}\p{{M}}\p{{Nd}}{NUM}{UNIT}]){one}" + rf"(?:\s+{one})?" * 3, f" {NAME}$1$2$3$4 " if keep else f" {NAME} ")


def _readings(rows: DataFrame, *keep: str, values: bool = False) -> DataFrame:
    """keep, reading and t of both readings of text, with values also v: 0 as tokens() has it, 1 with all names."""
    texts = {"t": False} | ({"v": True} if values else {})
    rows = rows.select(*keep, *[_marked(F.col("text"), keep=k).alias(c) for c, k in texts.items()])
    both = [F.array(*[_split(_bare(x) if k else x) for x in (F.col(c), _named(F.col(c), k))]).alias(c) for c, k in texts.items()]
    rows = rows.select(*keep, *both)
    # Unfolded outer, here and below: an inner unfolding makes the optimizer copy the whole computation into a filter.
    rows = rows.select(*keep, F.posexplode_outer(F.arrays_zip(*texts)).alias("reading", "z"))
    return rows.select(*keep, "reading", *[F.col(f"z.{c}").alias(c) for c in texts])


def _windows(rows: DataFrame, *keep: str, values: str | None = None) -> DataFrame:
    """keep, reading, at (0-based position) and w (hash) of every window of t; with values, the five of v beside it, so named."""
    keep = (*keep, "reading")
    n = F.greatest(F.size("t") - (WINDOW - 1), F.lit(0))
    rows = rows.withColumn("t", F.transform("t", lambda x: F.xxhash64(x)))
    own = [F.col("v")] if values else []
    rows = rows.select(*keep, *own, *[F.slice("t", j + 1, n).alias(f"z{j}") for j in range(WINDOW)])
    long = rows.select(*keep, *own, F.posexplode_outer(F.arrays_zip(*[F.col(f"z{j}") for j in range(WINDOW)])).alias("at", "z")).where("at is not null")
    return long.select(*keep, "at", F.xxhash64("reading", *[F.col(f"z.z{j}") for j in range(WINDOW)]).alias("w"), *[F.slice(v, F.col("at") + 1, WINDOW).alias(values) for v in own])


def _occurrences(hits: DataFrame) -> DataFrame:
    """hits once for each place where the item may stand: kind, occurrence and the hit; hits have every pair of equal windows.

    "all" takes the first place of each item window, wherever it is, "line" those of one alignment,
    "run" those of one alignment without a gap, and "band" those of near alignments (words were put in or left out), the best filled alignment first.
    """
    pair = ["doc_id", "item_id", "reading"]
    hits = hits.withColumn("line", F.col("at") - F.col("item_at"))
    first = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*pair, "item_at").orderBy("at", "dk", "ik"))).where("rank = 1").drop("rank")
    first = first.select(F.lit("all").alias("kind"), F.lit(0).cast("long").alias("occurrence"), *hits.columns)
    line = hits.select(F.lit("line").alias("kind"), F.xxhash64("dk", "ik", "line").alias("occurrence"), *hits.columns)
    band = F.floor(F.col("line") / (8 + F.floor(F.col("item_windows") / 5)))
    near = hits.withColumn("filled", F.count("*").over(Window.partitionBy(*pair, "dk", "ik", "line")))
    near = near.withColumn("band", F.explode(F.array(band, band - 1))).withColumn("occurrence", F.xxhash64("dk", "ik", "band"))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy(*pair, "occurrence", "item_at").orderBy(F.desc("filled"), "at"))).where("rank = 1")
    begin = F.col("item_at") - F.row_number().over(Window.partitionBy(*pair, "dk", "ik", "line").orderBy("item_at"))
    run = hits.withColumn("begin", begin).select(F.lit("run").alias("kind"), F.xxhash64("dk", "ik", "line", "begin").alias("occurrence"), *hits.columns)
    return first.unionByName(line).unionByName(run).unionByName(near.select(F.lit("band").alias("kind"), "occurrence", *hits.columns))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows, item_windows, coverage and reparameterised of every item found.

    docs needs doc_id and text, benchmark needs item_id and text.
    """
    items = benchmark.where("item_id is not null").select("item_id", F.col("text").cast("string").alias("text")).distinct()
    items = materialize(_readings(items.withColumn("ik", F.xxhash64("text")), "item_id", "ik", values=True), "items")
    sizes = items.select("item_id", "reading", F.greatest(F.size("t") - (WINDOW - 1), F.lit(1)).alias("item_windows")).groupBy("item_id", "reading").agg(F.max("item_windows").alias("item_windows"))
    wanted = materialize(_windows(items, "item_id", "ik", values="i").withColumnRenamed("at", "item_at"), "item-windows")
    few = wanted.count() <= BROADCAST_ROWS

    texts = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"))
    places = wanted.select("item_id", "item_at", "w", "reading")
    hits = _windows(_readings(texts, "doc_id"), "doc_id").select("doc_id", "w", "reading").join(F.broadcast(places) if few else places, ["w", "reading"])
    # What a document shares with an item, as distinct item windows; most pairs are far below the bound.
    hits = hits.select("doc_id", "item_id", "reading", "item_at").distinct()
    enough = hits.groupBy("doc_id", "item_id", "reading").agg(F.count("*").alias("windows")).join(sizes, ["item_id", "reading"])
    enough = enough.where((100 * F.col("windows") >= PERCENT * F.col("item_windows")) | (F.col("windows") > RUN - WINDOW))
    enough = materialize(enough, "enough")

    # The few documents left, with every place of every window, are judged occurrence by occurrence.
    again = materialize(texts.join(enough.select("doc_id").distinct(), "doc_id", "left_semi"), "again").distinct()
    again = _readings(again.withColumn("dk", F.xxhash64("text")), "doc_id", "dk", values=True)
    hits = _windows(again, "doc_id", "dk", values="d").join(F.broadcast(wanted) if few else wanted, ["w", "reading"])
    hits = materialize(hits.join(enough.drop("windows"), ["doc_id", "item_id", "reading"]).drop("w"), "hits")
    key = ["doc_id", "item_id", "reading", "kind", "occurrence"]
    taken = materialize(_occurrences(hits), "occurrences")
    full = taken.groupBy(*key, "item_windows").agg(F.count_distinct("item_at").alias("n"))
    full = full.where(F.when(F.col("kind") == "run", F.col("n") > RUN - WINDOW).otherwise(100 * F.col("n") >= PERCENT * F.col("item_windows"))).select(*key, "n")

    # Slot values side by side, occurrence by occurrence.
    slots = taken.join(full.drop("n"), key).select(*key, "item_at", F.posexplode(F.arrays_zip("i", "d")).alias("j", "z"))
    slots = slots.select(*key, (F.col("item_at") + F.col("j")).alias("place"), "z.i", "z.d").where(F.col("i").rlike(f"^[{NUM}-{NAME}]") & F.col("d").isNotNull()).distinct()
    each = slots.groupBy(*key, "i").agg(F.count_distinct("place").alias("places"), F.count_distinct("d").alias("values"), F.max((F.col("i") != F.col("d")).cast("int")).alias("other"), F.count_if(F.col("i") != F.col("d")).alias("changed"))
    verdict = each.groupBy(*key).agg(F.avg(F.when(F.col("places") > 1, (F.col("values") == 1).cast("double"))).alias("consistent"), F.max("other").alias("other"), F.sum("changed").alias("changed"))
    verdict = full.join(verdict, key, "left").where(F.coalesce("consistent", F.lit(1.0)) >= CONSISTENT)
    verdict = verdict.where((F.col("kind") != "run") | (F.col("n") + (WINDOW - 1) - F.coalesce("changed", F.lit(0)) >= RUN))
    verdict = verdict.groupBy("doc_id", "item_id", "reading").agg(F.min(F.coalesce("other", F.lit(0))).alias("other"))

    # Of two readings the better covered one speaks.
    out = enough.join(verdict, ["doc_id", "item_id", "reading"]).withColumn("coverage", F.col("windows") / F.col("item_windows"))
    out = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", -F.col("reading"), "windows", "item_windows", "other")).alias("best"))
    out = out.select("doc_id", "item_id", "best.windows", F.col("best.item_windows").cast("long").alias("item_windows"), "best.coverage", (F.col("best.other") > 0).alias("reparameterised"))
    short = items.where(f"reading = 0 and size(t) between 1 and {WINDOW - 1}").select("item_id", F.concat_ws(" ", "t").alias("all")).distinct()
    if short.isEmpty():
        return out
    whole = texts.select("doc_id", tokens(F.col("text")).alias("t")).where(f"size(t) between 1 and {WINDOW - 1}").select("doc_id", F.concat_ws(" ", "t").alias("all")).distinct()
    alike = whole.join(short, "all").select("doc_id", "item_id", F.lit(1).cast("long").alias("windows"), F.lit(1).cast("long").alias("item_windows"), F.lit(1.0).alias("coverage"), F.lit(False).alias("reparameterised"))
    return out.unionByName(alike)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold a benchmark item; rows without an id stay."""
    gone = materialize(contaminated(docs.select("doc_id", "text"), benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(gone, "doc_id", "left_anti")
