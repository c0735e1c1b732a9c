"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words; a document of it is expected
target / source size times. Within a source the documents lie in a fixed order
(by size class first), the prefix sums of their expected copies are moved by one
offset, and a document is emitted once for every integer that its step crosses.
Because all documents of a source expect equally many copies, the prefix sum is
rank times that number, and ranks come from counts of small cells (source, size
class, salt): no source is sorted in one task. A cell of more than CELL documents
is cut into finer ones, by size and ranges of the hash, which keep its order.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; a source without words has target 0 and is not taken. Repeated
rows are documents of their own. Rows without an id are placed by their text. An
empty table gives an empty result. All columns are kept; an input column named
like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspan.llm.common import materialize, n_words

#: A document expects this many copies at most.
MOST = 3
#: Cells of one size class of a source; the order in a source is by cell, then size, then id.
SALTS = 16
#: Documents that one task ranks; cells of more are cut.
CELL = 200_000


def _hash(x: Column) -> Column:
    """32 bits of the md5 of a text, which any SQL engine can compute."""
    return F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target and start (the offset) from source, source_size, documents.

    The weights 1, 2, 3 repeat over the sources in code-point order, null last.
    Sharing the excess of capped sources again and again ends where all sources
    that are not capped have one ratio of target to weight; sorted by cap over
    weight, the capped ones come first. The table has one row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    t = sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1).withColumn("cap", MOST * F.col("source_size"))
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    t = t.withColumn("below", F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    t = t.withColumn("heavy", F.sum("weight").over(every) - F.sum("weight").over(up.rowsBetween(Window.unboundedPreceding, 0)) + F.col("weight"))
    t = t.withColumn("ratio", (F.sum("source_size").over(every) - F.col("below")).cast("double") / F.col("heavy").cast("double"))
    # The first source that its cap does not bind has the common ratio; the ones before it are capped.
    t = t.withColumn("level", F.min(F.when(F.col("ratio") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "ratio"))).over(every)["ratio"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(float(MOST))) * F.col("weight"))
    start = (_hash(F.concat(F.lit("mix:"), F.coalesce(F.col("source"), F.lit("\0null")))) % 1_048_576).cast("double") / F.lit(1_048_576.0)
    return t.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"), start.alias("start"))


def copies(docs: DataFrame) -> DataFrame:
    """docs with size, source_size, target and copies for every row."""
    # Input columns go under numbers, so that none clashes and Catalyst can drop those that no one reads.
    kept = [c for c in docs.columns if c.lower() not in {"size", "source_size", "target", "copies"}]
    own = {c.lower(): F.col(f"in{i}") for i, c in enumerate(kept)}
    rows = docs.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(kept)])
    name = F.coalesce(own["doc_id"].cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(own["text"], F.lit("")).cast("binary"))))
    rows = rows.withColumns({"source": own["source"].cast("string"), "size": n_words(own["text"]), "h": _hash(name)})
    rows = rows.withColumns({"key": F.coalesce("source", F.lit("\0null")), "step": F.floor(F.sqrt("size")).cast("long"), "salt": (F.col("h") % SALTS).cast("int")})

    cells = materialize(rows.groupBy("key", "source", "step", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "cells")
    known = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size"))).withColumn("key", F.coalesce("source", F.lit("\0null"))).drop("source")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key").orderBy("step", "salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = materialize(cells.withColumn("before", before).join(known, "key").select("key", "step", "salt", "n", "before", "source_size", "target", "start"), "cells")

    by = ["key", "step", "salt"]
    most = cells.agg(F.max("n")).first()[0] or 0
    if most > CELL:
        # Within a cell the order is by size, then hash: so cells of one size and one range of hashes continue it.
        rows = rows.join(cells.select(*by, F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / CELL))).cast("int").alias("bits")), by)
        rows = rows.withColumn("range", F.expr("shiftright(h, 32 - bits)")).withColumn("exact", F.when(F.col("bits") > 0, F.col("size")).otherwise(0)).drop("bits")
        fine = rows.groupBy(*by, "exact", "range").agg(F.count("*").alias("n"))
        ahead = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("exact", "range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cells = materialize(fine.withColumn("ahead", ahead).drop("n").join(cells, by).withColumn("before", F.col("before") + F.col("ahead")).drop("ahead"), "fine")
        by = [*by, "exact", "range"]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("size"), F.col("h"), own["doc_id"]))
    out = rows.join(cells, by).withColumn("k", (F.col("before") + rank).cast("double"))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    taken = F.floor(F.col("k") * each + F.col("start")) - F.floor((F.col("k") - 1) * each + F.col("start"))
    return out.select(*[F.col(f"in{i}").alias(c) for i, c in enumerate(kept)], "size", "source_size", "target", F.least(taken, F.lit(MOST)).cast("long").alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """docs with every row repeated as often as the mix takes it."""
    found = copies(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")).select("whole", F.col("whole.doc_id").alias("doc_id"), F.col("whole.text").alias("text"), F.col("whole.source").alias("source")))
    return found.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("whole.*")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), r AS (
  SELECT *, floor(sqrt(size))::BIGINT AS step, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS h FROM d
), k AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY step, h % 16, size, h, doc_id)::DOUBLE AS k FROM r
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap FROM s
), u AS (
  SELECT *, sum(cap) OVER o - cap AS below, (SELECT sum(weight) FROM c) - sum(weight) OVER o + weight AS heavy
  FROM c WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), v AS (
  SELECT *, ((SELECT sum(source_size) FROM c) - below)::DOUBLE / heavy::DOUBLE AS ratio FROM u
), t AS (
  SELECT source, source_size,
    coalesce(least(cap::DOUBLE, coalesce((SELECT ratio FROM v WHERE ratio * weight <= cap ORDER BY cap / weight, ratio LIMIT 1), 3.0::DOUBLE) * weight), 0.0) AS target,
    (('0x' || substr(md5('mix:' || coalesce(source, chr(0) || 'null')), 1, 8))::BIGINT % 1048576)::DOUBLE / 1048576.0::DOUBLE AS start
  FROM v
), e AS (
  SELECT k.*, t.source_size, t.target, t.start, CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0 END AS each
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (least(floor(k * each + start) - floor((k - 1) * each + start), 3) * size)::BIGINT AS taken FROM e
"""
