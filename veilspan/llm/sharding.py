"""Sharding by balanced label propagation.

Documents of equal text are linked. Every document starts in a shard given by a
hash of its id; in each round the linked documents move towards the shard where
most of their neighbours are, as far as quotas allow, until none can move. That
ends: a round moves a group's cells only into its largest open cell, so the sum of
the squared cell sizes grows with every round. At last the documents without
links fill every shard up to its quota. The law kept is ``rows``: shard
sizes are at most one document apart.

Copies in one shard are interchangeable, so a round does not work on documents
but on cells (group, shard, number of documents). A group has at most one cell
per shard, so a group of any size makes no hot key, and a cell may move in part.
The flow between each pair of shards is settled on the driver from their matrix
of demands (shards squared numbers); prefix sums over the cells then say which
of them move. They are taken in two levels, over sums of small buckets and inside
each, so that no flow between two shards is sorted in one task. Documents are dealt to their group's cells by rank; ranks come
from salted counts, so a hot group is numbered in many tasks.

Defined cases: a null text has size 16, a null crc32 and is linked with nothing;
empty texts are equal texts. Repeated rows are linked documents and get slots of
their own. An empty table gives an empty result. Input columns named like an
output column are replaced.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspan.llm.common import materialize

CELL = "g long, shard int, n long"


def _grant(demand: dict[tuple[int, int], int], load: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """The largest part of the demanded flows, cut in source order, that overfills no shard."""
    flow, cap = dict(demand), [max(q, x) for q, x in zip(quota, load, strict=True)]
    while True:
        after = list(load)
        for (s, t), x in flow.items():
            after[s] -= x
            after[t] += x
        over = [t for t in range(len(load)) if after[t] > cap[t]]
        if not over:
            return flow
        for t in over:
            excess = after[t] - cap[t]
            for s in range(len(load)):
                cut = min(excess, flow.get((s, t), 0))
                if cut:
                    flow[s, t] -= cut
                    excess -= cut


def _before(cells: DataFrame, part: list[str], order: dict[str, bool], buckets: int) -> DataFrame:
    """cells with before: the sum of n ahead of each row of its part, in the given order (True: falling), then by bucket and g."""
    rows = cells.withColumn("bucket", F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int"))
    by = [*part, *order, "bucket"]
    ahead = Window.partitionBy(*part).orderBy(*[F.desc(c) if down else F.asc(c) for c, down in order.items()], "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*by).agg(F.sum("n").alias("ahead")).withColumn("ahead", F.coalesce(F.sum("ahead").over(ahead), F.lit(0)))
    inside = F.sum("n").over(Window.partitionBy(*by).orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    return rows.join(sums, by).withColumn("before", F.col("ahead") + F.coalesce(inside, F.lit(0))).drop("ahead", "bucket")


def _loads(cells: DataFrame, shards: int) -> list[int]:
    load = [0] * shards
    for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # a row for each shard
        load[r["shard"]] = r["n"]
    return load


def _moved(cells: DataFrame, shards: int, quota: list[int], load: list[int], buckets: int) -> DataFrame | None:
    """One round: the cells after the moves, or None when nothing can move."""
    open_ = [j for j in range(shards) if load[j] < quota[j]]
    liked = cells.where(F.col("shard").isin(open_)).groupBy("g").agg(F.max(F.struct("n", F.xxhash64("g", "shard").alias("tie"), "shard")).alias("best"))
    wish = cells.join(liked, "g", "left").withColumn("to", F.when((F.col("best.shard") != F.col("shard")) & (F.col("best.n") >= F.col("n")), F.col("best.shard")))
    wish = materialize(wish.select("g", "shard", "n", "to", F.col("best.n").alias("pull")), "wish")
    demand = {(r["shard"], r["to"]): r["n"] for r in wish.where("to is not null").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
    flow = {k: v for k, v in _grant(demand, load, quota).items() if v}
    if not flow:
        return None
    allowed = cells.sparkSession.createDataFrame([(s, t, x) for (s, t), x in flow.items()], "shard int, to int, flow long")
    go = _before(wish.join(F.broadcast(allowed), ["shard", "to"]), ["shard", "to"], {"pull": True}, buckets)
    go = go.select("g", "shard", "to", F.least("n", F.greatest(F.lit(0), F.col("flow") - F.col("before"))).alias("go"))
    change = go.select("g", "shard", (-F.col("go")).alias("n")).unionByName(go.select("g", F.col("to").alias("shard"), F.col("go").alias("n")))
    return materialize(cells.unionByName(change).groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "cells")


def _evicted(cells: DataFrame, shards: int, quota: list[int], load: list[int], buckets: int) -> DataFrame:
    """Moves what a shard holds above its quota, smallest cells first, to shards with room."""
    surplus, spans, k = [max(0, x - q) for x, q in zip(load, quota, strict=True)], [], 0
    room = [max(0, q - x) for x, q in zip(load, quota, strict=True)]
    for s in range(shards):
        at = 0
        while at < surplus[s]:
            while not room[k]:
                k += 1
            take = min(room[k], surplus[s] - at)
            spans.append((s, k, at, at + take))
            room[k] -= take
            at += take
    if not spans:
        return cells
    spans = cells.sparkSession.createDataFrame(spans, "shard int, to int, low long, high long")
    at = cells.where(F.col("shard").isin([s for s in range(shards) if surplus[s]])).withColumn("size", F.col("n"))
    at = _before(at, ["shard"], {"size": False}, buckets)
    go = at.join(F.broadcast(spans), "shard").withColumn("go", F.least(F.col("before") + F.col("n"), F.col("high")) - F.greatest("before", "low")).where("go > 0")
    change = go.select("g", "shard", (-F.col("go")).alias("n")).unionByName(go.select("g", F.col("to").alias("shard"), F.col("go").alias("n")))
    return materialize(cells.unionByName(change).groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "cells")


def shard_documents(docs: DataFrame, shards: int = 40, rounds: int | None = None) -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard for every row.

    docs needs doc_id and text; its other columns are kept. rounds bounds the rounds; None lets them run to rest.
    """
    # Input columns go under numbers, so that none clashes and Catalyst can drop those that no one reads.
    kept = [c for c in docs.columns if c.lower() not in {"size", "text_crc32", "law", "shard", "slot", "grown_shard"}]
    own = {c.lower(): F.col(f"in{i}") for i, c in enumerate(kept)}
    text, doc_id = own["text"], own["doc_id"]
    group = F.when(text.isNull(), F.xxhash64(F.lit("null"), doc_id)).otherwise(F.xxhash64(text))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(kept)])
    rows = rows.withColumns({"size": (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long"), "text_crc32": F.crc32(text.cast("binary")), "g": group, "h": F.xxhash64(doc_id)})

    total = docs.count()
    salts, wide = max(16, total // 200_000), max(64, total // 50_000)
    rows = rows.withColumn("salt", F.pmod(F.col("h"), F.lit(salts)).cast("int"))
    starts = rows.groupBy("g", "salt", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int").alias("shard")).agg(F.count("*").alias("n"))
    starts = materialize(starts, "starts")
    groups = starts.groupBy("g").agg(F.sum("n").alias("members")).where("members > 1")
    # A hot group's cells meet in one task only where their join is not by broadcast and Spark does not split it.
    starts = materialize(starts.join(groups, "g", "left").withColumn("members", F.coalesce("members", F.lit(1))), "starts")
    quota = [total // shards + (j < total % shards) for j in range(shards)]

    cells = materialize(starts.where("members > 1").groupBy("g", "shard").agg(F.sum("n").alias("n")), "cells")
    for _ in itertools.count() if rounds is None else range(rounds):
        moved = _moved(cells, shards, quota, _loads(cells, shards), wide)
        if moved is None:
            break
        cells = moved
    cells = _evicted(cells, shards, quota, _loads(cells, shards), wide)
    load = _loads(cells, shards)

    # Where each group's documents go, by their rank in the group.
    first = F.sum("n").over(Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    places = _before(cells, ["shard"], {}, wide).withColumnRenamed("before", "base").withColumn("first", F.coalesce(first, F.lit(0)))
    places = places.groupBy("g").agg(F.collect_list(F.struct("first", (F.col("first") + F.col("n")).alias("end"), "shard", "base")).alias("places"))

    salted = starts.groupBy("g", "salt", "members").agg(F.sum("n").alias("n"))
    linked = salted.where("members > 1").withColumn("rank0", F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    linked = linked.join(places, "g").select("g", "salt", "rank0", "places")

    # Documents without links, numbered 0, 1, ... over the whole table, fill what is left.
    single = salted.where("members = 1").withColumn("b", F.pmod(F.xxhash64("g"), F.lit(wide)).cast("int"))
    counts = single.groupBy("b").agg(F.count("*").alias("n"))
    offset = counts.select("b", F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # `wide` rows
    single = single.join(offset, "b").withColumn("r", F.col("before") + F.row_number().over(Window.partitionBy("b").orderBy("g", "salt")) - 1)
    at, free = 0, []
    for j in range(shards):
        left = max(0, quota[j] - load[j])
        free.append(F.struct(F.lit(at).cast("long").alias("first"), F.lit(at + left).cast("long").alias("end"), F.lit(j).alias("shard"), F.lit(load[j]).cast("long").alias("base")))
        at += left
    single = single.select("g", "salt", F.col("r").cast("long").alias("rank0"), F.filter(F.array(*free), lambda p: (F.col("r") >= p["first"]) & (F.col("r") < p["end"])).alias("places"))

    plan = materialize(linked.unionByName(single), "places")
    rank = F.row_number().over(Window.partitionBy("g", "salt").orderBy(doc_id, F.col("size"))) - 1
    out = rows.join(plan, ["g", "salt"]).withColumn("rank", F.col("rank0") + rank)
    out = out.withColumn("place", F.filter("places", lambda p: (F.col("rank") >= p["first"]) & (F.col("rank") < p["end"]))[0])
    return out.select(*[F.col(f"in{i}").alias(c) for i, c in enumerate(kept)], "size", "text_crc32", F.lit("rows").alias("law"), F.col("place.shard").alias("shard"), (F.col("place.base") + F.col("rank") - F.col("place.first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
