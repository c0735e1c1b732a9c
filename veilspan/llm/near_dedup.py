"""Near-duplicate components with HyperMinHash sketches.

A text's words are hashed to 64 bits and its distinct k-word shingles form a
set. One pass makes a HyperMinHash sketch of 256 buckets: per bucket the
leading-zero count (6 bits) and 10 mantissa bits of the smallest hash. The
compressed registers, with empty buckets filled from others (densified), are
cut into bands; texts that agree on a band are candidates. A candidate pair's
Jaccard is estimated from the registers, less the register collisions expected
of unrelated sets, and pairs within five standard errors of the threshold are
verified on their full sets.

How skew is handled, without pairs of all rows and without caps:

* texts of equal sets are one class from the start, whatever their ids;
* round 1 compares each band bucket's members with one of them only, the one
  that shares the most bands in all; a leader goes to each group of its members
  once, ahead of them, and is not copied to every pair;
* round 2 takes the buckets that still hold several components and compares the
  registers of every pair of different components left, in blocks of members.
  Only texts of pairs that the estimate admits are fetched; a block emits a
  forest of its links, not its pairs;
* keys of very many rows (equal sets, large components) are joined by broadcast.

So every pair that shares a band is either in one component already or tested.

Defined cases: a null, empty or all-space text has an empty set, is linked with
nothing and is its own component. Fewer than k words: the whole sequence is the
only shingle. A row is a document: repeated rows of one id and text give equal
rows, and rows of one id with different texts are linked each by its own text.
Rows without an id link nothing and come back with a null component. Columns
beyond id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.llm import textnp
from veilspan.llm.common import hot_limit, join_hot, materialize
from veilspan.llm.components import connected_components
from veilspan.shipping import ship

BUCKETS, MANTISSA = 256, 10
#: Members of a band bucket that one block compares with another block, and the bytes of their texts.
BLOCK, BLOCK_BYTES = 256, 8 << 20
#: The chance, at the threshold itself, that no band is shared.
MISS = 1e-4
_U = np.uint64


def band_rows(threshold: float) -> int:
    """The most registers a band may have for the miss chance to stay below MISS."""
    return max(r for r in range(1, 17) if r == 1 or (1 - threshold**r) ** (BUCKETS // r) <= MISS)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, 256) uint16: leading zeros + 1 in the upper 6 bits, then the mantissa; 0 is empty."""
    edge = np.arange(BUCKETS, dtype=np.uint64) << _U(56)
    low = np.zeros((len(sets), BUCKETS), np.uint64)
    full = np.zeros((len(sets), BUCKETS), bool)
    for i, u in enumerate(sets):
        if len(u):
            at = np.minimum(np.searchsorted(u, edge), len(u) - 1)
            low[i], full[i] = u[at], (u[at] >= edge) & (u[at] >> _U(56) == edge >> _U(56))
    rest = (low & _U((1 << 56) - 1)) >> _U(3)
    zeros = (53 - np.frexp(rest.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((rest << zeros) >> _U(52 - MANTISSA)) & _U((1 << MANTISSA) - 1)
    return np.where(full, ((zeros + _U(1)) << _U(MANTISSA)) | mantissa, _U(0)).astype(np.uint16)


_PROBES = np.stack([(textnp.mix64(np.arange(BUCKETS, dtype=np.uint64) + _U(1000 * k)) % _U(BUCKETS)).astype(np.int64) for k in range(1, 65)])


def densified(regs: np.ndarray) -> np.ndarray:
    """Empty buckets filled from the bucket that a fixed probe order reaches first; then from the right."""
    out, todo = regs.copy(), np.flatnonzero((regs == 0).any(1) & (regs != 0).any(1))
    for probe in _PROBES:
        if not len(todo):
            return out
        part = out[todo]
        out[todo] = np.where(part == 0, regs[todo][:, probe], part)
        todo = todo[(out[todo] == 0).any(1)]
    for i in todo:
        have = np.flatnonzero(regs[i])
        gaps = np.flatnonzero(out[i] == 0)
        out[i, gaps] = regs[i, have[np.searchsorted(have, gaps) % len(have)]]
    return out


def band_keys(regs: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands) int64 keys; a band's number is part of its key."""
    dense, n = densified(regs).astype(np.uint64), BUCKETS // rows
    keys = np.zeros((len(regs), n), np.uint64)
    for j in range(rows):
        keys = textnp.mix64(keys * _U(0x9E3779B97F4A7C15) + dense[:, j : n * rows : rows] + np.arange(n, dtype=np.uint64)[None, :] * _U(0xD6E8FEB86659FD93))
    return keys.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard of register rows, and the buckets it rests on.

    Unrelated sets agree on a register when both minima fall in one cell: one
    leading-zero level and one of its 1,024 mantissa cells.
    """
    used = ((a != 0) | (b != 0)).sum(-1)
    equal = ((a == b) & (a != 0)).sum(-1)
    level = np.float64(2.0) ** -np.arange(1, 55)

    def at(n: np.ndarray) -> np.ndarray:
        rate = (np.asarray(n, np.float64) / BUCKETS)[..., None]
        return np.exp(-rate * level) - np.exp(-rate * 2 * level)

    chance = BUCKETS * (at(na) * at(nb)).sum(-1) / (1 << MANTISSA)
    chance = np.minimum(chance, used - 1e-9)
    return np.clip((equal - chance) / np.maximum(used - chance, 1e-9), 0, 1), used


def may_link(a, b, na, nb, threshold: float) -> np.ndarray:
    """Whether the estimate is within five standard errors of the threshold, and the sizes allow it."""
    jaccard, used = estimate(a, b, na, nb)
    sizes = np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
    return sizes & (jaccard >= threshold - 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1)) - 1e-9)


def _sketcher(k: int):
    names = ["doc_id", "mark", "bytes", "n_shingles", "set_a", "set_b", "regs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in textnp.slices(batch["text"]):
                part = batch.slice(start, stop - start)
                data, offsets = textnp.text_bytes(part["text"])
                sets = list(textnp.shingle_sets(data, offsets, k))
                n = pa.array([len(s) for s in sets], pa.int64())
                two = [pa.array(np.array([textnp.mix64(s ^ _U(salt)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)) for salt in (0x5DEECE66D, 0x2545F4914F6CDD1D)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["mark"], pa.array(np.diff(offsets)), n, *two, pa.array([r.tobytes() for r in registers(sets)], pa.binary())], names=names)

    return run


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, a mark (hash) of the text, its bytes, set size, 128-bit set digest and registers of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), _mark(F.col("text")).alias("mark"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sketcher(k), "doc_id long, mark long, bytes long, n_shingles long, set_a long, set_b long, regs binary")


def _mark(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _banded(threshold: float) -> Callable:
    """Adds the band keys of the registers."""
    rows = band_rows(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = band_keys(_registers(part["regs"]), rows)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, bands], names=[*part.schema.names, "bands"])

    return run


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], schema=_PAIRS)


def _estimated(threshold: float) -> Callable:
    """Of rows (a, b, n, data) that follow their leader's (b is null), the pairs that the estimate admits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = None
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, n, regs = (*(batch[c].to_pylist() for c in ("a", "b")), batch["n"].to_numpy(), _registers(batch["data"]))
            heads = [i for i, x in enumerate(b) if x is None] + [batch.num_rows]
            kept: list[tuple[int, int]] = []
            for start, stop in zip([0, *heads], heads, strict=False):
                if start < stop and b[start] is None:
                    lead = (a[start], n[start], regs[start])
                    start += 1
                if start < stop:
                    ok = np.flatnonzero(may_link(lead[2], regs[start:stop], lead[1], n[start:stop], threshold))
                    kept += [(lead[0], b[start + i]) for i in ok.tolist()]
            yield _pair_batch(kept)

    return run


def _verified(k: int, percent: int) -> Callable:
    """Of rows (a, b, data) that follow their leader's, the pairs whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = None
        for batch in batches:
            a, b, texts = batch["a"].to_pylist(), batch["b"].to_pylist(), batch["data"].cast(pa.large_string())
            kept: list[tuple[int, int]] = []
            for start, stop in textnp.slices(texts):
                sets = textnp.shingle_sets(*textnp.text_bytes(texts.slice(start, stop - start)), k)
                for i, s in zip(range(start, stop), sets, strict=True):
                    if b[i] is None:
                        lead = s.copy()
                    elif _alike(lead, s, percent):
                        kept.append((a[i], b[i]))
            yield _pair_batch(kept)

    return run


def _alike(u: np.ndarray, v: np.ndarray, percent: int) -> bool:
    if 100 * min(len(u), len(v)) < percent * max(len(u), len(v)):
        return False
    both = len(np.intersect1d(u, v, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(u) + len(v) - both)


def _led(pairs: DataFrame, things: DataFrame, run: Callable) -> DataFrame:
    """run over (a, b, n, data), sorted so that the thing of each leader a comes (with a null b) before those of its b.

    things is (node, n, data). A leader of very many pairs leads several groups, so
    that no group grows with the table; its thing is sent to each of them once.
    """
    limit = hot_limit(pairs.count())
    salts = materialize(pairs.groupBy("a").agg(F.count("*").alias("pairs")).where(F.col("pairs") > limit).select("a", F.ceil(F.col("pairs") / limit).cast("int").alias("salts")), "salts")
    salted = pairs.join(F.broadcast(salts), "a", "left")
    # These joins are by shuffle at every size: a broadcast of pairs would only hide, on small tables, what large ones cost.
    things = things.hint("merge")
    members = salted.select("a", F.coalesce(F.pmod(F.xxhash64("b"), "salts"), F.lit(0)).alias("salt"), F.col("b").alias("node")).join(things, "node")
    leads = pairs.select("a").distinct().join(F.broadcast(salts), "a", "left")
    leads = leads.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1)).alias("salt")).join(things, "node")
    both = leads.select(F.col("node").alias("a"), "salt", F.lit(None).cast("long").alias("b"), "n", "data").unionByName(members.select("a", "salt", F.col("node").alias("b"), "n", "data"))
    return both.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, n, data) with the texts of nodes, one row for each."""
    need = materialize(nodes.join(reps.select("node", "n", "rep", "mark"), "node"), "need")
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), _mark(F.col("text")).alias("mark"), F.col("text").cast("string").alias("data"))
    found = materialize(rows.join(need.hint("merge"), ["rep", "mark"]).select("node", "n", "data"), "texts")
    # Repeated rows of an id come more than once; as a rule there are none, and no text is sorted.
    return found if found.count() == need.count() else materialize(found.groupBy("node", "n").agg(F.any_value("data").alias("data")), "texts")


def _admitted(threshold: float) -> Callable:
    """Compares the registers of a block of a bucket's minority members with those of one block of all its members.

    A pair is compared in the first band it shares only. A row comes out for each
    block with pairs that the estimate lets through, the likeliest first.
    """
    names = ["key", "x", "y", "a", "b", "component_a", "component_b"]
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4]

    def side(members: pa.ListScalar):
        s = members.values
        return s.field("node").to_numpy(), s.field("component").to_numpy(), s.field("n").to_numpy(), _registers(s.field("regs")), s.field("bands").flatten().to_numpy().reshape(len(s), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                key = batch["key"][i].as_py()
                (ra, ca, na, xa, ka), (rb, cb, nb, xb, kb) = side(batch["few"][i]), side(batch["all"][i])
                found: list[tuple[float, int, int]] = []
                for j in range(len(ra)):
                    other = np.flatnonzero(cb != ca[j])
                    if len(other):
                        same = kb[other] == ka[j]
                        other = other[ka[j][same.argmax(1)] == key]
                    if len(other):
                        other = other[may_link(xa[j], xb[other], na[j], nb[other], threshold)]
                        found += zip((-estimate(xa[j], xb[other], na[j], nb[other])[0]).tolist(), [j] * len(other), other.tolist(), strict=True)
                if found:
                    found.sort()
                    js, os = (np.array([f[at] for f in found]) for at in (1, 2))
                    rows.append((key, batch["x"][i].as_py(), batch["y"][i].as_py(), ra[js], rb[os], ca[js], cb[os]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)], names=names)

    return run


def _forest(k: int, percent: int) -> Callable:
    """Verifies a block's admitted pairs, unless links of the block connect them already; what comes out is a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch["texts"][i].values
                where = {node: at for at, node in enumerate(held.field("node").to_pylist())}
                data = held.field("data").cast(pa.large_string())
                root: dict[int, int] = {}
                sets: dict[int, np.ndarray] = {}
                out: list[tuple[int, int]] = []

                def top(x: int, root=root) -> int:
                    while root.get(x, x) != x:
                        x = root[x]
                    return x

                def set_of(node: int, sets=sets, where=where, data=data) -> np.ndarray:
                    if node not in sets:
                        sets[node] = next(textnp.shingle_sets(*textnp.text_bytes(data.slice(where[node], 1)), k))
                    return sets[node]

                for a, b, ca, cb in zip(*(batch[c][i].as_py() for c in ("a", "b", "component_a", "component_b")), strict=True):
                    x, y = top(ca), top(cb)
                    if x != y and _alike(set_of(a), set_of(b), percent):
                        root[max(x, y)] = min(x, y)
                        out.append((a, b))
                if out:
                    yield _pair_batch(out)

    return run


def _left_over(docs: DataFrame, reps: DataFrame, buckets: DataFrame, labels: DataFrame, k: int, percent: int) -> DataFrame:
    """Round 2: leaders have met all of their bucket; links between the others, which have not met each other."""
    left = buckets.where("node <> lead and members > 2").select("key", "node")
    left = left.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    parts = left.groupBy("key", "component").agg(F.count("*").alias("part"))
    shape = parts.groupBy("key").agg(F.sum("part").alias("members"), F.max(F.struct("part", "component")).alias("top"), F.count("*").alias("components")).where("components > 1")
    open_ = materialize(left.join(shape.select("key", "members", F.col("top.component").alias("most")), "key"), "open")
    member = open_.join(reps.select("node", "n", "bytes", "regs", "bands").hint("merge"), "node")
    weight = member.groupBy("key").agg(F.sum("bytes").alias("weight"))
    member = member.join(weight, "key").withColumn("blocks", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("weight") / BLOCK_BYTES)).cast("int"))
    member = materialize(member.withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "members")
    row = F.struct("node", "component", "n", "regs", "bands")
    few = member.where("component <> most").groupBy("key", "blocks", F.col("mine").alias("x")).agg(F.collect_list(row).alias("few"))
    few = few.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = member.groupBy("key", F.col("mine").alias("y")).agg(F.collect_list(row).alias("all"))
    pairs = few.join(every, ["key", "y"]).select("key", "x", "y", "few", "all")
    pairs = materialize(pairs.mapInArrow(_admitted(percent / 100), "key long, x int, y int, a array<long>, b array<long>, component_a array<long>, component_b array<long>"), "admitted")
    nodes = pairs.select("key", "x", "y", F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    texts = _texts(docs, nodes.select("node").distinct(), reps)
    held = nodes.join(texts.hint("merge"), "node").groupBy("key", "x", "y").agg(F.collect_list(F.struct("node", "data")).alias("texts"))
    return materialize(pairs.join(held, ["key", "x", "y"]).mapInArrow(_forest(k, percent), "a long, b long").distinct(), "links")


def _components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, mark, n_shingles, component_id and kept of every row."""
    ship(docs.sparkSession)
    threshold = percent / 100
    sketches = materialize(sketch(docs, k), "sketch")
    digest = ["set_a", "set_b", "n_shingles"]
    # A class is all rows of one set. Its node is a number of its own, fixed by being written; ids may name several texts.
    classes = sketches.where("n_shingles > 0 and doc_id is not null").groupBy(*digest)
    classes = classes.agg(F.min(F.struct("doc_id", "mark", "bytes")).alias("first"), F.any_value("regs").alias("regs"), F.count("*").alias("rows"))
    classes = classes.select(*digest, F.col("n_shingles").alias("n"), "rows", F.col("first.doc_id").alias("rep"), "first.mark", "first.bytes", F.monotonically_increasing_id().alias("node"), "regs")
    schema = "set_a long, set_b long, n_shingles long, n long, rows long, rep long, mark long, bytes long, node long, regs binary, bands array<long>"
    reps = materialize(classes.mapInArrow(_banded(threshold), schema), "reps")

    band = reps.select("node", F.explode("bands").alias("key"))
    shared = band.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    buckets = materialize(band.join(shared.hint("merge"), "key"), "buckets")
    centre = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    buckets = buckets.join(centre, "node")
    leaders = buckets.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("lead")).select("key", F.col("lead.node").alias("lead"))
    buckets = materialize(buckets.drop("weight").join(leaders, "key"), "buckets")
    pairs = materialize(buckets.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    pairs = materialize(_led(pairs, reps.select("node", "n", F.col("regs").alias("data")), _estimated(threshold)), "pairs")
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), reps)
    links = materialize(_led(pairs, texts, _verified(k, percent)), "links")
    labels = connected_components(links)
    more = _left_over(docs, reps, buckets, labels, k, percent)
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))

    owned = materialize(reps.select("node", *digest, "rep", "rows").join(labels, "node", "left"), "owned")
    sizes = owned.where("component is not null").groupBy("component").agg(F.count("*").alias("n"), F.min("rep").alias("smallest"))
    sizes = materialize(sizes, "sizes")
    found = join_hot(owned, sizes.select("component", "smallest"), ["component"], sizes.where(F.col("n") > hot_limit(owned.count())))
    found = materialize(found.select(*digest, "rows", F.coalesce("smallest", "rep").alias("component_id")), "found")
    rows = sketches.select("doc_id", "mark", *digest)
    out = join_hot(rows, found.drop("rows"), digest, found.where(F.col("rows") > hot_limit(sketches.count())))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "mark", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) for every row of docs.

    docs needs doc_id and text. Two texts are linked when
    100 * |A and B| >= percent * |A or B| over their k-word shingle sets.
    """
    return _components(docs, k, percent).drop("mark")


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows that are near copies of one with a smaller id.

    Rows without an id are kept; of repeated rows of one id and text all are kept.
    """
    gone = _components(docs.select("doc_id", "text"), k, percent).where("not kept and doc_id is not null").select("doc_id", "mark").distinct()
    gone = materialize(gone.toDF("gone_id", "gone_mark"), "gone")
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["gone_id"]) & (_mark(docs["text"]) == gone["gone_mark"]), "left_anti")
