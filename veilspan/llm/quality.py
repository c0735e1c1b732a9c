r"""Quality rules: base counts, and bands of perplexity under an n-gram model of each language.

The model is a modified Kneser-Ney model of character 4-grams (white space runs
read as one space), one for each value of lang. It is counted over all
documents. Each task counts its documents'
4-grams, Spark adds the counts up, and discounts, continuation counts and
interpolated probabilities are computed as DataFrames, for all n-grams whatever
their number. Those of the most frequent 4-grams, MAX_ENTRIES at most (12 bytes
each), go to every task in arrays sorted by 64-bit hash with a directory over
their upper bits; a text's 4-grams that are not among them are joined with the
`rest`, which stays a DataFrame. So each 4-gram of each text counts with its own
probability, and MAX_ENTRIES decides where it is looked up, not what is found.
Log probabilities are multiples of 2^-20, whose sums do not depend on their order.

A document's score is its mean negative log probability per character. Per
language, the median and the median deviation of all documents span a band; a
deviation is scaled by the number of characters, so that short texts are not
rejected for being short. Documents above or below the band are rejected.

Defined cases: a null, empty or all-space text has counts of zero, no score and
fails the base rules. A null lang is a language of its own. A language whose
documents have no counted 4-gram has no model and its documents no score: the
base rules alone decide. Repeated rows are counted and judged each. Other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.llm import textnp
from veilspan.llm.common import materialize
from veilspan.shipping import ship

ORDER = 4
#: Entries of a model that are held in memory at most; the others are joined.
MAX_ENTRIES = 8_000_000
#: Median deviations (as standard deviations) from a language's middle to the lower and the upper end of its band.
LOWER, UPPER = 10.0, 16.0
#: Characters beyond which a text's score is taken to be as certain as it gets.
LONG = 2_000
#: Distinct 4-grams that a task holds before it hands them on.
HELD = 1_000_000
#: Bytes of text whose 4-grams are worked on at once; each takes about a hundred bytes meanwhile.
PIECE = 1 << 19
_U = np.uint64
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def _sums(per_byte: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(per_byte) + 1, np.int64)
    np.cumsum(per_byte, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(windows: np.ndarray, n: int) -> int:
    """Words that stand in 5-word windows found at least twice."""
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + 5, -1)
    return int((np.cumsum(edge) > 0).sum())


def _dup_lines(text: str) -> int:
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, n = set(), 0
    for line in lines:
        if line in seen:
            n += bool(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
        seen.add(line)
    return n


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    starts, ends, first = textnp.word_bounds(data, offsets)
    n_words = np.diff(first)
    chars = _sums(textnp._IS_WORD[data] & ((data & 0xC0) != 0x80), offsets)
    symbols = _sums(_SYMBOL[data], offsets)
    windows = textnp.window_hashes(textnp.word_hashes(data, starts, ends, lower=False), 5)
    raw, dup, rep = data.tobytes(), [], []
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        dup.append(_dup_lines(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")))
        rep.append(_repeats(windows[a : b - 4], b - a) if b - a > 5 else 0)
    return [n_words.astype(np.int64), chars, symbols, np.array(dup, np.int64), np.array(rep, np.int64)]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of all texts, packed 16 bits a character, and the text of each.

    Characters beyond the basic plane are folded into its private use area.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    at = lead[offsets]
    if at[-1] != len(points):  # malformed bytes: texts decoded one by one
        parts = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        points = np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint64)
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    points[points > 0xFFFF] = _U(0xE000) + (points[points > 0xFFFF] & _U(0x7FF))
    space = (points == 0x20) | ((points >= 9) & (points <= 13))
    points[space] = 0x20
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (text[1:] == text[:-1]))
    points, text = points[keep], text[keep]
    if len(points) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(points) - ORDER + 1
    key = np.zeros(n, np.uint64)
    for j in range(ORDER):
        key = (key << _U(16)) | points[j : j + n]
    whole = text[:n] == text[ORDER - 1 :]
    return key[whole], text[:n][whole]


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, list[int]]]:
    """Slices of a batch of (..., lang, text) with one language each, and their rows."""
    langs, texts = batch["lang"].to_pylist(), batch["text"]
    for lang in dict.fromkeys(langs):
        rows = [i for i, x in enumerate(langs) if x == lang]
        part = texts.take(pa.array(rows))
        for a, b in textnp.slices(part, PIECE):
            yield lang, part.slice(a, b - a), rows[a:b]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}

    def merged(lang: str) -> list[np.ndarray]:
        keys, n = held[lang]
        keys, back = np.unique(keys, return_inverse=True)
        return [keys, np.bincount(back, n, len(keys)).astype(np.int64)]

    def out(lang: str) -> pa.RecordBatch:
        keys, n = held.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "key", "c"])

    for batch in batches:
        for lang, texts, _ in _by_lang(batch):
            data, offsets = textnp.text_bytes(texts)
            keys, n = np.unique(grams(data, offsets)[0], return_counts=True)
            old = held.get(lang, [np.zeros(0, np.uint64), np.zeros(0, np.int64)])
            held[lang] = [np.concatenate([old[0], keys]), np.concatenate([old[1], n])]
            if len(held[lang][0]) > HELD:
                held[lang] = merged(lang)
                if len(held[lang][0]) > HELD // 2:
                    yield out(lang)
    for lang in list(held):
        held[lang] = merged(lang)
        yield out(lang)


def _suffix(n: int) -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << 16 * n) - 1))


def _level(counts: DataFrame, lower: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(lang, key, c, p) and (lang, context, g): interpolated probabilities and back-off weights of one order.

    lower is (lang, suffix, q), the order below; None is the uniform distribution.
    """
    c = F.col("c")
    n = counts.groupBy("lang").agg(*[F.sum((c == j).cast("long")).cast("double").alias(f"n{j}") for j in (1, 2, 3, 4)], F.count("*").alias("v"))
    y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))

    def discount(j: int) -> Column:
        d = F.lit(float(j)) - F.lit(float(j + 1)) * y * F.try_divide(F.col(f"n{j + 1}"), F.col(f"n{j}"))
        return F.least(F.greatest(F.coalesce(d, F.lit(j / 2)), F.lit(0.05)), F.lit(j - 0.05))

    # Written, so that the planner knows its size: joined by broadcast while it is small, and never by shuffling a language into one task.
    n = materialize(n.select("lang", "v", *[discount(j).alias(f"d{j}") for j in (1, 2, 3)]), "discounts")
    rows = counts.withColumn("context", F.shiftrightunsigned("key", 16)).join(n, "lang")
    rows = rows.withColumn("d", F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3")))
    weights = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("g"))
    rows = rows.join(weights, ["lang", "context"])
    if lower is None:
        rows = rows.withColumn("q", 1.0 / (F.col("v") + 1))
    else:
        rows = rows.join(lower, ["lang", "suffix"])
    return rows.select("lang", "key", "c", ((c - F.col("d")) / F.col("total") + F.col("g") * F.col("q")).alias("p")), weights.select("lang", "context", "g")


def _hash(lang: str, tag: int, key: np.ndarray) -> np.ndarray:
    salt = _U(zlib.crc32(lang.encode()) * 16 + tag)
    return textnp.mix64(key.view(np.uint64) ^ textnp.mix64(np.array([salt])))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, tag = batch["lang"].to_pylist(), batch["tag"].to_numpy()
        key, id_ = batch["key"].to_numpy(), np.zeros(batch.num_rows, np.uint64)
        pairs = {}
        for i, x in enumerate(zip(lang, tag.tolist(), strict=True)):
            pairs.setdefault(x, []).append(i)
        for (name, t), at in pairs.items():
            id_[at] = _hash(name, t, np.ascontiguousarray(key[at]))
        yield pa.RecordBatch.from_arrays([pa.array(id_.view(np.int64)), batch["value"].cast(pa.float32())], names=["id", "value"])


class SortedHashes:
    """Values by hash: ids in order, and a directory from an id's upper bits to its first place.

    `pruned` n-grams are not held here; `rest` has them and their back-off weights
    as (lang, tag, key, value). Tasks get a copy without it.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray, pruned: int = 0, rest: DataFrame | None = None):
        order = np.argsort(ids)
        self.pruned, self.rest = pruned, rest
        self.ids, self.values = ids[order], values[order].astype(np.float32)
        self.shift = _U(64 - max(1, int(len(ids)).bit_length() - 1))
        self.first = np.searchsorted(self.ids, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(ids)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rest": None}

    def find(self, ids: np.ndarray) -> np.ndarray:
        """The value of each id; NaN where there is none. A cell of the directory holds one or two ids as a rule."""
        out = np.full(len(ids), np.nan, np.float32)
        cell = (ids >> self.shift).astype(np.int64)
        at, end = self.first[cell], self.first[cell + 1]
        todo = np.flatnonzero(at < end)
        while len(todo):
            hit = self.ids[at[todo]] == ids[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return out


def _floors(levels: dict[int, DataFrame], most: int, entries: int) -> dict[int, int]:
    """The least count that n-grams of each order must have for `most` entries to do, `entries` for each; 1 keeps all."""
    # N-grams by count, in 64 steps for each doubling: every count has its own step below 90, and there are a few thousand steps at most.
    step = F.floor(64 * F.log2("c"))
    steps = {n: sorted(levels[n].groupBy(step.alias("step")).agg(F.min("c"), F.count("*")).drop("step").collect()) for n in levels}
    floors, total = dict.fromkeys(levels, 1), entries * sum(size for s in steps.values() for _, size in s)
    for n in sorted(levels, reverse=True):
        for (_, size), (above, _) in pairwise([*steps[n], (1 << 62, 0)]):
            if total <= most:
                return floors
            total, floors[n] = total - entries * size, above
    return floors


def _log(name: str) -> Column:
    return (F.round(F.log(name) * (1 << 20)) / (1 << 20)).cast("float").alias("value")


def train(docs: DataFrame, most: int = MAX_ENTRIES, own: bool = False) -> SortedHashes:
    """The model of docs (lang, text): `most` entries at most on the driver, those of the rarest n-grams in its rest.

    With `own`, it has no shorter n-grams and no back-off weights, which the texts it is learned from do not need.
    """
    ship(docs.sparkSession)
    counts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(_count, "lang string, key long, c long")
    counts = materialize(counts.groupBy("lang", "key").agg(F.sum("c").alias("c")), "grams")
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # how many different characters stand before an n-gram
        levels[n] = materialize(levels[n + 1].groupBy("lang", _suffix(n).alias("key")).agg(F.count("*").alias("c")), "grams")
    floors = _floors({ORDER: counts}, most, 1) if own else _floors(levels, most, 2)
    pruned = sum(levels[n].where(F.col("c") < floor).count() for n, floor in floors.items() if floor > 1)
    model, rest, lower = [], [], None
    for n in range(1, ORDER + 1):
        rows = levels[n].withColumn("suffix", _suffix(n - 1)) if n > 1 else levels[n]
        p, g = _level(rows, lower)
        p = materialize(p, "p")
        lower = p.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q"))
        if n not in floors:
            continue
        held = F.col("c") >= floors[n]
        parts = [(n, p.where(held), p.where(~held))]
        if not own:
            contexts = p.where(held).select("lang", F.shiftrightunsigned("key", 16).alias("key")).distinct()
            g = g.select("lang", F.col("context").alias("key"), F.col("g").alias("p"))
            parts.append((8 + n - 1, *(g.join(contexts, ["lang", "key"], how) for how in ("left_semi", "left_anti"))))
        for tag, inside, outside in parts:
            model.append(inside.select("lang", F.lit(tag).alias("tag"), "key", _log("p")))
            rest.append(outside.select("lang", F.lit(tag).alias("tag"), "key", _log("p")))
    found = reduce(DataFrame.unionByName, model).mapInArrow(_hashed, "id long, value float").toArrow()
    return SortedHashes(found["id"].to_numpy().view(np.uint64), found["value"].to_numpy(), pruned, reduce(DataFrame.unionByName, rest) if pruned else None)


def log_probabilities(model: SortedHashes, lang: str, key: np.ndarray) -> np.ndarray:
    """Of the last character of each 4-gram of any text; one that the model does not hold in memory backs off to a shorter one."""
    out = model.find(_hash(lang, ORDER, key))
    todo, back = np.flatnonzero(np.isnan(out)), np.zeros(len(key), np.float64)
    for n in range(ORDER - 1, -1, -1):
        if not len(todo):
            break
        rest = key[todo] & _U((1 << 16 * (n + 1)) - 1)
        weight = model.find(_hash(lang, 8 + n, np.ascontiguousarray(rest >> _U(16))))
        back[todo] += np.nan_to_num(weight, nan=0.0)
        p = model.find(_hash(lang, n, np.ascontiguousarray(key[todo] & _U((1 << 16 * n) - 1)))) if n else np.full(len(todo), -11.0, np.float32)
        out[todo] = p
        todo = todo[np.isnan(p)]
    return out + back


def _scorer(model):
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams")
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()), *((c, pa.int64()) for c in counted), ("nll", pa.float64()), ("key", pa.int64()), ("n", pa.int64())])

    def batch_of(size: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lang, texts, rows in _by_lang(batch):
                ids, row = row + np.arange(len(rows)), row + len(rows)
                data, offsets = textnp.text_bytes(texts)
                key, text = grams(data, offsets)
                logs = model.value.find(_hash(lang, ORDER, key))
                late = np.isnan(logs)
                logs[late] = 0
                counts = [*base_counts(data, offsets), np.bincount(text, minlength=len(rows)).astype(np.int64)]
                yield batch_of(len(rows), row=ids, doc_id=batch["doc_id"].take(pa.array(rows)), lang=[lang] * len(rows), nll=-np.bincount(text, logs, len(rows)), **dict(zip(counted, counts, strict=True)))
                if not late.any():
                    continue
                if not model.value.pruned:
                    raise ValueError("a 4-gram that was not counted: the documents changed between two reads")
                key, text = key[late], text[late]
                order = np.lexsort((key, text))
                key, text = key[order], text[order]
                first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])))
                yield batch_of(len(first), row=ids[text[first]], lang=[lang] * len(first), key=key[first].view(np.int64), n=np.diff(np.append(first, len(key))))

    return run


def _scores(docs: DataFrame, model: SortedHashes) -> DataFrame:
    """doc_id, lang, the base counts, n_grams and nll for every row of docs, from which model was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(_scorer(shared), "row long, doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, nll double, key long, n long")
    rows = materialize(rows, "scores")
    if not model.pruned:
        return rows.drop("row", "key", "n")
    # No key is hot here: a 4-gram of the rest is rarer than each of those held.
    late = rows.where(F.col("key").isNotNull()).select("row", "lang", "key", "n").join(model.rest.where(F.col("tag") == ORDER), ["lang", "key"], "left")
    value = F.coalesce(F.col("value").cast("double"), F.raise_error(F.lit("a 4-gram that was not counted: the documents changed between two reads")).cast("double"))
    late = late.groupBy("row").agg(F.sum(F.col("n") * value).alias("late"))
    rows = rows.where(F.col("key").isNull()).drop("key", "n").join(late, "row", "left")
    return materialize(rows.withColumn("nll", F.col("nll") - F.coalesce("late", F.lit(0.0))).drop("row", "late"), "scores")


def quality(docs: DataFrame, most: int = MAX_ENTRIES) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, score and deviation for every row of docs (doc_id, lang, text).

    `most` 4-grams of the model are held in memory; the result does not depend on it.
    """
    rows = _scores(docs, train(docs, most, own=True))
    rows = rows.withColumn("score", F.when(F.col("n_grams") > 0, F.col("nll") / F.col("n_grams")))
    # Rounded, a language has a few thousand different values however many documents it has.
    middle = materialize(rows.groupBy("lang").agg(F.percentile(F.round("score", 3), 0.5).alias("middle")), "middle")
    certain = F.sqrt(F.col("n_grams") / (1 + F.col("n_grams") / LONG))
    rows = rows.join(middle, "lang").withColumn("off", (F.col("score") - F.col("middle")) * certain)
    spread = materialize(rows.groupBy("lang").agg((1.4826 * F.percentile(F.round(F.abs("off"), 2), 0.5)).alias("spread")), "spread")
    rows = rows.join(spread, "lang").withColumn("deviation", F.col("off") / F.greatest("spread", F.lit(1e-3)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    verdict = F.coalesce(F.col("deviation").between(-LOWER, UPPER), F.lit(True))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & verdict).alias("kept"), "score", "deviation")
