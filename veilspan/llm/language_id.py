r"""Language identification by nearest centroid over TF-IDF character n-grams.

A text's lower-cased character 1- to 3-grams (letters; everything else reads as
one space) are hashed to 4,096 dimensions. Document frequencies are counted over
all documents that may be learned from; the vectors of a bounded sample of them
are clustered by spherical k-means, some centroids for each language. Every
language that occurs gets its share of the sample, however many rows another one
or a repeated row has. A text
gets the language of the centroid with the highest cosine. It is rejected when
that cosine is below what all but a small share of the centroid's own training
texts reach; the operator reports this in `rejected` and keeps the nearest
language. Of equal cosines the first language by code point wins.

Defined cases: a null text or one without letters is `und` with score 0. When
nothing can be learned, every text is `und`. Documents with a null lang are
predicted but not learned from. Repeated rows get equal predictions. A null id
is in fold 0, so it may be learned from. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspan.llm import textnp
from veilspan.llm.common import fold, materialize
from veilspan.shipping import ship

DIMENSIONS = 4096
#: Texts whose vectors are clustered, at most: of each language an equal share, those with the smallest hash; one of each language at least.
MAX_SAMPLE = 4_000
CLUSTERS = 4
#: The share of a centroid's own training texts that its threshold may reject.
REJECT = 0.005
_U = np.uint64


def counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts, dimensions) n-gram counts, and whether each text has a letter."""
    data, offsets = textnp.text_bytes(texts)
    rows = [data[a:b].tobytes().decode("utf-8", "replace").lower() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    joined = "".join(rows)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    letter = _letters(points)
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (text[1:] == text[:-1])  # the first sign after a letter is the space
    points = np.where(letter, points, 0x20).astype(np.uint64)[keep]
    text = text[keep]
    out = np.zeros((len(rows), DIMENSIONS), np.float32)
    key = np.zeros(len(points), np.uint64)
    for n in (1, 2, 3):
        if len(points) < n:
            break
        key = (key[: len(points) - n + 1] << _U(21)) | points[n - 1 :]
        whole = text[: len(key)] == text[n - 1 :]
        at = (textnp.mix64(key[whole] ^ _U(n << 61)) % _U(DIMENSIONS)).astype(np.int64)
        out += np.bincount(text[: len(key)][whole] * DIMENSIONS + at, minlength=out.size).reshape(out.shape)
    has = np.zeros(len(rows), bool)
    has[text] = True
    return out, has


_letter_table: np.ndarray | None = None


def _letters(points: np.ndarray) -> np.ndarray:
    """Whether each code point is a letter, by a table over the basic plane; beyond it, letters but for pictographs."""
    global _letter_table
    if _letter_table is None:
        _letter_table = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)
    low = points < 0x10000
    out = np.zeros(len(points), bool)
    out[low] = _letter_table[points[low]]
    if not low.all():
        out[~low] = [chr(c).isalpha() for c in points[~low].tolist()]
    return out


def vectors(counted: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors with logarithmic term frequencies."""
    return unit(np.log1p(counted), idf)


def unit(logs: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = logs * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded bytes and of at most 256 rows, for the dense matrix."""
    for a, b in textnp.slices(texts):
        for i in range(a, b, 256):
            yield i, min(b, i + 256)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for a, b in _pieces(batch["text"]):
            x, has = counts(batch["text"].slice(a, b - a))
            total += (x > 0).sum(0)
            n += int(has.sum())
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["d", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in _pieces(batch["text"]):
            x, has = counts(batch["text"].slice(a, b - a))
            rows = [r.tobytes() for r in np.log1p(x[has]).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([*(batch[c].slice(a, b - a).filter(pa.array(has)) for c in ("lang", "h")), pa.array(rows, pa.binary())], names=["lang", "h", "x"])


def _kmeans(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's; the first seeds are rows far from those before."""
    seeds, near = [0], x @ x[0]
    for _ in range(1, min(k, len(x))):
        seeds.append(int(near.argmin()))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    own = np.zeros(len(x), int)
    for _ in range(15):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c, own


class Centroids:
    def __init__(self, idf: np.ndarray, centroids: np.ndarray, langs: list[str], least: np.ndarray):
        self.idf, self.centroids, self.langs, self.least = idf, centroids, langs, least


def learn(docs: DataFrame, clusters: int = CLUSTERS) -> Centroids | None:
    """Centroids of the rows of docs (doc_id, lang, text)."""
    ship(docs.sparkSession)
    n = dict(docs.select("text").mapInArrow(_frequencies, "d long, n long").groupBy("d").agg(F.sum("n")).collect())  # DIMENSIONS + 1 rows
    total = n.pop(-1, 0)
    idf = np.zeros(DIMENSIONS, np.float32)
    for d, x in n.items():
        idf[d] = np.log((1 + total) / (1 + x)) + 1
    # Of each language the different texts with the smallest hash: a bound on the hash leaves few, and those are ranked.
    rows = docs.select("lang", "text", F.xxhash64("text", F.lit(5)).alias("h"))
    shares = materialize(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")), "shares")  # a row for each language
    each = max(1, MAX_SAMPLE // max(1, shares.count()))
    bounds = shares.select("lang", (F.lit(-(2.0**63)) + F.least(F.lit(1.0), F.lit(2.0 * each + 20) / F.col("n")) * 2.0**64).alias("below"))
    low = rows.join(bounds, "lang").where(F.col("h") <= F.col("below"))
    ranked = low.select("lang", "h").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("rank") <= each)
    ranked = materialize(ranked.select("lang", "h"), "sampled")  # MAX_SAMPLE rows, or one for each language
    found = rows.join(F.broadcast(ranked), ["lang", "h"]).select("lang", "h", "text").mapInArrow(_sampled, "lang string, h long, x binary")
    found = found.groupBy("lang", "h").agg(F.any_value("x").alias("x")).orderBy("lang", "h").toArrow()
    if not found.num_rows:
        return None
    x = unit(np.frombuffer(b"".join(found["x"].to_pylist()), np.float16).reshape(found.num_rows, -1).astype(np.float32), idf)
    lang, centroids, langs, least = np.array(found["lang"].to_pylist()), [], [], []
    for name in sorted(set(lang)):
        c, own = _kmeans(x[lang == name], clusters)
        near = (x[lang == name] * c[own]).sum(1)
        for j in range(len(c)):
            if (own == j).any():
                centroids.append(c[j])
                langs.append(str(name))
                least.append(float(np.quantile(near[own == j], REJECT)))
    return Centroids(idf, np.stack(centroids).astype(np.float32), langs, np.array(least))


def _predictor(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for a, b in _pieces(batch["text"]):
                x, has = counts(batch["text"].slice(a, b - a))
                lang, score, rejected = ["und"] * (b - a), np.zeros(b - a), np.ones(b - a, bool)
                if m is not None:
                    cosine = vectors(x, m.idf) @ m.centroids.T
                    best = cosine.argmax(1)
                    near = cosine[np.arange(b - a), best]
                    lang = [m.langs[j] if ok else "und" for j, ok in zip(best.tolist(), has.tolist(), strict=True)]
                    score = np.where(has, np.clip(near, 0, 1), 0.0).astype(np.float64)
                    rejected = ~has | (near < m.least[best])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), pa.array(lang), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(_predictor(shared), "doc_id long, lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected; learns where crc32(doc_id as text) mod 3 is not 1."""
    part = fold(F.col("doc_id"), 3)
    known = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where((part != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return identify(docs, learn(known)).select("doc_id", (part == 1).alias("held_out"), "lang_pred", "score", "rejected")
