r"""Toxicity by a learned lexicon, matched with Levenshtein automata over its trie.

Learning. From a bounded sample of labelled documents, words are counted in
toxic and in clean documents. Words far likelier in toxic ones become terms; a
prefix that many such words share becomes a stem. The terms form a trie. Words
within the edit bound of a term that clean documents use are remembered as
innocent. A part of the sample that the lexicon was not drawn from then fits a
logistic score on counts of exact, stem, misspelled and quoted hits.

Scoring. Each word is looked up in the lexicon, its stems, and the product of
the Levenshtein automaton (one edit for terms of 4 to 7 letters, two from 8) and
the trie, walked state by state, so a word leaves after the letters that no term
has. A context window decides whether a hit is quoted (between quotation marks,
or near a word of reporting) or abuse.

Defined cases: a null, empty or all-space text has no hits and gets the score of
such texts. Labels that are null, or whose document is missing, are not learned
from; without both kinds of labels every score is 0.25. Repeated rows get equal
scores. Rows without an id are scored and belong to fold 0. Other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspan.llm.common import fold, materialize
from veilspan.shipping import ship

#: Labelled documents that are learned from at most; the ones with the smallest hash.
MAX_LABELLED = 20_000
#: Terms and stems kept at most, the likeliest first: the classifier's size.
MAX_TERMS = 2_000
MIN_LOG_ODDS = 3.0
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_REPORTING = frozenset("said says wrote writes called calls quote quoted quotes word words term terms dit mot sagte wort dijo palabra".split())
_OPEN, _CLOSE = "\"“«„‘", "\"”»“’"
#: Words on either side that the context window spans.
CONTEXT = 6
#: Words of clean documents within the edits of a term that are remembered, the most used first.
MAX_INNOCENT = 200_000
#: Characters of a text that are split into words at once, and of the words that are remembered between texts.
PIECE, REMEMBERED = 1 << 20, 64


def bare(word: str) -> str:
    """A word in lower case without the signs around it."""
    low = word.lower()
    a, b = 0, len(low)
    while a < b and not low[a].isalnum():
        a += 1
    while b > a and not low[b - 1].isalnum():
        b -= 1
    return low[a:b]


def _pieces(text: str) -> Iterator[tuple[list[str], bool]]:
    """The words of a text piece by piece, and whether a piece is the last."""
    at, n = 0, len(text)
    while n - at > PIECE:
        m = _SPACE.search(text, at + PIECE)
        if not m:
            break
        yield _WORD.findall(text, at, m.start()), False
        at = m.start()
    yield _WORD.findall(text, at), True


def allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class Lexicon:
    """Terms, stems and the lazily built product of their trie with Levenshtein automata."""

    def __init__(self, terms: list[str], stems: list[str], innocent: list[str]):
        self.terms, self.stems, self.innocent = frozenset(terms), frozenset(stems), frozenset(innocent)
        self.lengths = sorted({len(s) for s in stems})
        self.children: list[dict[str, int]] = [{}]
        self.accepts, self.most = [-1], [0]
        for term in terms:
            node = 0
            for c in term:
                self.most[node] = max(self.most[node], allowed(term))
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.accepts.append(-1)
                    self.most.append(0)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], allowed(term))
            self.accepts[node] = allowed(term)
        self.moves: dict[tuple[int, str], int] = {}
        self.states: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.final: list[bool] = []
        self.start = self._state({(0, 0)})

    def _state(self, positions: set[tuple[int, int]]) -> int:
        """The number of a set of (node, edits), closed under skipping a letter of a term; -1 if empty."""
        todo, best = list(positions), {}
        while todo:
            node, edits = todo.pop()
            if edits <= self.most[node] and edits < best.get(node, 9):
                best[node] = edits
                todo += [(child, edits + 1) for child in self.children[node].values()]
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.final.append(any(e <= self.accepts[n] for n, e in key))
        return self.number[key]

    def _move(self, state: int, c: str) -> int:
        to: set[tuple[int, int]] = set()
        for node, edits in self.states[state]:
            to.add((node, edits + 1))
            for letter, child in self.children[node].items():
                to.add((child, edits + (letter != c)))
        return self._state(to)

    def near(self, word: str) -> bool:
        """Whether a term is within its edit bound of word."""
        state = self.start
        for c in word:
            step = (state, c)
            if step not in self.moves:
                if len(self.moves) > 200_000:
                    self.moves.clear()
                self.moves[step] = self._move(state, c)
            state = self.moves[step]
            if state < 0:
                return False
        return self.final[state]

    def kind(self, word: str) -> int:
        """0 for no hit, 1 for a term, 2 for a stem, 3 for a misspelled term."""
        w = bare(word)
        if not w:
            return 0
        if w in self.terms:
            return 1
        if any(w[:n] in self.stems for n in self.lengths if n < len(w)):
            return 2
        return 3 if len(w) >= 4 and w not in self.innocent and self.near(w) else 0

    def hits(self, text: str, clean: set[str], known: dict[str, int]) -> list[tuple[int, bool]]:
        """(kind, quoted) of every hit. clean and known remember words between calls."""
        out: list[tuple[int, bool]] = []
        words: list[str] = []
        first = 0
        for part, last in _pieces(text):
            words += part
            kinds = {}
            for w in set(words) - clean:
                k = known[w] if w in known else self.kind(w)
                if k:
                    kinds[w] = k
                if len(w) <= REMEMBERED:
                    if k:
                        known[w] = k
                    else:
                        clean.add(w)
            # The last words of a piece wait for the context that follows them.
            stop = len(words) if last else max(first, len(words) - CONTEXT)
            if kinds:
                out += [(kinds[words[i]], quoted(words, i)) for i in range(first, stop) if words[i] in kinds]
            back = max(0, stop - CONTEXT)
            words, first = words[back:], stop - back
        return out


def quoted(words: list[str], at: int) -> bool:
    """Whether the context reports the word: quotation marks close around it, or a word of reporting just before."""
    before, after = words[max(0, at - CONTEXT) : at + 1], words[at : at + CONTEXT + 1]
    opened = any(w[0] in _OPEN for w in before) and not any(w.rstrip(".,;:!?")[-1:] in _CLOSE for w in before[:-1] if len(w) > 1)
    if opened and any(w.rstrip(".,;:!?")[-1:] in _CLOSE for w in after if len(w) > 1):
        return True
    return any(bare(w) in _REPORTING for w in before[-3:-1])


def features(hits: list[tuple[int, bool]]) -> list[float]:
    n = Counter(4 if quote else kind for kind, quote in hits)
    return [1 + math.log(n[k]) if n[k] else 0.0 for k in (1, 2, 3, 4)]


HITS = "struct<exact:double,stem:double,near:double,quoted:double>"


def _hits(model):
    """A function of texts: the features of their hits, by the lexicon in a broadcast model."""

    @F.arrow_udf(HITS)
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lexicon = model.value.lexicon
        clean: set[str] = set()
        known: dict[str, int] = {}
        for part in parts:
            rows = []
            for text in part:
                if len(clean) > 300_000:
                    clean.clear()
                if len(known) > 100_000:
                    known.clear()
                rows.append(features(lexicon.hits(text.as_py() or "", clean, known)))
            x = np.array(rows, np.float64).reshape(-1, 4)
            yield pa.StructArray.from_arrays([pa.array(x[:, j]) for j in range(4)], ["exact", "stem", "near", "quoted"])

    return found


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each word, toxic and clean, of one partition."""
    n: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            n.update((w, toxic) for w in {bare(w) for w in set(_WORD.findall(text or ""))})
        if len(n) > 300_000:
            yield _counted(n)
            n.clear()
    yield _counted(n)


def _counted(n: Counter) -> pa.RecordBatch:
    columns = [pa.array([w for w, _ in n], pa.string()), pa.array([c if t == 1 else 0 for (_, t), c in n.items()], pa.int64()), pa.array([c if t != 1 else 0 for (_, t), c in n.items()], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "pos", "neg"])


class Model:
    """A lexicon and the weights of its score."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights


#: Before any evidence: a base rate of one in four, and what a hit of each kind should count.
_PRIOR = np.array([-1.0986, 4.0, 4.0, 2.0, 0.0])


def _fit(x: np.ndarray, y: np.ndarray, strength: float = 0.5) -> np.ndarray:
    """Logistic regression by damped Newton steps, drawn towards _PRIOR."""
    x, w = np.column_stack([np.ones(len(x)), x]), _PRIOR.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + strength / 2 * ((w - _PRIOR) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + strength * (w - _PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), grad)
        rate = 1.0
        while loss(w - rate * step) > loss(w) and rate > 1e-6:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from documents whose crc32(doc_id as text) mod 5 is not 0."""
    spark = docs.sparkSession
    ship(spark)
    chosen = labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(fold(F.col("doc_id"), 5) != 0).distinct()
    chosen = materialize(chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(MAX_LABELLED), "labelled")
    # At most MAX_LABELLED rows of 12 bytes, whatever the tables' size.
    sample = materialize(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id"), "sample")
    part = fold(F.col("doc_id"), 5)
    source = sample.where(part != 4)
    totals = {r["toxic"]: r["n"] for r in source.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    p, n = totals.get(1, 0), sum(v for k, v in totals.items() if k != 1)
    if not p or not n:
        return Model(Lexicon([], [], []), _PRIOR)

    counts = source.select("text", "toxic").mapInArrow(_words_of, "word string, pos long, neg long").where("word <> ''")
    counts = materialize(counts.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "words")
    odds = F.log((F.col("pos") + 0.5) / (p + 1)) - F.log((F.col("neg") + 0.5) / (n + 1))
    # A term must be in more toxic documents than any of so many words would be by chance alone.
    chance = math.log(10 * max(1, counts.count())) / math.log((p + n) / p)
    least = max(4, math.ceil(chance), p // 100)
    prefix = counts.select("word", "pos", "neg", F.explode(F.sequence(F.lit(3), F.least(F.length("word") - 1, F.lit(8)))).alias("k")).where("length(word) > 3").withColumn("stem", F.substring("word", F.lit(1), F.col("k")))
    prefix = prefix.groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("words")).where((F.col("words") >= 8) & (F.col("pos") >= 2 * max(8, least)) & (odds >= MIN_LOG_ODDS))
    stems = [r["stem"] for r in prefix.orderBy(odds.desc(), "stem").limit(MAX_TERMS).collect()]
    stems = [s for s in stems if not any(s[:k] in stems for k in range(3, len(s)))]
    single = counts.where((F.col("pos") >= least) & (odds >= MIN_LOG_ODDS) & (F.length("word") >= 3) & (F.length("word") <= 40))
    terms = [r["word"] for r in single.orderBy(odds.desc(), "word").limit(MAX_TERMS).collect()]
    terms = [t for t in terms if not any(t.startswith(s) for s in stems)]

    lexicon = Lexicon(terms, stems, [])

    @F.arrow_udf("boolean")
    def near(words: pa.Array) -> pa.Array:
        return pa.array([lexicon.near(w) for w in words.to_pylist()], pa.bool_())

    # Words that clean documents use, within the edits of a few thousand terms.
    used = counts.where((F.col("neg") > 0) & (odds < 1.0) & (F.length("word") <= 42)).where(near("word"))
    lexicon = Lexicon(terms, stems, [r["word"] for r in used.orderBy(F.desc("neg"), "word").limit(MAX_INNOCENT).collect()])

    model = Model(lexicon, _PRIOR)
    rest = sample.where(part == 4).select("toxic", _hits(spark.sparkContext.broadcast(model))(F.col("text")).alias("h")).select("toxic", "h.*").toArrow()
    x, y = (np.column_stack([rest[c].to_numpy() for c in names]) for names in (["exact", "stem", "near", "quoted"], ["toxic"]))
    model.weights = _fit(x, (y[:, 0] == 1).astype(float)) if rest.num_rows else _PRIOR
    return model


def _score(docs: DataFrame, model: Model) -> Column:
    """The score of each text of docs; the lexicon is broadcast (MAX_TERMS and MAX_INNOCENT words at most)."""
    ship(docs.sparkSession)
    w = [float(x) for x in model.weights]
    h = _hits(docs.sparkSession.sparkContext.broadcast(model))(F.col("text").cast("string"))
    # Written once in the plan: each mention would be another pass through Python.
    return F.get(F.transform(F.array(h), lambda h: F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(w[0]) + h["exact"] * w[1] + h["stem"] * w[2] + h["near"] * w[3] + h["quoted"] * w[4])))), F.lit(0))


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """keep, score and predicted for every row."""
    return docs.select(*keep, _score(docs, model).alias("score")).select(*keep, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    model = learn(docs, labels)
    return score(docs, model, "doc_id").select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic."""
    return docs.where(_score(docs, learn(docs, labels)) < 0.5)
