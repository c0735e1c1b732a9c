r"""Secret scans: rules, and a character convolutional network over every candidate.

Three rules find assignments, access keys and long hex runs; their spans always
stay. A candidate is any run of 16 or more token characters with a letter and a
digit that is left when the rules' spans are taken out. A small network
(character embedding, one convolution over the candidate and one over its
context, maxima, a logistic unit), written in numpy, scores every candidate with
the text around it; a long one is scored in overlapping windows, and its highest
score counts.

It is trained on labelled findings. By default these are the rules' findings in
a bounded sample of the documents, and generated secrets and look-alikes of
common formats in contexts without a keyword. Other candidates of the documents
have no label and are not learned from, as real secrets are among them;
`labelled` replaces the sample. A held-out part calibrates the scores (Platt)
and sets the threshold: the most precise of those that keep the wanted recall.

Defined cases: a null or empty text has no spans (its digest is that of the empty
string). Spans count code points, ends exclusive. Repeated rows get equal rows. A
text of any length is scanned whole. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.llm.common import materialize
from veilspan.shipping import ship

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}")
KINDS = ("assign", "access", "hex", "network")
#: Documents whose findings are learned from, and findings, at most: those with the smallest hash.
MAX_DOCUMENTS = 2_000
MAX_EXAMPLES = 3_000
RECALL = 0.95
_BEFORE, _BODY, _AFTER = 24, 48, 12
_ALPHABET = {c: i for i, c in enumerate(map(chr, range(32, 127)), 2)}
_SIZE, _DIM, _WIDTH, _FILTERS = 98, 8, 5, 24


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the rules find, in order."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the token runs with a letter and a digit, in what sorted taken spans leave of the text."""
    out, at, i, reach = [], 0, 0, 0
    for m in CANDIDATE.finditer(text):
        start, stop = m.span()
        # Both lists are in order, so each span is passed once; reach is the furthest end of those passed.
        while i < len(taken) and taken[i][0] <= start:
            reach = max(reach, taken[i][2])
            i += 1
        at = max(start, reach)
        while at < stop:
            end = taken[i][0] if i < len(taken) and taken[i][0] < stop else stop
            piece = text[at:end].rstrip(".-~") if end > at else ""
            if len(piece) >= 16 and any(c.isdigit() for c in piece) and any(c.isalpha() for c in piece):
                out.append((at, at + len(piece)))
            if end == stop:
                break
            reach = max(reach, taken[i][2])
            i += 1
            at = max(at, reach)
    return out


def _code(s: str) -> list[int]:
    return [_ALPHABET.get(c, 1) for c in s]


def encode(text: str, start: int, end: int) -> list[list[int]]:
    """Fixed-length codes: context, a window of the candidate, context; one for each window of a long candidate."""
    out = []
    for a in range(start, max(start + 1, end - _BODY // 2), _BODY // 2):
        b = min(end, a + _BODY)
        body = _code(text[a:b])
        before, after = _code(text[max(0, a - _BEFORE) : a]), _code(text[b : b + _AFTER])
        out.append([0] * (_BEFORE - len(before)) + before + body + [0] * (_BODY - len(body)) + after + [0] * (_AFTER - len(after)))
    return out


class Network:
    """Weights, scores and one training step of the network."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = {
            "embed": r.normal(0, 0.3, (_SIZE, _DIM)), "body": r.normal(0, 0.2, (_WIDTH * _DIM, _FILTERS)), "near": r.normal(0, 0.2, (_WIDTH * _DIM, _FILTERS)),
            "bias": np.zeros(2 * _FILTERS), "out": r.normal(0, 0.2, 2 * _FILTERS + 1),
        }
        self.a, self.b, self.threshold = 1.0, 0.0, 0.5
        inside = np.zeros(_BEFORE + _BODY + _AFTER, bool)
        inside[_BEFORE : _BEFORE + _BODY] = True
        n = len(inside) - _WIDTH + 1
        self.inside = inside[_WIDTH // 2 : _WIDTH // 2 + n]

    def forward(self, x: np.ndarray) -> tuple:
        e = self.w["embed"][x]
        n = x.shape[1] - _WIDTH + 1
        win = np.concatenate([e[:, j : j + n] for j in range(_WIDTH)], 2)
        parts, where = [], []
        for name, at in (("body", self.inside), ("near", ~self.inside)):
            z = win[:, at] @ self.w[name]
            top = z.argmax(1)
            where.append(top)
            parts.append(np.take_along_axis(z, top[:, None], 1)[:, 0])
        h = np.maximum(np.concatenate(parts, 1) + self.w["bias"], 0)
        return win, where, h, h @ self.w["out"][:-1] + self.w["out"][-1]

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        win, where, h, z = self.forward(x)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        out = {"out": np.append(h.T @ g, g.sum())}
        dh = g[:, None] * self.w["out"][:-1] * (h > 0)
        out["bias"] = dh.sum(0)
        dwin, rows = np.zeros_like(win), np.arange(len(x))[:, None]
        for i, (name, at) in enumerate((("body", self.inside), ("near", ~self.inside))):
            d = dh[:, i * _FILTERS : (i + 1) * _FILTERS]
            places = np.flatnonzero(at)[where[i]]
            picked = win[rows, places]
            out[name] = np.einsum("bfk,bf->kf", picked, d)
            np.add.at(dwin, (rows, places), d[:, :, None] * self.w[name].T[None])
        out["embed"] = np.zeros_like(self.w["embed"])
        n = dwin.shape[1]
        for j in range(_WIDTH):
            np.add.at(out["embed"], x[:, j : j + n], dwin[:, :, j * _DIM : (j + 1) * _DIM])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12) -> None:
        """Adam over the training part; calibration and threshold on every fourth example."""
        r, held = np.random.default_rng(11), np.arange(len(x)) % 4 == 3
        tx, ty, m, v, t = x[~held], y[~held], {k: np.zeros_like(a) for k, a in self.w.items()}, {k: np.zeros_like(a) for k, a in self.w.items()}, 0
        for _ in range(epochs):
            order = r.permutation(len(tx))
            for at in range(0, len(order), 64):
                t += 1
                part = order[at : at + 64]
                for k, g in self.gradient(tx[part], ty[part]).items():
                    g = g + 1e-4 * self.w[k]
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        z, want = self.forward(x[held])[3], y[held]
        ab = np.array([1.0, 0.0])
        for _ in range(30):  # Platt scaling with a ridge, so separable scores stay finite
            p = 1 / (1 + np.exp(-np.clip(ab[0] * z + ab[1], -30, 30)))
            d = np.column_stack([z, np.ones_like(z)])
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + 0.5 * np.eye(2), d.T @ (p - want) + 0.5 * (ab - [1.0, 0.0]))
            ab = ab - np.clip(step, -1, 1)
        self.a, self.b = float(ab[0]), float(ab[1])
        p = self.calibrated(z)
        good, bad = np.sort(p[want == 1]), p[want == 0]
        # Of the thresholds that keep the recall, the one of the best precision; of those, the lowest.
        allowed = [(float((good >= t).sum() / ((good >= t).sum() + (bad >= t).sum())), -float(t)) for t in good[: int((1 - RECALL) * len(good)) + 1]]
        self.threshold = -max(allowed)[1] if allowed else 0.5

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * z + self.b, -30, 30)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.calibrated(self.forward(x[i : i + 256])[3]) for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)


def generated(n: int, seed: int = 3) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of made-up secrets and look-alikes; no real credential is among them."""
    r = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pick = lambda k, chars=alnum: "".join(r.choice(chars) for _ in range(k))
    words = "the of data server report annual river light number street garden module version update station paper".split()
    b64 = lambda k: base64.b64encode(r.randbytes(k)).decode()
    secret = [
        lambda: "ghp_" + pick(36), lambda: "sk_live_" + pick(24), lambda: "xoxb-" + pick(11, "0123456789") + "-" + pick(24), lambda: b64(r.randint(18, 40)),
        lambda: pick(r.randint(20, 44)), lambda: "eyJ" + pick(20) + "." + pick(30) + "." + pick(27), lambda: "AIza" + pick(35), lambda: pick(32, "0123456789ABCDEF"),
    ]
    plain = [
        lambda: f"{r.choice(words)}{r.randint(1, 99)}.{r.choice(words)}.example.com", lambda: f"www.{r.choice(words)}-{r.choice(words)}{r.randint(1, 9)}.org/{r.choice(words)}",
        lambda: f"{r.choice(words)}_{r.choice(words)}_{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"{r.choice(words)}/{r.choice(words)}/{r.choice(words)}{r.randint(1, 9)}.py",
        lambda: f"v{r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}-{r.choice(words)}.{r.choice(words)}", lambda: f"{r.choice(words)}-{r.choice(words)}-{r.choice(words)}-{r.randint(1, 999)}",
        lambda: "".join(r.choice(words) for _ in range(4)) + str(r.randint(1, 9)), lambda: f"{r.randint(1000, 9999)}-{r.choice(words)}={r.randint(100000, 999999)}",
    ]
    lead = ["key ", "credential: ", "use ", "auth=", "Bearer ", "see ", "at ", "file ", "on ", "", '"', "from "]
    out = []
    for i in range(n):
        value = r.choice(secret if i % 2 else plain)()
        before = " ".join(r.choice(words) for _ in range(r.randint(0, 6))) + " " + r.choice(lead)
        text = before + value + r.choice([" ", '"', ". ", "\n", ", "]) + " ".join(r.choice(words) for _ in range(r.randint(0, 4)))
        out.append((text, len(before), len(before) + len(value), i % 2))
    return out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of the rule findings of a sample."""
    for batch in batches:
        codes = []
        for text in batch["text"].to_pylist():
            for start, _, end in rule_spans(text or ""):
                value = CANDIDATE.search(text, start, end)
                if value:
                    codes += map(bytes, encode(text, *value.span()))
                if len(codes) > 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary())], names=["x"])
                    codes = []
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary())], names=["x"])


def learn(docs: DataFrame, labelled: DataFrame | None = None) -> Network:
    """A network fitted to labelled findings; labelled has text, start, end and label."""
    ship(docs.sparkSession)
    examples = [(bytes(x), y) for t, a, b, y in generated(MAX_EXAMPLES) for x in encode(t, a, b)]
    if labelled is None:
        ids = docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(MAX_DOCUMENTS)
        ids = materialize(ids, "ids")  # MAX_DOCUMENTS rows at most
        rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
        rows = rows.mapInArrow(_found, "x binary").distinct().orderBy(F.xxhash64("x"), "x").limit(MAX_EXAMPLES)
        examples += [(bytes(r["x"]), 1) for r in rows.collect()]
    else:
        rows = labelled.select("text", "start", "end", "label").distinct().orderBy(F.xxhash64("text", "start", "end"), "text", "start", "end", "label")
        for r in rows.limit(MAX_EXAMPLES).toLocalIterator():
            examples += [(bytes(x), r["label"]) for x in encode(r["text"], r["start"], r["end"])]
    order = random.Random(5).sample(range(len(examples)), len(examples))
    network = Network()
    network.fit(np.array([list(examples[i][0]) for i in order]), np.array([examples[i][1] for i in order], float))
    return network


def _pieces(texts: list[str], rules: list[list[tuple[int, int, int]]]) -> Iterator[tuple[list[tuple[int, int, int]], list[list[int]], list[int]]]:
    """Candidates (text, start, end), their windows and the candidate of each window, some thousand windows at once."""
    held, codes, own = [], [], []
    for i, t in enumerate(texts):
        for a, b in candidates(t, rules[i]):
            windows = encode(t, a, b)
            own += [len(held)] * len(windows)
            held.append((i, a, b))
            codes += windows
            if len(codes) >= 4096:
                yield held, codes, own
                held, codes, own = [], [], []
    if held:
        yield held, codes, own


def _scanner(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model.value
        for batch in batches:
            texts = [t.as_py() or "" for t in batch["text"]]
            rules = [rule_spans(t) for t in texts]
            extra: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for held, codes, own in _pieces(texts, rules):
                best = np.zeros(len(held))
                np.maximum.at(best, own, network.score(np.array(codes)))
                for (i, a, b), s in zip(held, best.tolist(), strict=True):
                    if s >= network.threshold:
                        extra[i].append((a, 3, b))
            say = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
            n = [pa.array([sum(k == kind for _, k, _ in r) for r in rules], pa.int64()) for kind in range(3)]
            digest = pa.array([hashlib.sha256(say(r).encode()).hexdigest() for r in rules], pa.string())
            spans = pa.array([say(sorted(r + x)) for r, x in zip(rules, extra, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *n, digest, spans], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(network or learn(docs))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scanner(model), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
