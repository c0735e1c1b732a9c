r"""Chat formatting in budgeted windows with a reversible template and a loss mask.

A turn is written as ``### role:``, a line break, its text and ``</turn>`` with a
line break. In texts, ``\``, ``###`` and ``</turn>`` get a backslash in front (in
roles ``:`` too), so control strings of the template never come from a text and
every text can be read back.

The turns of a conversation are cut into windows of a token budget at turn ends:
prefix sums of the turns' tokens decide where. Every window starts with the
conversation's system turn, then repeats up to `history` turns before its first
new one as far as the budget allows; repeated turns are context only. The loss
mask covers the text of assistant turns that are new in their window, so each is
a target exactly once.

Rows are partitioned by conversation and sorted by turn within partitions by
Spark, which spills; Python then streams over them and holds one window. A
conversation of any length needs no more memory than a window and a turn.

Defined cases: a null text or role is empty. Equal turn numbers are ordered by
role, then text; repeated rows are turns of their own; null turn numbers come
first. Null conversation ids are one conversation. A turn above the budget is a
window of its own, with the system turn and without history, marked over_budget.
A table without rows gives no windows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspan.shipping import ship

BUDGET, HISTORY = 1024, 2
TARGET, SYSTEM = "assistant", "system"
_MARKS = re.compile(r"\\|###|</turn>")
_ROLE_MARKS = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*):\n((?:[^\\<]++|\\(?:\\|###|</turn>)|<(?!/turn>))*+)</turn>\n")

WINDOWS = "conv_id long, window int, text string, repeated int, tokens long, over_budget boolean, loss_start array<int>, loss_end array<int>"


def escape(text: str) -> str:
    return _MARKS.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def turn_text(role: str, text: str) -> tuple[str, int]:
    """A formatted turn, and where its text starts in it."""
    head = "### " + _ROLE_MARKS.sub(lambda m: "\\" + m[0], role) + ":\n"
    return head + escape(text) + "</turn>\n", len(head)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def counter(tokenizer: str | None):
    """A function from texts to their numbers of tokens; without a tokenizer file, words and signs are counted."""
    if tokenizer is None:
        piece = re.compile(r"\w+|[^\w\s]")
        return lambda texts: [len(piece.findall(t)) for t in texts]
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


class _Conversation:
    """Windows of one conversation, turn by turn."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.n = conv_id, budget, 0
        self.system: list[tuple[str, int]] = []
        self.past: deque[tuple[str, int]] = deque(maxlen=max(history, 0))
        self.new: list[tuple[str, int, int, bool]] = []
        self.context: list[tuple[str, int]] = []
        self.used, self.turns = 0, 0

    def add(self, role: str, turn: str, head: int, tokens: int) -> Iterator[tuple]:
        first = self.turns == 0
        self.turns += 1
        if self.new and self.used + tokens > self.budget:
            yield self.close()
        if not self.new:
            room = self.budget - tokens - sum(n for _, n in self.system)
            kept: list[tuple[str, int]] = []
            for text, n in reversed(self.past):
                if n > room:
                    break
                room -= n
                kept.insert(0, (text, n))
            self.context = self.system + kept
            self.used = sum(n for _, n in self.context)
        self.new.append((turn, head, tokens, role == TARGET))
        self.used += tokens
        if first and role == SYSTEM:
            self.system = [(turn, tokens)]
        else:
            self.past.append((turn, tokens))

    def close(self) -> tuple:
        at = sum(len(t) for t, _ in self.context)
        starts, ends = [], []
        for turn, head, _, target in self.new:
            if target:
                starts.append(at + head)
                ends.append(at + len(turn) - len("</turn>\n"))
            at += len(turn)
        row = (self.conv_id, self.n, "".join(t for t, _ in self.context) + "".join(t for t, *_ in self.new), len(self.context), self.used, self.used > self.budget, starts, ends)
        self.n, self.new = self.n + 1, []
        return row


def _formatter(budget: int, history: int, tokenizer: str | None):
    types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = [c.strip().split(" ")[0] for c in WINDOWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, now, rows = counter(tokenizer), None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                roles = [r or "" for r in part["role"].to_pylist()]
                turns = [turn_text(r, t or "") for r, t in zip(roles, part["text"].to_pylist(), strict=True)]
                for conv, role, (turn, head), n in zip(part["conv_id"].to_pylist(), roles, turns, count([t for t, _ in turns]), strict=True):
                    if now is None or conv != now.conv_id:
                        if now is not None:
                            rows.append(now.close())
                        now = _Conversation(conv, budget, history)
                    rows += now.add(role, turn, head, n)
                if rows:
                    yield batch_of(rows)
                    rows = []
        if now is not None:
            yield batch_of([now.close()])

    return run


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, *, tokenizer: str | None) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text); repeated counts a window's leading turns that are context.

    tokenizer is the path of a tokenizer file that every executor has; None counts words and signs.
    """
    ship(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_formatter(budget, history, tokenizer), WINDOWS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "windows", "tokens"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    now, done = None, []

    def row() -> tuple:
        return now["id"], now["turns"], now["all"].hexdigest(), now["loss_chars"], now["loss"].hexdigest(), now["chars"], now["windows"], now["tokens"]

    for batch in batches:
        for w in batch.to_pylist():
            if now is None or w["conv_id"] != now["id"]:
                if now is not None:
                    done.append(row())
                now = {"id": w["conv_id"], "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "windows": 0, "tokens": 0}
            for role, text in parse(w["text"])[w["repeated"] :]:
                now["turns"] += 1
                now["all"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for a, b in zip(w["loss_start"], w["loss_end"], strict=True):
                text = unescape(w["text"][a:b])
                now["loss_chars"] += len(text)
                now["loss"].update(text.encode("utf-8", "surrogatepass"))
            now["chars"] += len(w["text"])
            now["windows"] += 1
            now["tokens"] += w["tokens"]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=names)
            done = []
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(), types, strict=True)], names=names)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, digests of the turns and of the text under the loss mask, parsed from the windows.

    windows comes as format_conversations returns it: a conversation in one
    partition and in order.
    """
    return windows.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, windows long, tokens long")


#: A conversation whose texts hold the template's own control strings.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def with_probe(turns: DataFrame) -> DataFrame:
    probe = turns.sparkSession.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, TARGET, PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
