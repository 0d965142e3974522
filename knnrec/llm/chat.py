"""Chat formatting in budgeted windows.

The turns of a conversation, in order, are cut into turn-aligned windows of at
most ``budget`` tokens by the prefix sums of their token counts. Every window
opens with the conversation's system turn, repeats up to ``history`` tokens of
the turns just before it, and then holds its new turns. The loss mask covers
the texts of new assistant turns only, so a repeated target is masked out and
every assistant text is a target once.

Template: ``### Role: text </turn>\\n`` per turn. Inside roles and texts the
control strings are made harmless by a backslash before ``\\``, ``#`` and ``<``,
undone by dropping the backslash; the colon after a role is escaped alike.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import prepare
from knnrec.llm.packing import encoder, has_long_space, json_encoder

OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*) </turn>\n", re.S)


def escape(text: str) -> str:
    return re.sub(r"([\\#<:])", r"\\\1", text) if re.search(r"[\\#<:]", text) else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends."""
    head = OPEN + escape(role) + MIDDLE
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


class Formatter:
    """Turns of one conversation in, finished windows out. Holds the system
    turn, the repeatable history and the window being filled, never more."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system = None
        self.before: deque = deque()  # (formatted, tokens) of the last turns
        self.before_tokens = 0
        self.window, self.turns, self.first = 0, 0, 0
        self._open()

    def _open(self) -> None:
        self.parts: list[str] = []
        self.size = self.tokens = 0
        self.repeated = 0
        self.spans: list[int] = []
        self.fresh = 0
        for formatted, tokens in ([self.system] if self.system else []) + list(self.before):
            self.parts.append(formatted)
            self.size += len(formatted)
            self.tokens += tokens
            self.repeated += 1

    def _close(self) -> dict:
        row = {
            "conv_id": self.conv_id, "window": self.window, "first_turn": self.turns - self.fresh, "n_new": self.fresh,
            "n_repeated": self.repeated, "tokens": self.tokens, "text": "".join(self.parts), "loss_spans": self.spans,
        }
        self.window += 1
        return row

    def add(self, role: str, text: str, tokens: int) -> list[dict]:
        formatted, start, end = turn_text(role, text)
        done = []
        if self.fresh and self.tokens + tokens > self.budget:
            done.append(self._close())
            self._open()
        # history gives way before a new turn goes over the budget
        first_repeat = 1 if self.system else 0
        while not self.fresh and self.repeated > first_repeat and self.tokens + tokens > self.budget:
            dropped, n = self.parts.pop(first_repeat), self.before_tokens_at(first_repeat)
            self.size -= len(dropped)
            self.tokens -= n
            self.repeated -= 1
        if role == "assistant":
            self.spans += [self.size + start, self.size + end]
        self.parts.append(formatted)
        self.size += len(formatted)
        self.tokens += tokens
        self.fresh += 1
        self.turns += 1
        if role == "system" and self.system is None:
            self.system = (formatted, tokens)
        else:
            self.before.append((formatted, tokens))
            self.before_tokens += tokens
            while self.before and self.before_tokens > self.history:
                self.before_tokens -= self.before.popleft()[1]
        return done

    def before_tokens_at(self, first_repeat: int) -> int:
        """Tokens of the oldest repeated turn still in the window."""
        kept = self.repeated - first_repeat
        return self.before[len(self.before) - kept][1]

    def finish(self) -> list[dict]:
        return [self._close()] if self.fresh else []


WINDOWS = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int32()), ("first_turn", pa.int64()), ("n_new", pa.int32()),
    ("n_repeated", pa.int32()), ("tokens", pa.int64()), ("text", pa.string()), ("loss_spans", pa.list_(pa.int64())),
])


def counted(turns: DataFrame, vocabulary: str) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with the tokens of the formatted
    turn, counted in the scan: no conversation's texts are one task's work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary

        def tokens(text: str) -> int:
            if has_long_space(text):
                return len(json_encoder(vocabulary).encode(text, add_special_tokens=False).ids)
            return len(encode(text))

        for batch in batches:
            pairs = zip(batch.column(2), batch.column(3), strict=True)
            n = pa.array([tokens(turn_text(r.as_py(), t.as_py())[0]) for r, t in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], names=[*batch.schema.names, "tokens"])

    return turns.mapInArrow(run, "conv_id long, turn long, role string, text string, tokens long")


def windows(
    conversations: DataFrame, budget: int = 1024, history: int = 256, vocabulary: str = "byte_bpe_50k.tiktoken"
) -> DataFrame:
    """One row per window: conv_id, window, first_turn (index of its first new
    turn), n_new, n_repeated (system and history turns before them), tokens,
    text, loss_spans (start and end of each masked-in text, code points).

    Turns are ordered by turn, then role and text; null turns come first, null
    roles and texts count as ''. A null conv_id is one conversation. A turn
    over the budget has a window to itself (with the system turn): texts are
    never cut. Repeated rows are turns of their own; an empty table gives no
    rows; other columns are ignored. Tokens are counted before the turns are
    sorted; tasks then stream over sorted turns and hold one window at a time,
    so a conversation may have any number of turns.
    """
    prepare(conversations.sparkSession)
    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = counted(turns, vocabulary).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            out: list[dict] = []
            for conv_id, _, role, text, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or current.conv_id != conv_id:
                    out += current.finish() if current else []
                    current = Formatter(conv_id, budget, history)
                out += current.add(role, text, tokens)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=WINDOWS)
        if current:
            yield pa.RecordBatch.from_pylist(current.finish(), schema=WINDOWS)

    return ordered.mapInArrow(
        run,
        "conv_id long, window int, first_turn long, n_new int, n_repeated int, tokens long, text string, "
        "loss_spans array<long>",
    )


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window, unescaped."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its windows alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    ordered = (
        formatted.select("conv_id", "window", "n_repeated", "text", "loss_spans")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        open_, state = False, None

        def row():
            return dict(zip(names, (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]), strict=True))

        for batch in batches:
            out = []
            for conv_id, _, repeated, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not open_ or state[0] != conv_id:
                    if open_:
                        out.append(row())
                    open_, state = True, [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, turn in parse(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{turn}\n".encode("utf-8", "surrogatepass"))
                for start, end in zip(spans[::2], spans[1::2], strict=True):
                    target = unescape(text[start:end])
                    state[3] += len(target)
                    state[4].update(target.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if open_:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    return ordered.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
