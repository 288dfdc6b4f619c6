r"""Chat formatting in budgeted windows.

Turns are put into windows of at most ``budget`` tokens: prefix sums of turn
tokens choose spans that begin and end at turns.  Every window begins with
the conversation's system turn, then repeats up to ``history`` tokens of the
turns before it; each assistant turn is a training target in one window only
and masked where it is repeated as history.  A turn longer than the budget
gets a window of its own, whole.

Template (fixed values): system ``<<SYS>>text<</SYS>>``, user
``[INST]text[/INST]``, assistant ``<s>text</s>``, any other role
``[ROLE]role[/ROLE]text[/TURN]``.  Inside texts the first character of a
control string is written as ``\l`` (for ``<``) or ``\b`` (for ``[``), and a
backslash as ``\\``: no control string occurs in an escaped text, and the
escape is reversible.

Conversations are streamed: each partition holds its conversations sorted by
turn, and a task keeps one window and its history in memory, never a whole
conversation.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chorus.llm.common import prepare

BUDGET, HISTORY = 1024, 256

# Fixed values of the template.
OPEN_CLOSE = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"),
              "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[/TURN]")
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>",
            "[ROLE]", "[/ROLE]", "[/TURN]")
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_PLAIN = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_UNESCAPE = re.compile(r"\\([\\lb])")
_BACK = {"\\": "\\", "l": "<", "b": "["}

WINDOW = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("window", T.LongType()),
    T.StructField("first_turn", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("n_repeated", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("formatted", T.StringType()),
    T.StructField("loss_spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: _PLAIN[m.group()], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _BACK[m.group(1)], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text begins and ends in it."""
    if role in OPEN_CLOSE:
        head, tail = OPEN_CLOSE[role]
    else:
        head, tail = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    body = escape(text)
    return head + body + tail, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    roles = {o: (r, c) for r, (o, c) in OPEN_CLOSE.items()}
    turns, at = [], 0
    while at < len(formatted):
        head = _CONTROL.match(formatted, at)
        if head is None:
            raise ValueError(f"no turn at {at}")
        if head.group() == OTHER[0]:
            mid = _CONTROL.search(formatted, head.end())
            end = _CONTROL.search(formatted, mid.end())
            turns.append((unescape(formatted[head.end():mid.start()]),
                          unescape(formatted[mid.end():end.start()])))
        else:
            role, close = roles[head.group()]
            end = _CONTROL.search(formatted, head.end())
            if end is None or end.group() != close:
                raise ValueError(f"turn at {at} is not closed")
            turns.append((role, unescape(formatted[head.end():end.start()])))
        at = end.end()
    return turns


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn for the budget: words and single symbols, plus two
    for its marks."""
    return (F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]")) + 2).cast("long")


class _Windows:
    """Cuts one conversation into windows, turn by turn."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple | None = None
        self.past: deque = deque()         # (turn number, tokens, role, text), newest last
        self.past_tokens = 0
        self.fresh: list = []
        self.prefix = 0                    # tokens of all turns so far
        self.begun = 0                     # prefix at the first fresh turn
        self.turn, self.number = 0, 0

    def add(self, role: str, text: str, tokens: int):
        """Takes the next turn; returns the window it completes, if any."""
        done = None
        fixed = self.system[1] if self.system and self.number else 0
        room = self.budget - fixed - self.past_tokens
        if self.fresh and self.prefix + tokens - self.begun > room:
            done = self.close()
        if not self.fresh:
            # The oldest history goes until the turn fits.
            fixed = self.system[1] if self.system and self.number else 0
            while self.past and fixed + self.past_tokens + tokens > self.budget:
                self.past_tokens -= self.past.popleft()[1]
        self.fresh.append((self.turn, tokens, role, text))
        if role == "system" and self.turn == 0:
            self.system = self.fresh[0]
        self.prefix += tokens
        self.turn += 1
        return done

    def close(self):
        """The window of the fresh turns; they become history."""
        if not self.fresh:
            return None
        repeated = list(self.past)
        if self.system is not None and self.number:
            repeated.insert(0, self.system)
        parts, spans, at = [], [], 0
        for i, (_, _, role, text) in enumerate(repeated + self.fresh):
            turn, a, b = render(role, text)
            if role == "assistant" and i >= len(repeated):
                spans.append({"start": at + a, "end": at + b})
            parts.append(turn)
            at += len(turn)
        out = {"conv_id": self.conv_id, "window": self.number,
               "first_turn": self.fresh[0][0],
               "n_turns": len(repeated) + len(self.fresh), "n_repeated": len(repeated),
               "n_tokens": sum(t[1] for t in repeated + self.fresh),
               "formatted": "".join(parts), "loss_spans": spans}
        # The newest turns, whole, within the history budget; the system turn
        # is repeated anyway.
        for t in self.fresh:
            if t is not self.system:
                self.past.append(t)
                self.past_tokens += t[1]
        while self.past_tokens > self.history:
            self.past_tokens -= self.past.popleft()[1]
        self.fresh, self.begun = [], self.prefix
        self.number += 1
        return out


def _format(budget: int, history: int):
    schema = pa.schema([
        ("conv_id", pa.int64()), ("window", pa.int64()), ("first_turn", pa.int64()),
        ("n_turns", pa.int64()), ("n_repeated", pa.int64()), ("n_tokens", pa.int64()),
        ("formatted", pa.string()),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out, chars = None, [], 0
        for batch in batches:
            for conv_id, role, text, tokens in zip(*(batch[c].to_pylist() for c in
                                                     ("conv_id", "role", "text", "tokens"))):
                done = []
                if state is None or state.conv_id != conv_id:
                    if state is not None:
                        done.append(state.close())
                    state = _Windows(conv_id, budget, history)
                done.append(state.add(role, text, tokens))
                for w in filter(None, done):
                    out.append(w)
                    chars += len(w["formatted"])
                if chars > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, chars = [], 0
        if state is not None:
            out.append(state.close())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                   conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv_id, window, first_turn, n_turns, n_repeated,
    n_tokens, formatted and loss_spans (code-point ranges of ``formatted``).

    A window has at most ``budget`` tokens: history goes, oldest first, until
    the next turn fits.  Only a turn that does not fit beside the system turn
    (or the budget itself) makes a larger window, of these two alone.

    Turns are ordered by ``turn``, null first, ties by role and text; repeated
    rows are turns of their own.  A null text or role counts as empty; null
    conversation ids form one conversation.  A conversation is one task's work
    in a stream of its turns: memory holds a window, however long the
    conversation, and a very long turn whole.  Other columns are not read,
    whatever their names.  An empty table gives an empty table.
    """
    prepare(turns.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (turns.select(F.col(conv_col).cast("long").alias("conv_id"),
                         F.col(turn_col).alias("turn"),
                         F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                         text.alias("text"), turn_tokens(text).alias("tokens"))
            .repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format(budget, history), WINDOW))


class _Reader:
    """Digests of one conversation, from its windows in order."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.loss = sha256(), sha256()
        self.n_turns = self.loss_chars = self.chars = self.windows = 0

    def add(self, formatted: str, n_repeated: int, spans: list) -> None:
        self.chars += len(formatted)
        self.windows += 1
        for role, text in parse(formatted)[n_repeated:]:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in spans:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.n_turns,
                "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
                "n_windows": self.windows}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("n_windows", pa.int64())])
    state, out = None, []
    for batch in batches:
        for conv_id, formatted, n_repeated, spans in zip(*(batch[c].to_pylist() for c in (
                "conv_id", "formatted", "n_repeated", "loss_spans"))):
            if state is None or state.conv_id != conv_id:
                if state is not None:
                    out.append(state.row())
                state = _Reader(conv_id)
            state.add(formatted, n_repeated, spans)
        if len(out) > 4096:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if state is not None:
        out.append(state.row())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, read from the formatted windows alone: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and
    n_windows.  Digests run over the windows in order, one at a time."""
    prepare(windows.sparkSession)
    return (windows.select("conv_id", "window", "formatted", "n_repeated", "loss_spans")
            .repartition("conv_id").sortWithinPartitions("conv_id", "window")
            .mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, "
                               "loss_chars long, loss_sha256 string, formatted_chars long, "
                               "n_windows long"))
