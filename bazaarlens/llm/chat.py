"""Chat formatting (10): one string per conversation, its loss mask, and budgeted windows over its turns.

Format: `<|im_start|>role\\ntext<|im_end|>\\n` per turn. Inside roles and texts `<|` is written `<\\|`, and a backslash
before such a bar gets one more, so no control string can come from data and the format is read back exactly.

Windows: turn tokens are summed along the conversation; a window starts at a turn, repeats at most `history` tokens of
whole earlier turns, always carries the leading system turn, and ends before the budget is exceeded. The loss mask covers
the text of assistant turns; a repeated assistant turn is masked out, so every target is trained on once. A single turn
larger than the budget is the only new turn of its window, whole, after the system turn.

Turns are shuffled once by conversation, sorted, and read as a stream; what is held is one window and the turns it may
repeat, whatever the length of the conversation.

Defined cases: NULL texts count as empty, NULL roles as empty names, NULL turns come first, ties in `turn` go by role and
text; repeated rows stay repeated turns; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of a window at most, and of the repeated turns in it.
BUDGET, HISTORY = 2048, 256
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)
PIECE = re.compile(r"\w+|[^\w\s]")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on one line: backslashes and line ends are spelled out as well."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def count_pieces(text: str) -> int:
    """Words and punctuation marks, the default measure of a turn."""
    return len(PIECE.findall(text))


def turns_of(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the written text) of every turn in a formatted string."""
    for m in TURN.finditer(text):
        yield unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)


@dataclass
class Packer:
    """Cuts one conversation, fed turn by turn, into windows. Holds one window and the repeated turns, never more."""

    budget: int
    history: int
    conv: object = None
    window: int = 0
    seen: int = 0
    total: int = 0  # prefix sum of tokens over the turns so far
    since: int = 0  # prefix sum at the start of the open window
    system: tuple | None = None
    head: list = field(default_factory=list)
    new: list = field(default_factory=list)
    recent: list = field(default_factory=list)

    def head_tokens(self) -> int:
        return sum(t[2] for t in self.head)

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take a turn; returns the finished window if the turn opens the next one."""
        done = None
        if self.new and self.head_tokens() + self.total + tokens - self.since > self.budget:
            done = self.close()
            fixed = [self.system] if self.system else []
            room = min(self.history, self.budget - tokens - sum(t[2] for t in fixed))
            back: list = []
            for turn in reversed(self.recent):
                room -= turn[2]
                if room < 0:
                    break
                back.insert(0, turn)
            self.head, self.since = [*fixed, *back], self.total
        turn = (role, text, tokens)
        if not self.seen and role == "system":
            self.system = turn
        else:
            self.recent.append(turn)
            spare = sum(t[2] for t in self.recent) - self.history
            while self.recent and spare > 0:  # the oldest turns that no window can repeat any more
                spare -= self.recent.pop(0)[2]
        self.new.append(turn)
        self.seen += 1
        self.total += tokens
        return done

    def close(self) -> dict:
        parts, spans, at = [], [], 0
        for i, (role, text, _) in enumerate([*self.head, *self.new]):
            opening = f"{START}{escape_role(role)}\n"
            body = escape(text)
            if role == "assistant" and i >= len(self.head):
                spans.append({"start": at + len(opening), "end": at + len(opening) + len(body)})
            parts.append(f"{opening}{body}{END}\n")
            at += len(parts[-1])
        row = {
            "conv_id": self.conv, "window": self.window, "first_turn": self.seen - len(self.new), "n_repeated": len(self.head),
            "n_turns": len(self.head) + len(self.new), "text": "".join(parts), "loss": spans,
        }
        self.window, self.new = self.window + 1, []
        return row


def batches_of(rows: Iterator[dict], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row.get("text", ""))
        if size > limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = count_pieces
) -> DataFrame:
    """One row per window: conv_id, window, first_turn (number of its first new turn), n_repeated (leading turns repeated
    from before), n_turns, text, loss (code-point spans of `text`).

    Turns are sorted by conversation and read as a stream, so a conversation of any length passes through one task in
    bounded memory.
    """
    kind = conversations.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType(
        [
            T.StructField("conv_id", kind), T.StructField("window", T.LongType()), T.StructField("first_turn", T.LongType()),
            T.StructField("n_repeated", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("text", T.StringType()),
            T.StructField("loss", span),
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        packer: Packer | None = None
        for b in batches:
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if packer is None or packer.conv != conv:
                    if packer is not None:
                        yield packer.close()
                    packer = Packer(budget, history, conv)
                done = packer.add(role, text, count(text))
                if done:
                    yield done
        if packer is not None:
            yield packer.close()

    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select("conv_id", "turn", role, text).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "text").mapInArrow(lambda it: batches_of(packed(it), arrow), out)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, taken from the formatted windows alone: conv_id, n_turns, turns_sha256 (role, line
    end, text, line end per turn), loss_chars and loss_sha256 (all text under the mask), formatted_chars."""
    kind = formatted.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    names = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()), ("n_windows", T.LongType())]
    out = T.StructType([T.StructField("conv_id", kind), *(T.StructField(n, t) for n, t in names)])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        row: dict | None = None
        for b in batches:
            for conv, repeated, text, loss in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if row is None or row["conv_id"] != conv:
                    if row is not None:
                        yield finished(row, all_turns, all_loss)
                    row = {"conv_id": conv} | {n: 0 for n, _ in names}
                    all_turns, all_loss = hashlib.sha256(), hashlib.sha256()
                for i, (role, said, _, _) in enumerate(turns_of(text)):
                    if i >= repeated:
                        row["n_turns"] += 1
                        all_turns.update(f"{role}\n{said}\n".encode())
                for s in loss:
                    said = unescape(text[s["start"] : s["end"]])
                    row["loss_chars"] += len(said)
                    all_loss.update(said.encode())
                row["formatted_chars"] += len(text)
                row["n_windows"] += 1
        if row is not None:
            yield finished(row, all_turns, all_loss)

    def finished(row: dict, all_turns, all_loss) -> dict:
        return row | {"turns_sha256": all_turns.hexdigest(), "loss_sha256": all_loss.hexdigest()}

    ordered = formatted.select("conv_id", "n_repeated", "text", "loss", "window").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.drop("window").mapInArrow(lambda it: batches_of(digests(it), arrow), out)
