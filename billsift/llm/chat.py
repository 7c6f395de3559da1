r"""Chat formatting with a grammar round trip.

A turn is written as ``### role: text</turn>`` and a line feed. A text is first
written as it is. A deterministic parser reads the turn back, and while it does not get
the very same role and text, more of the content is escaped by backslashes: first the
control strings, then every character that means anything to the parser. The last
form is always read back right, so formatted conversations are exact. A turn that
parses alone to itself does so among others too, because the parser never looks past the
end mark of a turn.

One row per turn stays one row, so a conversation of any length is never one value. Its
digests are made from its turns in order, as a stream: a SHA-256 needs all its bytes
in sequence, hence one task per conversation, but not its memory.

Null texts and roles count as empty. Rows are ordered by turn (null first), then role and
text; equal rows are turns each. Rows without a conversation id are one conversation.
Other columns than these four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BEGIN, MIDDLE, END = "### ", ": ", "</turn>"
LEARNED_ROLE = "assistant"
_TOKENS = re.compile(r"\\[\\#<:]|### |</turn>|: ")
_SPECIAL = re.compile(r"[\\#<:]")
_CONTROL = re.compile(r"### |</turn>|: ")
_TURN = "conv_id long, turn long, role string, text string, formatted string, escapes int, loss_from int, loss_to int"
_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, escaped_turns long"
)

#: Each form escapes more than the one before.
_ESCAPES = (
    lambda content: content,
    lambda content: _CONTROL.sub(lambda m: "\\" + m[0], content),
    lambda content: _SPECIAL.sub(lambda m: "\\" + m[0], content),
)


def parse_turn(formatted: str, at: int = 0) -> tuple[str, str, int, int, int] | None:
    """Role, text, where the text begins and ends, and the end of the turn at ``at``.

    None if there is no turn by the grammar.
    """
    if not formatted.startswith(BEGIN, at):
        return None
    at += len(BEGIN)
    parts: list[list[str]] = [[], []]
    field, begin = 0, -1
    for token in _TOKENS.finditer(formatted, at):
        found = token[0]
        if found == MIDDLE and field == 1:
            continue
        parts[field].append(formatted[at : token.start()])
        at = token.end()
        if found[0] == "\\":
            parts[field].append(found[1])
        elif found == MIDDLE:
            field, begin = 1, at
        elif found == END and field == 1 and formatted.startswith("\n", at):
            return "".join(parts[0]), "".join(parts[1]), begin, token.start(), at + 1
        else:
            return None
    return None


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        turn = parse_turn(formatted, at)
        if turn is None:
            return None
        turns.append(turn[:2])
        at = turn[4]
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """The turn, how much of it had to be escaped, and where its text begins and ends."""
    for escapes, escape in enumerate(_ESCAPES):
        formatted = f"{BEGIN}{escape(role)}{MIDDLE}{escape(text)}{END}\n"
        read = parse_turn(formatted)
        if read is not None and read[:2] == (role, text) and read[4] == len(formatted):
            return formatted, escapes, read[2], read[3]
    raise AssertionError("a wholly escaped turn is always read back")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
            role, text = role or "", text or ""
            formatted, escapes, begin, end = format_turn(role, text)
            learned = role == LEARNED_ROLE
            rows.append((role, text, formatted, escapes, begin if learned else None, end if learned else None))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
        arrays = [batch.column("conv_id").cast(pa.int64()), batch.column("turn").cast(pa.int64())]
        arrays += [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        names = ["conv_id", "turn", "role", "text", "formatted", "escapes", "loss_from", "loss_to"]
        yield pa.RecordBatch.from_arrays(arrays, names)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per turn with its part of the formatted conversation.

    Concatenated in order of turns, ``formatted`` is the conversation. Between
    ``loss_from`` and ``loss_to`` (code points) lies what a model learns; null
    elsewhere.
    """
    return conversations.select("conv_id", "turn", "role", "text").mapInArrow(_format, _TURN)


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.escaped = 0

    def add(self, formatted: str, escapes: int, loss_from: int | None, loss_to: int | None) -> None:
        role, text, begin, end, _ = parse_turn(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.chars += len(formatted)
        self.escaped += escapes > 0
        if loss_from is not None:
            if (begin, end) != (loss_from, loss_to):
                raise AssertionError("the loss mask covers the text of a turn")
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self) -> tuple:
        digests = self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest()
        return (self.conv_id, self.n_turns, *digests, self.chars, self.escaped)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
            ("escaped_turns", pa.int64()),
        ]
    )
    now = None
    for batch in batches:
        done = []
        for conv_id, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                done += [now.row()] if now else []
                now = _Digest(conv_id)
            now.add(*turn)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(now.row(), schema, strict=True)], schema=schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its formatted turns alone: counts and digests."""
    order = ["conv_id", "turn", "role", "text"]
    tasks = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = formatted.repartition(tasks, "conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "formatted", "escapes", "loss_from", "loss_to").mapInArrow(_read_back, _DIGEST)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like the template and its escapes."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    added = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(conversations.union(added)))
