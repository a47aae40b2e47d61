"""Conversations as training text, proved by reading the text back.

The grammar: a conversation is a sequence of turns, and a turn is

    user       ``[INST] text [/INST]``
    system     ``[SYSTEM_PROMPT] text [/SYSTEM_PROMPT]``
    assistant  a blank, the text, ``</s>``
    others     ``[ROLE name] text [/ROLE]``

where a text holds no control string. A control string is one of the marks above, or ``<s>``; with
backslashes after its first character it is escaped, one backslash per time. The reader
decides by the next mark alone, so a text has one reading.

Every turn is written as it is and read again. If role, text or end differ, what conflicts in it is
escaped, until reading gives the turn back; at last the whole text is read and compared with its turns.
Escaping is reversible for any text, also one that holds escaped marks.

Rows go in order of (conversation, turn, role, text) to ranges, so that a long conversation is
dealt over many tasks; one that a task cannot know to be complete, or that is longer than ``part_chars``,
comes as several parts. Null texts and roles are empty; rows without a conversation id are one
conversation; turns with one number go by role, then text, and repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starcart.llm.words import map_batches, stored

PART_CHARS = 1_000_000

# The marks of the template.
_MARKS = {
    "user": ("[INST] ", " [/INST]"),
    "system": ("[SYSTEM_PROMPT] ", " [/SYSTEM_PROMPT]"),
    "assistant": (" ", "</s>"),
}
_OTHER_CLOSE = " [/ROLE]"

#: Control strings, plain or escaped: first character, backslashes, rest.
CONTROL = r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\]|/?SYSTEM_PROMPT\]|ROLE |/ROLE\])"
_CONTROL = re.compile(CONTROL)
_PLAIN = re.compile(r"</?s>|\[(?:/?INST\]|/?SYSTEM_PROMPT\]|ROLE |/ROLE\])")
_ROLE = re.compile(r"\[ROLE ([^\]]*)\] ")
_IN_ROLE = re.compile(r"[%<>\[\]]")

Turn = tuple[str, str]


class Unreadable(ValueError):
    """A text outside the grammar."""


def escape(text: str) -> str:
    """One more backslash in every control string."""
    return _CONTROL.sub(r"\1\4\\\2\5\3\6", text)


def unescape(text: str) -> str:
    """One backslash less in every escaped control string."""
    return _CONTROL.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "")[1:] + (m[3] or m[6]), text)


def _marks(role: str) -> tuple[str, str]:
    if role in _MARKS:
        return _MARKS[role]
    name = _IN_ROLE.sub(lambda m: f"%{ord(m[0]):02X}", role)
    return f"[ROLE {name}] ", _OTHER_CLOSE


def _opened(text: str, at: int) -> tuple[str, int]:
    """Role of the turn that begins at ``at``, and where its content begins."""
    if text.startswith(" ", at):
        return "assistant", at + 1
    for role in ("user", "system"):
        if text.startswith(_MARKS[role][0], at):
            return role, at + len(_MARKS[role][0])
    named = _ROLE.match(text, at)
    if not named:
        raise Unreadable(f"no turn begins at {at}")
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), named[1]), named.end()


def read_spans(text: str) -> Iterator[tuple[str, int, int, int]]:
    """(role, start, end of the content, end of the turn) of each turn of a formatted text."""
    at = 0
    while at < len(text):
        role, start = _opened(text, at)
        close = _marks(role)[1]
        mark = _PLAIN.search(text, start)
        # the blank of a closing mark stands before its control string
        end = mark.start() - (close[0] == " ") if mark else -1
        if end < start or not text.startswith(close, end):
            raise Unreadable(f"the turn that begins at {at} is not closed")
        at = end + len(close)
        yield role, start, end, at


def read(text: str) -> list[Turn]:
    """The turns of a formatted text."""
    return [(role, unescape(text[start:end])) for role, start, end, _ in read_spans(text)]


def written(role: str, text: str) -> str:
    """One turn, escaped as often as reading it back needs."""
    start, close = _marks(role)
    content = text
    while True:
        candidate = start + content + close
        try:
            if read(candidate) == [(role, text)]:
                return candidate
        except Unreadable:
            pass
        if content != text:
            raise Unreadable(f"a turn of role {role!r} is not read back")
        content = escape(content)


class _Conversation:
    """The turns of one conversation that are not given out yet."""

    def __init__(self) -> None:
        self.turns: list[Turn] = []
        self.pieces: list[str] = []
        self.size = 0

    def add(self, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.pieces.append(written(role, text))
        self.size += len(self.pieces[-1])

    def text(self) -> tuple[str, list[dict[str, int]]]:
        """The text and its loss mask: the contents of the assistant's turns."""
        text = "".join(self.pieces)
        spans = list(read_spans(text))
        if [(role, unescape(text[a:b])) for role, a, b, _ in spans] != self.turns:
            raise Unreadable("a conversation is not read back")
        return text, [{"start": a, "end": b} for role, a, b, _ in spans if role == "assistant"]


def formatted(conversations: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, part, whole, text, loss`` from ``conv_id, turn, role, text``; other columns are left out.

    ``whole`` rows hold a conversation each. The others hold whole turns; those of one conversation, in the
    order of ``part``, make its text. ``loss`` are the spans of code points to train on: the assistant's
    texts, without marks.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # the beginning of the text parts rows that agree in all else and keeps their order
    ordered = rows.repartitionByRange(
        "conv_id", "turn", "role", F.substring("text", 1, 64)
    ).sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = StructType(
        [
            StructField("conv_id", conversations.schema["conv_id"].dataType),
            *StructType.fromDDL(
                "part long, whole boolean, text string, loss array<struct<start: int, end: int>>"
            ).fields,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        kind = None
        now, own, begun = _Conversation(), None, False
        alone = False  # no other task, nor an earlier part, has turns of the conversation
        out: list[tuple] = []

        def give(whole: bool) -> None:
            nonlocal part, now
            out.append((own, part, whole, *now.text()))
            part, now = part + 1, _Conversation()

        def batch() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            types = (kind, pa.int64(), pa.bool_(), pa.string(), _SPANS)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            out.clear()
            return pa.record_batch(arrays, ["conv_id", "part", "whole", "text", "loss"])

        for given in batches:
            kind = given.column("conv_id").type
            columns = [given.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for conv_id, role, text in zip(*columns, strict=True):
                if begun and conv_id != own:
                    if now.turns:
                        give(whole=alone)
                    alone = True
                own, begun = conv_id, True
                now.add(role, text)
                if now.size >= part_chars:
                    give(whole=False)
                    alone = False
            if out:
                yield batch()
        if now.turns:
            give(whole=False)
        if out:
            yield batch()

    return map_batches(ordered, run, schema)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class _Digest:
    """What one conversation's text says, taken in part by part."""

    def __init__(self) -> None:
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict[str, int]]) -> None:
        for role, content in read(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{content}\n".encode())
        for span in loss:
            content = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(content)
            self.loss.update(content.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGESTS = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digests(texts: DataFrame) -> DataFrame:
    """A row per conversation, read back from ``formatted`` texts.

    Whole conversations are read where they are. The parts of the others are brought together in order
    and read as a stream; a hash of one conversation is one chain, so this last step is one task per
    conversation, with memory for one part.
    """
    conv_id = texts.schema["conv_id"]
    names = StructType.fromDDL(_DIGESTS).fieldNames()
    middle = StructType([conv_id, *StructType.fromDDL(
        f"part long, whole boolean, text string, loss array<struct<start: int, end: int>>, {_DIGESTS}"
    ).fields])
    numbers = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            rows = []
            for row in given.to_pylist():
                if row["whole"]:
                    digest = _Digest()
                    digest.add(row["text"], row["loss"])
                    rows.append((row["conv_id"], row["part"], True, None, None, *digest.row()))
                else:
                    rows.append((*(row[c] for c in given.schema.names), *[None] * 5))
            types = [given.schema.field("conv_id").type, pa.int64(), pa.bool_(), pa.string(), _SPANS, *numbers]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.record_batch(columns, middle.fieldNames())

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, own, kind = None, None, None

        def row() -> pa.RecordBatch:
            values = zip((own, *digest.row()), (kind, *numbers), strict=True)
            return pa.record_batch([pa.array([v], t) for v, t in values], ["conv_id", *names])

        for given in batches:
            kind = given.schema.field("conv_id").type
            for r in given.to_pylist():
                if digest is not None and r["conv_id"] != own:
                    yield row()
                    digest = None
                own, digest = r["conv_id"], digest or _Digest()
                digest.add(r["text"], r["loss"])
        if digest is not None:
            yield row()

    texts = texts.select("conv_id", "part", "whole", "text", "loss")
    found = stored(map_batches(texts, whole, middle), "chat")
    parts = found.where("not whole").select("conv_id", "part", "text", "loss")
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    rest = map_batches(ordered, streamed, StructType([conv_id, *StructType.fromDDL(_DIGESTS).fields]))
    return found.where("whole").select("conv_id", *names).unionByName(rest)


_TURNS_SQL = """
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
"""

ORACLE_SQL = rf"""
with turns as ({_TURNS_SQL}),
written as (
    select *, case role
            when 'user' then length('[INST]  [/INST]')
            when 'system' then length('[SYSTEM_PROMPT]  [/SYSTEM_PROMPT]')
            when 'assistant' then length(' </s>')
            else length('[ROLE ]  [/ROLE]') + length(regexp_replace(role, '[%<>\[\]]', '%00', 'g'))
        end + length(regexp_replace(text, '{CONTROL}', '\1\4\\\2\5\3\6', 'g')) as chars
    from turns
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), ''))
        as loss_sha256,
    cast(sum(chars) as bigint) as formatted_chars
from written group by conv_id
"""
