"""Chat formatting from an event log: fold the events of a message, render, read back.

A log row is (conversation, message keys, sequence, kind, role, text). Kinds:

    start       the message begins, with a role and perhaps text
    delta       streamed text, added at the end
    edit        the text so far is replaced
    regenerate  the text so far is void, deltas follow
    delete      the message goes; a later start brings it back

The log is cut into ranges of (conversation, message keys) and sorted by sequence, so one
task folds whole messages, in order, as a stream, and a conversation of any length is
cut between messages. Consecutive messages of one conversation become segments of
formatted text of bounded length (a longer message is a segment of its own), written in
order with their loss mask: the code-point spans of the assistant texts.

Every turn is framed by control strings. In texts and role names, a control string gets
a backslash after its first character, one that already has some gets one more; reading
removes one. So no text can open or close a turn, and every text comes back as it was.

Defined results: a null text counts as empty, a null role as the empty role. Events of
equal keys, sequence, kind, role and text are deliveries of one event. Equal sequences
go by kind, role, text. Null keys sort first; rows of a null conversation form one.
Unknown kinds are ignored. A message without an event that starts or fills it does not
exist. Empty logs give no rows. Columns not named are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstate.llm.common import batch, batches, tuples

ASSISTANT = "assistant"
#: role: what stands before and after a text.
FRAMES = {
    "user": ("[INST] ", " [/INST]\n"),
    ASSISTANT: ("<s> ", " </s>\n"),
    "system": ("<<SYS>> ", " <</SYS>>\n"),
}
#: Any other role is written out.
OTHER, ROLE_END, OTHER_END = "[TURN] ", " [ROLE] ", " [/TURN]\n"
TAILS = r"(?=/?s>|<SYS>>|</SYS>>|/?INST\]|/?TURN\]|ROLE\])"
PLAIN = re.compile(r"([<\[])(\\*)" + TAILS)
ESCAPED = re.compile(r"([<\[])\\(\\*)" + TAILS)
OPENING = {frame[0]: (role, frame[1]) for role, frame in FRAMES.items()}
SEGMENT = 1 << 16


def escape(text: str) -> str:
    return PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as formatted, and where its escaped text begins and ends."""
    if role in FRAMES:
        before, after = FRAMES[role]
    else:
        before, after = OTHER + escape(role) + ROLE_END, OTHER_END
    body = escape(text)
    return before + body + after, len(before), len(before) + len(body)


def turns_of(formatted: str) -> Iterator[tuple[str, int, int]]:
    """Role of every turn of formatted text, and where its escaped text begins and ends."""
    at = 0
    while at < len(formatted):
        opening = formatted[at : formatted.index(" ", at) + 1]
        at += len(opening)
        if opening == OTHER:
            end = formatted.index(ROLE_END, at)
            role, after, at = unescape(formatted[at:end]), OTHER_END, end + len(ROLE_END)
        else:
            role, after = OPENING[opening]
        end = formatted.index(after, at)
        yield role, at, end
        at = end + len(after)


class Message:
    """A message while its events come in, in order."""

    def __init__(self) -> None:
        self.role: str | None = None
        self.parts: list[str] | None = None
        self.last: tuple | None = None

    def add(self, seq: object, kind: str | None, role: str | None, text: str | None) -> None:
        event = (seq, kind, role, text)
        if event == self.last:
            return
        self.last = event
        if kind == "start":
            self.role, self.parts = role, [text or ""]
        elif kind == "delta":
            self.parts = self.parts or []
            self.parts.append(text or "")
        elif kind == "edit":
            self.parts = [text or ""]
        elif kind == "regenerate":
            self.parts = []
        elif kind == "delete":
            self.parts = None

    def final(self) -> tuple[str, str] | None:
        """Role and text, or nothing where no event left a message."""
        return None if self.parts is None else (self.role or "", "".join(self.parts))


def messages(rows: Iterator[tuple], keys: int) -> Iterator[tuple]:
    """(conversation, role, text) of rows sorted by conversation, message keys and sequence."""
    for key, events in itertools.groupby(rows, key=lambda row: row[:keys]):
        message = Message()
        for event in events:
            message.add(*event[keys:])
        final = message.final()
        if final is not None:
            yield key[0], *final


SPANS = "array<struct<start: int, end: int>>"
SEGMENTS = f"conv_id long, segment long, whole boolean, n_turns long, formatted string, loss {SPANS}"
ARROW_SEGMENTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("segment", pa.int64()),
        ("whole", pa.bool_()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def segments(turns: Iterator[tuple], task: int, length: int) -> Iterator[tuple]:
    """Segment rows of the (conversation, role, text) turns of one task.

    `whole`: the segment is all of its conversation. The first and the last
    conversation of a task may go on in other tasks, so theirs are not.
    """
    number, first = task << 33, True
    conv, parts, loss, size, cut, held = None, [], [], 0, False, None
    begun = False

    def row(whole: bool) -> tuple:
        return conv, number, whole, len(parts), "".join(parts), loss

    for its_conv, role, text in turns:
        other = begun and its_conv != conv
        if other or size >= length:
            yield row(other and not first and not cut)
            number += 1
            first, cut = first and not other, not other
            parts, loss, size = [], [], 0
        conv, begun = its_conv, True
        turn, start, end = render(role, text)
        if role == ASSISTANT:
            loss.append({"start": size + start, "end": size + end})
        parts.append(turn)
        size += len(turn)
    if begun:
        yield row(False)


def format_conversations(
    log: DataFrame,
    folder: str,
    conv_col: str = "conv_id",
    message_cols: tuple[str, ...] = ("message",),
    seq_col: str = "seq",
    kind_col: str = "kind",
    role_col: str = "role",
    text_col: str = "text",
    segment_chars: int = SEGMENT,
) -> None:
    """Write the formatted conversations of an event log to `folder`, with their loss masks.

    `message_cols` name a message within its conversation and give its place there.
    """
    keys = [f"k{i}" for i in range(len(message_cols))]
    rows = log.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        *[F.col(c).alias(k) for c, k in zip(message_cols, keys, strict=True)],
        F.col(seq_col).alias("seq"),
        F.col(kind_col).alias("kind"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    place = ["conv_id", *keys]
    ordered = rows.repartitionByRange(*place).sortWithinPartitions(*place, "seq", "kind", "role", "text")

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = messages(tuples(incoming), len(place))
        out = segments(turns, TaskContext.get().partitionId(), segment_chars)
        yield from bounded(out, ARROW_SEGMENTS)

    ordered.mapInArrow(run, SEGMENTS).write.option("compression", "zstd").parquet(folder)


def bounded(rows: Iterator[tuple], schema: pa.Schema, chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of segment rows that hold about `chars` of formatted text."""
    chunk, size = [], 0
    for row in rows:
        chunk.append(row)
        size += len(row[4]) + 64
        if size >= chars:
            yield batch(chunk, schema)
            chunk, size = [], 0
    if chunk:
        yield batch(chunk, schema)


def formatted(spark: SparkSession, folder: str) -> DataFrame:
    """The written segments; those of a conversation follow each other by `segment`."""
    return spark.read.schema(SEGMENTS).parquet(folder)


TURNS = "conv_id long, segment long, place int, role string, text string, in_loss boolean"


def read_turns(written: DataFrame) -> DataFrame:
    """conv_id, segment, place in it, role, text, in_loss: every turn of written segments, unescaped."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("segment", pa.int64()), ("place", pa.int32()), ("role", pa.string())]
        + [("text", pa.string()), ("in_loss", pa.bool_())]
    )

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, segment, text, loss in tuples(incoming):
            masked = {(s["start"], s["end"]) for s in loss}
            found = enumerate(turns_of(text))
            yield from batches(
                ((conv, segment, i, r, unescape(text[a:z]), (a, z) in masked) for i, (r, a, z) in found), schema, 256
            )

    return written.select("conv_id", "segment", "formatted", "loss").mapInArrow(run, TURNS)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
ARROW_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class Digest:
    """Running digests of one conversation, segment by segment."""

    def __init__(self, conv: int | None) -> None:
        self.conv = conv
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict]) -> None:
        for role, start, end in turns_of(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{unescape(text[start:end])}\n".encode())
        for span in loss:
            said = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(written: DataFrame) -> DataFrame:
    """One row of digests per conversation of written segments.

    A whole conversation is digested where it is read. Only conversations in several
    segments are shuffled; a digest goes through their text in order, so one task streams
    a conversation's segments, whatever its length, one at a time in memory.
    """

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now: Digest | None = None
            for conv, text, loss in tuples(incoming):
                if now is None or now.conv != conv:
                    if now is not None:
                        yield now.row()
                    now = Digest(conv)
                now.add(text, loss)
            if now is not None:
                yield now.row()

        yield from batches(rows(), ARROW_DIGESTS)

    columns = ["conv_id", "formatted", "loss"]
    whole = written.where("whole").select(columns)
    cut = written.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return whole.mapInArrow(run, DIGESTS).unionByName(cut.select(columns).mapInArrow(run, DIGESTS))


#: Code points of a streamed piece, and the most pieces of a message.
PIECE, PIECES = 256, 16


def replayed(conversations: DataFrame) -> DataFrame:
    """The event log that leads to the rows of a table (conv_id, turn, role, text).

    Each row is a message: it starts, and its text streams in as deltas. An assistant
    message whose id hash is 0 modulo 4 first streams half of a draft, which a
    regenerate event voids; another role's message whose hash is 0 modulo 4 is first
    sent without its last characters and then edited. Rows repeated for one turn stay
    messages of their own, ordered by role and a hash of the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    length = F.length(text)
    step = F.greatest(F.lit(PIECE), F.ceil(length / PIECES).cast("int"))

    def event(kind: str, said=None):
        said = F.lit(None).cast("string") if said is None else said
        return F.struct(F.lit(kind).alias("kind"), said.alias("said"))

    def streamed(whole, chars):
        pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((chars - 1) / step).cast("int")))
        return F.transform(pieces, lambda i: event("delta", F.substring(whole, i * step + 1, step)))

    start = F.array(event("start"))
    half = F.floor(length / 2).cast("int")
    draft = F.concat(start, streamed(text, half), F.array(event("regenerate")), streamed(text, length))
    edited = F.concat(
        start, F.array(event("delta", F.substring(text, F.lit(1), half)), event("edit", text))
    )
    plain = F.concat(start, streamed(text, length))
    chosen = F.pmod(F.xxhash64("conv_id", "turn", F.length(text)), F.lit(4)) == 0
    assistant = F.coalesce(F.col("role") == ASSISTANT, F.lit(False))
    events = F.when(chosen & assistant, draft).when(chosen, edited).otherwise(plain)
    # The row's number is taken before its events are: one number for all of them.
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.xxhash64(text).alias("copy"),
        F.monotonically_increasing_id().alias("row"),
        events.alias("events"),
    )
    log = rows.select("conv_id", "turn", "role", "copy", "row", F.posexplode("events").alias("seq", "event"))
    return log.select("conv_id", "turn", "role", "copy", "row", "seq", "event.kind", F.col("event.said").alias("text"))
