r"""Chat formatting from an event log.

The log holds one row per event of a conversation: (conv_id, turn, tie, seq,
kind, role, text).  ``message`` opens a message, ``delta`` appends streamed
text to it, ``edit`` replaces its text, and ``regenerate`` empties it and drops
every later turn begun before it.  Logs are partitioned by conversation and
sorted by (turn, tie, seq); one pass folds events into final messages and
renders them as training text with a loss mask.

Sorting by turn makes the fold a stream: an event is dead when a
``regenerate`` of an earlier turn has a larger ``seq``, and of these the pass
keeps one number.  Conversations of more than 256 turn numbers are cut into
blocks, so none of them is one task; a block begins with the number that
the blocks before it would have handed on.

Template: ``<s>[INST] text [/INST]`` for a user, ``<s>text</s>`` for an
assistant (the text is under the loss mask), ``<s><<SYS>> text <</SYS>>`` for
a system turn, and ``<s>[ROLE] role [/ROLE] text`` for any other role.  Inside
roles and texts a backslash is doubled, and one is put after the first
character of every control string; reading back takes a backslash away.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popdist.llm.common import staged

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
#: a block holds 2 ** 8 turn numbers of one conversation
BLOCK_BITS = 8
#: a part of a formatted conversation ends after the turn that reaches this length
PART_CHARS = 1 << 20
DELTA_CHARS = 1024

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(
    r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>> (?P<system>.*?) <</SYS>>"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?)(?=<s>|\Z)|(?P<assistant>.*?)</s>)", re.S)

LOG = "conv_id long, turn long, tie string, seq long, kind string, role string, text string"
_PARTS = "conv_id long, block long, part int, split boolean, formatted string, loss array<struct<start:long,end:long>>"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, tuple[int, int] | None]:
    """One turn's formatted text, and the span of it under the loss mask."""
    body = escape(text)
    if role == "assistant":
        return f"<s>{body}</s>", (3, 3 + len(body))
    if role == "user":
        return f"<s>[INST] {body} [/INST]", None
    if role == "system":
        return f"<s><<SYS>> {body} <</SYS>>", None
    return f"<s>[ROLE] {escape(role)} [/ROLE] {body}", None


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn; start and end bound the escaped text."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text outside of turns")
        at, kind = m.end(), m.lastgroup
        role = unescape(m["role"]) if kind == "other" else kind
        out.append((role, unescape(m[kind]), *m.span(kind)))
    if at != len(formatted):
        raise ValueError("text outside of turns")
    return out


# -- the log -----------------------------------------------------------------

def log_of(conversations: DataFrame) -> DataFrame:
    """The event log of a table of finished turns: each row opens a message
    and streams its text in deltas.  Rows of one turn number are messages of
    their own, by role and text digest; rows without conv_id are in no log."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.concat(role, F.lit("\0"), F.sha2(text, 256), F.lit("\0"),
                 F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")).alias("tie"),
        role.alias("role"), text.alias("text"))
    at = F.sequence(F.lit(0), F.ceil(F.length("text") / DELTA_CHARS).cast("long"))
    return rows.withColumn("seq", F.explode(at)).select(
        "conv_id", "turn", "tie", "seq",
        F.when(F.col("seq") == 0, F.lit("message")).otherwise(F.lit("delta")).alias("kind"),
        F.when(F.col("seq") == 0, F.col("role")).alias("role"),
        F.when(F.col("seq") > 0, F.expr(f"substring(text, int((seq - 1) * {DELTA_CHARS} + 1), {DELTA_CHARS})")).alias("text"))


def _block(turn: Column) -> Column:
    return F.coalesce(F.shiftright(turn, BLOCK_BITS), F.lit(-2 ** 62))


def _heads(log: DataFrame) -> DataFrame:
    """One row for each block of a conversation with several: the largest seq
    of a regeneration in the blocks before it."""
    blocks = log.groupBy("conv_id", "block").agg(
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("cut"))
    w = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    several = blocks.groupBy("conv_id").agg(F.count("*").alias("_n")).where("_n > 1").select("conv_id")
    heads = blocks.join(several, "conv_id").withColumn("seq", F.max("cut").over(w))
    return heads.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("tie"),
                        "seq", F.lit("head").alias("kind"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("text"), "block")


# -- fold and render -----------------------------------------------------------

class _Fold:
    """Folds sorted events, renders messages, emits parts."""

    def __init__(self):
        self.key = self.message = None
        self.out: list[tuple] = []

    def _message_done(self) -> None:
        if self.message is not None and self.live:
            text, loss = render(self.role, "".join(self.texts))
            if loss is not None:
                self.loss.append({"start": self.size + loss[0], "end": self.size + loss[1]})
            self.turns.append(text)
            self.size += len(text)
            if self.size >= PART_CHARS:
                self._part_done()
        self.message = None

    def _part_done(self) -> None:
        if self.turns:
            self.out.append((*self.key, self.part, self.split, "".join(self.turns), self.loss))
            self.part += 1
        self.turns, self.loss, self.size = [], [], 0

    def close(self) -> None:
        if self.key is not None:
            self._message_done()
            self._part_done()
        self.key = None

    def add(self, conv, block, turn, tie, seq, kind, role, text) -> None:
        if (conv, block) != self.key:
            self.close()
            self.key, self.part, self.split = (conv, block), 0, kind == "head"
            self.turns, self.loss, self.size = [], [], 0
            self.cut = self.next_cut = None  # largest seq of a regeneration before this turn / up to it
            self.turn = self  # no turn yet
        if kind == "head":
            self.cut = self.next_cut = seq
            return
        if (turn, tie) != self.message:
            self._message_done()
            if turn != self.turn:
                self.cut = self.next_cut
            self.message, self.turn, self.role, self.texts, self.live = (turn, tie), turn, "", [], False
        if self.cut is not None and seq < self.cut:
            return  # an earlier turn was regenerated after this event
        if kind == "message":
            self.live, self.role, self.texts = True, role or "", [text or ""]
        elif kind == "delta":
            self.texts.append(text or "")
        elif kind == "edit":
            self.texts = [text or ""]
        elif kind == "regenerate":
            self.texts = [text or ""]
            self.next_cut = seq if self.next_cut is None else max(self.next_cut, seq)
        else:
            raise ValueError(f"no such event: {kind}")


_PARTS_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("block", pa.int64()), ("part", pa.int32()), ("split", pa.bool_()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS_ARROW)], schema=_PARTS_ARROW)


def _fold(batches: Iterator[pa.RecordBatch]):
    fold = _Fold()
    names = ("conv_id", "block", "turn", "tie", "seq", "kind", "role", "text")
    for b in batches:
        for event in zip(*(b.column(c).to_pylist() for c in names)):
            fold.add(*event)
        if fold.out:
            yield _parts(fold.out)
            fold.out = []
    fold.close()
    if fold.out:
        yield _parts(fold.out)


def format_log(log: DataFrame) -> DataFrame:
    """(conv_id, block, part, split, formatted, loss): the training text of
    every conversation of ``log``, in parts of whole turns; ``loss`` spans count
    code points of the part; ``split`` tells that there are several blocks.

    Null turns come first.  A message exists from its ``message`` event on; events
    of a turn that no ``message`` opened, or whose ``message`` was dropped, are
    dropped.  Null texts count as empty, other columns are not read.
    """
    log = log.where("conv_id is not null").select(*(f.split()[0] for f in LOG.split(", "))).withColumn("block", _block(F.col("turn")))
    events = log.unionByName(_heads(log))
    first = F.when(F.col("kind") == "head", 0).otherwise(1)
    return events.withColumn("_f", first).repartition("conv_id", "block").sortWithinPartitions(
        "conv_id", "block", "_f", "turn", "tie", "seq").drop("_f").mapInArrow(_fold, _PARTS)


# -- reading back ----------------------------------------------------------------

class _Reader:
    """Digests of one conversation, fed its parts in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, formatted: str, loss: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"]:span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self, conv_id: int) -> tuple:
        return (conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_READ = DIGEST + ", block long, part int, formatted string, loss array<struct<start:long,end:long>>"


def _read(batches: Iterator[pa.RecordBatch], hold: bool):
    """Digests of the conversations in a sorted stream of parts.  With
    ``hold``, parts of split conversations are handed on as they are."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        *((f.name, f.type) for f in (_PARTS_ARROW.field(c) for c in ("block", "part", "formatted", "loss")))])
    at, reader, rows = None, None, []
    for b in batches:
        for conv, block, part, split, formatted, loss in zip(*(b.column(c).to_pylist() for c in _PARTS_ARROW.names)):
            if hold and split:
                rows.append((conv, *(None,) * 5, block, part, formatted, loss))
                continue
            if conv != at:
                if reader is not None:
                    rows.append((*reader.row(at), None, None, None, None))
                at, reader = conv, _Reader()
            reader.add(formatted, loss)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if reader is not None:
        rows.append((*reader.row(at), None, None, None, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_back(parts: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted ``parts`` alone: turns,
    digest of roles and texts, code points and digest of the text under the
    loss mask, formatted code points.

    ``parts`` as ``format_log`` returns them: whole conversations are read where
    they lie; the parts of split ones meet in order, one part in memory at a time.
    """
    told = staged(parts.mapInArrow(lambda it: _read(it, True), _READ), "chat-read")
    names = [f.split()[0] for f in DIGEST.split(", ")]
    split = told.where("formatted is not null").select("conv_id", "block", "part", F.lit(False).alias("split"), "formatted", "loss")
    joined = split.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").mapInArrow(
        lambda it: _read(it, False), _READ)
    return told.where("formatted is null").select(*names).unionByName(joined.select(*names))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """``conversations`` as a log, formatted and read back."""
    return read_back(format_log(log_of(conversations)))
