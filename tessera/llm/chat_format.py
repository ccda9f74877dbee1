"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, only its text is trainable. A turn is rendered as ``<s>role``, a
line feed, the text and ``</s>``. Control strings inside roles and texts get
a backslash behind their first character, strings that already look so get
one more, so the text can be restored exactly.

``segments`` holds the rendered turns once, and ``examples`` refers to them:
how many turns an example's text has, how long it is, and which of its code
points are trainable. ``output`` writes the examples with their whole texts,
prefix by prefix, behind one shuffle of the turns by conversation; long texts
take several rows. ``expand`` does so by a join, without an order of rows.

Turns are numbered and summed by ranges of ``span`` turn numbers; what stood
before a range is carried in by one row a range, so a conversation that holds
much of the table is spread over tasks.

Defined cases: null texts and roles render as empty, and so do empty ones;
texts of any length are rendered whole; turns of one number (a null number
comes first) are ordered by role, then text, and stay in one range; repeated
rows are turns of their own; a null ``conv_id`` is a conversation like any
other; an empty table gives no rows; other columns of the table, whatever
their names, are not read. A conversation that does not end in an assistant
turn has one more example without trainable text, which holds all of it, so
nothing is lost.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType

OPEN, CLOSE = "<s>", "</s>"
_CONTROL = r"(/?s>|/?INST\]|</?SYS>>|\|\w+\|>)"
_PLAIN = r"([<\[])(\\*)" + _CONTROL
_MARKED = r"([<\[])\\(\\*)" + _CONTROL
SPAN = 4096
PIECE_CHARS = 1 << 20


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: str) -> str:
    return re.sub(_MARKED, r"\1\2\3", text, flags=re.ASCII)


def escape_role(role: Column) -> Column:
    """A role stays on one line."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def _ranges(turns: DataFrame, turn: str, span: int) -> Column:
    """Range of a turn number, in the order of the numbers; numbers that are not whole stay in one range."""
    if not isinstance(turns.schema[turn].dataType, IntegralType):
        return F.lit(0).cast("long")
    return F.coalesce(F.floor(F.col(turn) / span), F.lit(-(1 << 62)))


def segments(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             target: str = "assistant", span: int = SPAN) -> DataFrame:
    """Rendered turns: ``conv_id, seq, segment, context_chars, loss_start, loss_end, trainable, last``.

    ``loss_start`` and ``loss_end`` are code points within the segment; they
    are equal where nothing is trainable. Texts are shuffled once, by
    conversation and range of turns.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.coalesce(F.col(role), F.lit(""))), F.lit("\n"))
    body = escape(F.coalesce(F.col(text), F.lit("")))
    rows = turns.select(
        F.col(conv).alias("conv_id"), _ranges(turns, turn, span).alias("range"), F.lit(1).alias("is_turn"),
        F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), F.concat(head, body, F.lit(CLOSE)).alias("segment"),
        F.length(head).alias("loss_start"), (F.length(head) + F.length(body)).alias("body_end"))
    rows = rows.withColumns({"n": F.lit(1).cast("long"), "chars": F.length("segment").cast("long")})
    by_range = W.partitionBy("conv_id").orderBy("range")
    before = by_range.rowsBetween(W.unboundedPreceding, -1)
    carried = (rows.groupBy("conv_id", "range").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
               .select("conv_id", "range", F.lit(0).alias("is_turn"), F.sum("n").over(before).alias("n"),
                       F.sum("chars").over(before).alias("chars"), F.lead("range").over(by_range).isNotNull().alias("more"))
               .where(F.col("n").isNotNull() | F.col("more"))
               .withColumns({"n": F.coalesce("n", F.lit(0)), "chars": F.coalesce("chars", F.lit(0))}))
    order = W.partitionBy("conv_id", "range").orderBy("is_turn", "t", "r", "segment")
    running = order.rowsBetween(W.unboundedPreceding, 0)
    numbered = (rows.unionByName(carried, allowMissingColumns=True)
                .withColumn("seq", F.sum("n").over(running))
                .withColumn("upto", F.sum("chars").over(running))
                .withColumn("more", F.coalesce(F.first("more").over(running), F.lit(False)))
                .withColumn("last", F.lead("is_turn").over(order).isNull() & ~F.col("more"))
                .where("is_turn = 1"))
    trainable = F.col("r") == target
    return numbered.select(
        "conv_id", "seq", "segment", (F.col("upto") - F.col("chars")).alias("context_chars"), "loss_start",
        F.when(trainable, F.col("body_end")).otherwise(F.col("loss_start")).alias("loss_end"),
        trainable.alias("trainable"), "last")


def examples(rendered: DataFrame) -> DataFrame:
    """One row for each example, by reference to the rendered turns.

    ``conv_id, seq, context_chars, text_chars, loss_start, loss_end``: its text
    is that of the first ``seq`` turns, the last of them the target; the
    offsets are code points of the whole text.
    """
    return rendered.where(F.col("trainable") | F.col("last")).select("conv_id", "seq", *_reference())


def _reference() -> list[Column]:
    before = F.col("context_chars")
    return [before, (before + F.length("segment")).alias("text_chars"), (before + F.col("loss_start")).alias("loss_start"),
            (before + F.col("loss_end")).alias("loss_end")]


def _texts(kind: pa.DataType, piece_chars: int):
    """Rows (conv_id, seq, segment, is_example, reference), conversations together and in order, to whole examples."""
    names = ["conv_id", "seq", "piece", "text", "context_chars", "text_chars", "loss_start", "loss_end"]
    types = [kind, pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        key, started, prefix, rows, size = None, False, [], [], 0
        for batch in batches:
            for conv, seq, segment, is_example, *reference in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if not started or key != conv:
                    key, started, prefix = conv, True, []
                prefix.append(segment)
                if not is_example:
                    continue
                text = "".join(prefix)
                prefix = [text]
                for i, at in enumerate(range(0, len(text), piece_chars)):
                    rows.append((conv, seq, i, text[at:at + piece_chars], *reference))
                    size += len(rows[-1][3])
                    if size >= piece_chars or len(rows) >= 1000:
                        yield out(rows)
                        rows, size = [], 0
        if rows:
            yield out(rows)

    return run


def output(rendered: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The examples, each with its whole text: ``conv_id, seq, piece, text, context_chars, text_chars, loss_start, loss_end``.

    A text of more than ``piece_chars`` code points takes several rows,
    ``piece`` 0, 1, ...; the rows of a conversation follow one another in a
    partition, in order. The turns are shuffled once, by conversation, and
    the prefixes are repeated behind that shuffle, so what is written to disk
    grows with the turns.
    """
    key = rendered.schema["conv_id"].dataType
    ordered = (rendered.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
               .select("conv_id", "seq", "segment", F.col("trainable") | F.col("last"), *_reference()))
    return ordered.mapInArrow(_texts(to_arrow_type(key), piece_chars), f"conv_id {key.simpleString()}, seq long, piece long, text string, "
                              "context_chars long, text_chars long, loss_start long, loss_end long")


def expand(rendered: DataFrame) -> DataFrame:
    """Examples in full: ``conv_id, seq, text, loss_start, loss_end`` (offsets in the whole text).

    Repeats each prefix for every later example, so the output grows with the
    square of a conversation's turns; training on prefixes is of that size.
    """
    ex = examples(rendered).select(F.col("conv_id").alias("c"), F.col("seq").alias("upto"), "loss_start", "loss_end")
    parts = rendered.select("conv_id", "seq", "segment")
    joined = ex.join(parts, ex.c.eqNullSafe(parts.conv_id) & (parts.seq <= ex.upto))
    return (joined.groupBy(F.col("c").alias("conv_id"), F.col("upto").alias("seq"), "loss_start", "loss_end")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("seq").alias("k"), "segment"))).alias("parts"))
            .select("conv_id", "seq", F.concat_ws("", F.col("parts.segment")).alias("text"), "loss_start", "loss_end"))


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    if not (segment.startswith(OPEN) and segment.endswith(CLOSE)):
        raise ValueError("not a rendered turn")
    role, _, text = segment[len(OPEN):-len(CLOSE)].partition("\n")
    return unescape_role(role), unescape(text)


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of the turns of an example (or of its end); ``OPEN`` and ``CLOSE`` stand nowhere else."""
    if not (text.startswith(OPEN) and text.endswith(CLOSE)):
        raise ValueError("not a text of rendered turns")
    for segment in text[len(OPEN):-len(CLOSE)].split(CLOSE + OPEN):
        yield read_segment(f"{OPEN}{segment}{CLOSE}")


class _Digest:
    """Reads a conversation's examples in order, each from its whole text.

    An example has to begin with the text of the one before it; the turns
    behind that, and the text under the loss mask, are read from it.
    """

    def __init__(self, key):
        self.key, self.n, self.loss_chars, self.chars = key, 0, 0, 0
        self.before = ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def example(self, seq: int, text: str, context: int, size: int, a: int, b: int) -> None:
        fits = size == len(text) and 0 <= context <= a <= b <= size and len(self.before) <= context and text.startswith(self.before)
        if fits:
            for role, turn in read_turns(text[len(self.before):]):
                self.n += 1
                self.turns.update(f"{role}\n{turn}\n".encode())
        if not fits or seq != self.n:
            raise ValueError(f"example {seq} of conversation {self.key} does not fit its turns")
        self.chars += len(text)
        loss = unescape(text[a:b])
        self.loss_chars += len(loss)
        self.loss.update(loss.encode())
        self.before = text

    def row(self):
        return self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(formatted: DataFrame) -> DataFrame:
    """What ``output`` says, read back: one row for each conversation.

    Roles, texts, trainable texts and ``formatted_chars``, the length of all
    examples, are read from the whole texts of the examples. One that does
    not continue the one before it, or whose offsets do not fit, is an error.
    Rows are read as ``output`` leaves them, as a stream; a task holds two
    texts of a conversation. (A digest of a whole conversation is sequential,
    so one conversation is read by one task.)
    """
    key = formatted.schema["conv_id"].dataType
    ordered = formatted.select("conv_id", "seq", "piece", "text", "context_chars", "text_chars", "loss_start", "loss_end")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def out(done):
            columns = list(zip(*done))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        current, done, whole = None, [], None

        def close():
            if whole is not None:
                seq, pieces, reference = whole
                current.example(seq, "".join(pieces), *reference)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, seq, piece, text, *reference in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if piece:
                    whole[1].append(text)
                    continue
                close()
                if current is None or current.key != conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv)
                whole = seq, [text], reference
            if len(done) >= 1000:
                yield out(done)
                done = []
        close()
        if current is not None:
            yield out([*done, current.row()])

    return ordered.mapInArrow(read, f"conv_id {key.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")
