"""Chat formatting: a state machine over roles, a declarative template, loss flags.

Turns of a conversation are read in order as a stream. Every turn becomes segments of
text, each with a flag that says whether the loss counts on it; a state machine over the
roles finds the first turn that is out of order. A conversation leaves as one or more
pieces of whole turns, so a conversation of any length passes with bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.frames import prepare

PIECE = 1 << 20  # characters after which a conversation goes on in another piece


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, which roles are learned, and which may follow each other."""

    start: str = "<|im_start|>"
    middle: str = "\n"
    end: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    # state -> roles that may come next; a state is the last role, "" before the first
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        head = self.start + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + self.middle
        return [(head, False), (escape(text), role in self.learned), (self.end, False)]

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of every turn of a formatted text."""
        at = 0
        while at < len(formatted):
            if not formatted.startswith(self.start, at):
                raise ValueError(f"no turn begins at {at}")
            head = formatted.index(self.middle, at)
            tail = formatted.index(self.end, head)
            role = unescape(formatted[at + len(self.start):head])
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
            yield role, unescape(formatted[head + len(self.middle):tail])
            at = tail + len(self.end)


def escape(text: str) -> str:
    """No control string is left: between ``<`` and ``|`` stands one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


SEGMENTS = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("loss", T.BooleanType())]))
SEGMENTS_ARROW = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def formatted(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Pieces in order: conv_id, piece, segments, last, valid, error_turn.

    Turns are ordered by turn (null first), then by role and text, so ties and repeated
    rows have one order. A null text is empty, a null role is the role "". On the last
    piece ``valid`` says whether the roles came in order and ended in a final one;
    ``error_turn`` is the index of the first turn that did not fit (the number of turns
    if only the end is missing). Invalid conversations are formatted like others. Rows
    without conv_id are one conversation. Rows of a conversation lie in one partition,
    in order.
    """
    template = template or Template()
    prepare(conversations.sparkSession)
    ordered = (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = run  # no conversation yet
        piece, held, size, state, index, error = 0, [], 0, "", 0, None
        rows: list[tuple] = []

        def close(last: bool) -> None:
            bad = error if error is not None or state in template.final else index
            rows.append((conv, piece, held, last, bad is None if last else None, bad if last else None))

        for batch in batches:
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if conv is run or c != conv:
                    if conv is not run:
                        close(True)
                    conv, piece, held, size, state, index, error = c, 0, [], 0, "", 0, None
                elif size >= PIECE:
                    close(False)
                    piece, held, size = piece + 1, [], 0
                if error is None and role not in template.order.get(state, ()):
                    error = index
                held.extend(template.segments(role, text))
                size, state, index = size + len(text), role, index + 1
            if rows:
                yield packed(rows)
                rows.clear()
        if conv is not run:
            close(True)
            yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        conv, piece, segments, last, valid, error = zip(*rows)
        return pa.RecordBatch.from_arrays([
            pa.array(conv, pa.int64()), pa.array(piece, pa.int64()),
            pa.array([[{"text": t, "loss": x} for t, x in s] for s in segments], SEGMENTS_ARROW),
            pa.array(last, pa.bool_()), pa.array(valid, pa.bool_()), pa.array(error, pa.int64()),
        ], names=["conv_id", "piece", "segments", "last", "valid", "error_turn"])

    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("piece", T.LongType()), T.StructField("segments", SEGMENTS),
        T.StructField("last", T.BooleanType()), T.StructField("valid", T.BooleanType()), T.StructField("error_turn", T.LongType()),
    ])
    return ordered.mapInArrow(run, schema)


def read_back(pieces: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what the formatted text says, one row per conversation.

    ``pieces`` comes straight from :func:`formatted`: pieces of a conversation in order
    in one partition. Turns are parsed out of the text, the learned text out of the mask.
    """
    template = template or Template()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [T.LongType(), T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType(), T.BooleanType()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for batch in batches:
            rows = []
            for conv, segments, last, valid in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segments", "last", "valid"))):
                text = "".join(s["text"] for s in segments)
                chars += len(text)
                for role, content in template.turns(text):
                    turns.update(f"{role}\n{content}\n".encode())
                    n += 1
                for s in segments:
                    if s["loss"]:
                        learned = unescape(s["text"])
                        loss_chars += len(learned)
                        loss.update(learned.encode())
                if last:
                    rows.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid))
                    turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[t.simpleString().replace("bigint", "long")])
                    for c, t in zip(zip(*rows), types)], names=names)

    return pieces.mapInArrow(run, T.StructType([T.StructField(c, t) for c, t in zip(names, types)]))
