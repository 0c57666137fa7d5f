"""Fill-in-the-middle: a text's prefix, suffix and middle, told apart by marks.

Cuts are numbers of units (code points, words, lines). A text is laid out in fixed blocks
of bytes; a Fenwick tree over the blocks holds how many units begin and how many code
points stand in each. A binary-lifting descent finds the block of a cut, and only that
block is searched for the byte where the unit begins; the same descent gives the number
of code points before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.frames import prepare
from shiftloom.llm.words import texts

BLOCK = 4096  # bytes
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KEPT_PLAIN = 90  # h3 % 100 from here on: the text stays as it is
SUFFIX_FIRST = 20  # h4 % 100 below it: the suffix comes first


# -- units --------------------------------------------------------------------------------


def _chars(codes: np.ndarray) -> np.ndarray:
    return (codes & 0xC0) != 0x80


def _after(blank: Callable[[np.ndarray], np.ndarray], between: bool) -> Callable[[np.ndarray], np.ndarray]:
    """Units that begin where ``blank`` ends: behind every blank, or (``between``) behind a run of them."""

    def starts(codes: np.ndarray) -> np.ndarray:
        gap = blank(codes)
        out = np.ones(len(codes), bool)
        out[1:] = gap[:-1] & ~gap[1:] if between else gap[:-1]
        return out

    return starts


# A word keeps the white space behind it, a line its line break; what precedes the first word is a unit.
UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "char": _chars,
    "word": _after(lambda c: (c == 32) | ((c >= 9) & (c <= 13)), between=True),
    "line": _after(lambda c: c == 10, between=False),
}


class Fenwick:
    """Sums of pairs (units, code points) over the blocks before any block."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        sums = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(counts, axis=0)))
        at = np.arange(1, n + 1)
        self.tree = np.concatenate((np.zeros((1, 2), np.int64), sums[at] - sums[at - (at & -at)]))
        self.n, self.total = n, sums[-1]

    def descend(self, units: int) -> tuple[int, int, int]:
        """(block, units before it, code points before it) for the unit of that number, counted from 0."""
        block, before, points = 0, 0, 0
        step = 1 << (self.n.bit_length() - 1) if self.n else 0
        while step:
            further = block + step
            if further <= self.n and before + self.tree[further, 0] <= units:
                block, before, points = further, before + int(self.tree[further, 0]), points + int(self.tree[further, 1])
            step >>= 1
        return block, before, points


class Units:
    """A text's units: how many, and the byte and code point at which any one begins."""

    def __init__(self, data: bytes, kind: str = "char", block: int = BLOCK):
        self.codes, self.starts, self.block = np.frombuffer(data, np.uint8), UNITS[kind], block
        edges = np.arange(0, len(data), block)
        if len(edges):
            begins = self.starts(self.codes)
            counts = np.stack([np.add.reduceat(begins, edges, dtype=np.int64),
                               np.add.reduceat(_chars(self.codes), edges, dtype=np.int64)], axis=1)
        else:
            counts = np.zeros((0, 2), np.int64)
        self.tree = Fenwick(counts)
        self.n, self.chars = (int(x) for x in self.tree.total)

    def begin(self, unit: int) -> tuple[int, int]:
        """(byte, code point) at which unit ``unit`` begins; the end of the text for ``n``."""
        if unit >= self.n:
            return len(self.codes), self.chars
        block, before, points = self.tree.descend(unit)
        low = block * self.block
        back = min(low, 1)  # whether a unit begins depends on the byte before
        inside = self.codes[low - back:low + self.block]
        at = int(np.flatnonzero(self.starts(inside)[back:])[unit - before])
        return low + at, points + int(_chars(inside[back:back + at]).sum())


# -- forms --------------------------------------------------------------------------------


def transformed(data: bytes, draws: tuple[int, int, int, int], kind: str = "char") -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    units = Units(data, kind)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not data or draws[2] % 100 >= KEPT_PLAIN or any(m in data for m in marks):
        return units.n, "plain", None, None, data
    (a, first), (b, last) = (units.begin(c) for c in sorted((draws[0] % (units.n + 1), draws[1] % (units.n + 1))))
    prefix, middle, suffix = marks[0] + data[:a], data[a:b], marks[1] + data[b:]
    form = "spm" if draws[3] % 100 < SUFFIX_FIRST else "psm"
    return units.n, form, first, last - first, (suffix + prefix if form == "spm" else prefix + suffix) + marks[2] + middle


def restored(output: bytes, form: str) -> bytes:
    """The text an output was made of. Its parts hold no mark, so the first of each mark is the mark."""
    if form == "plain":
        return output
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    head, middle = output.split(m, 1)
    if form == "psm":
        prefix, suffix = head[len(p):].split(s, 1)
    else:
        suffix, prefix = head[len(s):].split(p, 1)
    return prefix + middle + suffix


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers that follow from the id alone; no id counts as an empty one."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * i:8 * i + 8], 16) for i in range(4))


# -- Spark --------------------------------------------------------------------------------

RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.BinaryType()),
])


def fill_in_middle(docs: DataFrame, kind: str = "char") -> DataFrame:
    """Per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars, output (UTF-8).

    A null text is empty. Empty texts, texts that hold a mark and a share of the others
    stay plain, with null lengths. Rows without doc_id draw alike; repeated rows give
    equal results; other columns are not read. A very long text is held once, with one
    byte of marks per byte while its blocks are counted. An empty table gives no rows.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            made = [(i, *transformed(t, draws(i), kind)) for i, t in zip(ids, texts(batch))]
            if made:
                types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=RESULT.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def rebuilt(made: DataFrame) -> DataFrame:
    """``made`` (output, form and any other columns) with ``restored``, the original text in UTF-8."""
    schema = T.StructType([*made.schema.fields, T.StructField("restored", T.BinaryType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = [restored(o, f) for o, f in zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], names=names)

    return made.mapInArrow(run, schema)


def report(docs: DataFrame, kind: str = "char") -> DataFrame:
    """:func:`fill_in_middle` with digests in place of the output, the second over the text rebuilt from it."""
    made = rebuilt(fill_in_middle(docs, kind))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))
