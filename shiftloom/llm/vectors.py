"""Vector codes by product quantisation, fitted by a dual-tree Lloyd iteration in integers.

Vectors are cut into parts, each with a codebook of its own. In every round each task
takes its vectors in blocks and builds a box tree over a block's parts; a second tree
stands over the entries of the codebook. Both are descended together: an entry node
leaves the list of a block node when its least distance is above the greatest distance
to another entry node. A block node with one entry left is assigned whole, by its cached
sum; leaves with several entries left are decided by exact integer distances. What
leaves a task is one sum and count per entry, so a round shuffles
``parts * entries * width`` numbers a task, whatever the rows, and the driver receives
one codebook.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.frames import prepare, written
from shiftloom.operators.joins import spread_join

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK = 1 << 19  # components of the vectors worked on at a time
LEAF = 64  # parts in a leaf of a block's tree
EXACT = float(1 << 53)  # whole numbers below it are exact as doubles
LONG = (1 << 63) - 1
LIMB = 32  # bits of one number of a long sum
FEEDERS = 64  # tasks that narrow the least ids before one takes the rest


# -- trees ------------------------------------------------------------------------------


class Tree:
    """Boxes over rows, halved along the widest side down to ``leaf`` rows.

    ``order`` puts the rows of a node side by side; ``bounds[l]`` are the borders of the
    nodes on level l and ``children[l][i]`` is the first child of node i on the next level.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        self.order = np.arange(n)
        self.bounds: list[np.ndarray] = [np.array([0, n])]
        self.children: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        while True:
            bounds, rows = self.bounds[-1], points[self.order]
            self.low.append(np.minimum.reduceat(rows, bounds[:-1], axis=0))
            self.high.append(np.maximum.reduceat(rows, bounds[:-1], axis=0))
            sizes = np.diff(bounds)
            if sizes.max() <= leaf:
                return
            node = np.repeat(np.arange(len(sizes)), sizes)
            widest = np.argmax(self.high[-1] - self.low[-1], axis=1)
            self.order = self.order[np.lexsort((rows[np.arange(n), widest[node]], node))]
            cut = sizes > leaf
            self.children.append(np.concatenate(([0], np.cumsum(cut + 1)[:-1])))
            self.bounds.append(np.sort(np.concatenate((bounds, (bounds[:-1] + sizes // 2)[cut]))))

    def below(self, level: int) -> np.ndarray:
        """How many children the nodes of a level have."""
        return np.diff(np.append(self.children[level], len(self.bounds[level + 1]) - 1))


def _opened(tree: Tree, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``nodes``, child) of all children; the nodes themselves on the last level."""
    if level >= len(tree.children):
        return np.arange(len(nodes)), nodes
    many = tree.below(level)[nodes]
    place = np.repeat(np.arange(len(nodes)), many)
    inside = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
    return place, tree.children[level][nodes][place] + inside


def candidates(parts: Tree, entries: Tree) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end, entries) over all rows of ``parts.order``.

    The entries, in order of index, are the ones that may be nearest to some row; where
    one is left it is the nearest of all rows, strictly.
    """
    a, b, la, lb = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while True:
        low, high, elow, ehigh = parts.low[la][a], parts.high[la][a], entries.low[lb][b], entries.high[lb][b]
        with np.errstate(over="ignore"):
            least = (np.maximum(0, np.maximum(elow - high, low - ehigh)) ** 2).sum(axis=1)
            most = (np.maximum(ehigh - low, high - elow) ** 2).sum(axis=1)
            first = np.flatnonzero(np.diff(a, prepend=-1))
            reach = np.repeat(np.minimum.reduceat(most, first), np.diff(np.append(first, len(a))))
            keep = least <= reach * (1 + 1e-9)  # doubles round: an entry is only dropped with room to spare
        a, b = a[keep], b[keep]
        done_entries, done_parts = lb == len(entries.children), la == len(parts.children)
        if done_entries:
            first = np.flatnonzero(np.diff(a, prepend=-1))
            ends = np.append(first[1:], len(a))
            over = np.ones(len(a), bool)
            for i, j in zip(first, ends):
                if done_parts or j - i == 1:
                    node = a[i]
                    yield int(parts.bounds[la][node]), int(parts.bounds[la][node + 1]), np.sort(entries.order[b[i:j]])
                    over[i:j] = False
            a, b = a[over], b[over]
            if not len(a):
                return
        place, a = _opened(parts, la, a)
        b = b[place]
        place, b = _opened(entries, lb, b)
        a = a[place]
        rank = np.argsort(a, kind="stable")
        a, b = a[rank], b[rank]
        la, lb = min(la + 1, len(parts.children)), min(lb + 1, len(entries.children))


# -- a block of vectors -----------------------------------------------------------------


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers, exact at any size."""
    return np.array([[int(v) * scale if abs(v) >= EXACT else math.floor(v * scale) for v in row] for row in x.tolist()],
                    object).reshape(x.shape)


@dataclass(frozen=True)
class Book:
    """The entries of one part position: Python integers, and the same as doubles for the bounds."""

    entries: np.ndarray

    @property
    def doubles(self) -> np.ndarray:
        return np.array([[float(v) if abs(v) < 1 << 1000 else math.inf for v in row] for row in self.entries.tolist()],
                        float).reshape(self.entries.shape)


class Block:
    """One part position of a block of vectors, with its tree and cached sums."""

    def __init__(self, x: np.ndarray, scale: int):
        self.x, self.scale = x, scale
        with np.errstate(over="ignore"):
            self.points = np.floor(x * scale)
        self.finite = bool(np.isfinite(self.points).all())
        self.tree = Tree(self.points, LEAF) if self.finite else None
        self.order = self.tree.order if self.tree else np.arange(len(x))
        self.exact = self.finite and float(np.abs(self.points).max()) * len(x) < EXACT
        if self.exact:
            laid = self.points[self.order].astype(np.int64)
            self.sums = np.concatenate((np.zeros((1, x.shape[1]), np.int64), np.cumsum(laid, axis=0)))

    def integers(self, rows: np.ndarray) -> np.ndarray:
        return self.points[rows].astype(np.int64).astype(object) if self.exact else whole(self.x[rows], self.scale)

    def total(self, i: int, j: int) -> np.ndarray:
        """Sum of the rows ``order[i:j]``."""
        return (self.sums[j] - self.sums[i]).astype(object) if self.exact else self.integers(self.order[i:j]).sum(axis=0)

    def distances(self, rows: np.ndarray, entries: np.ndarray, doubles: np.ndarray) -> np.ndarray:
        """Squared distances, rows by entries, as whole numbers: in doubles where all sums are exact there."""
        p = self.points[rows]
        top = max(np.abs(p).max(initial=0), np.abs(doubles).max(initial=0))
        if 4 * p.shape[1] * top * top < EXACT:
            return (p * p).sum(axis=1)[:, None] + (doubles * doubles).sum(axis=1)[None] - 2 * (p @ doubles.T)
        gaps = self.integers(rows)[:, None, :] - entries[None]
        return (gaps * gaps).sum(axis=2)

    def assigned(self, book: Book, doubles: np.ndarray, tree: Tree | None) -> Iterator[tuple[int, int, np.ndarray | int]]:
        """(first, end, entry of all, or entries one by one) over ``order``."""
        if self.tree is not None and tree is not None:
            found = candidates(self.tree, tree)
        else:
            every = np.arange(len(book.entries))
            found = ((i, min(i + LEAF, len(self.x)), every) for i in range(0, len(self.x), LEAF))
        for i, j, some in found:
            if len(some) == 1:
                yield i, j, int(some[0])
            else:
                near = self.distances(self.order[i:j], book.entries[some], doubles[some])
                yield i, j, some[np.argmin(near, axis=1)]


def _tree(book: Book) -> tuple[np.ndarray, Tree | None]:
    doubles = book.doubles
    return doubles, Tree(doubles, 1) if np.isfinite(doubles).all() else None


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows and their vectors as doubles, ``BLOCK`` components at a time; short vectors end in zeros."""
    held: list[pa.RecordBatch] = []
    rows = max(1, BLOCK // width)

    def vectors(table: pa.Table) -> np.ndarray:
        lists = table.column("v").combine_chunks()
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        sizes = np.diff(lists.offsets.to_numpy())
        out = np.zeros((len(lists), width))
        out[np.arange(width)[None] < sizes[:, None]] = values
        return out

    def tables() -> Iterator[pa.Table]:
        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                held.append(batch.slice(at, rows))
                n += held[-1].num_rows
                if n >= rows:
                    yield pa.Table.from_batches(held)
                    held.clear()
                    n = 0
        if n:
            yield pa.Table.from_batches(held)

    for table in tables():
        yield table, vectors(table)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number of any size as (limb, long): limbs are added up by themselves, with room for 2**22 tasks."""
    at = 0
    while abs(value) >= 1 << 40:
        yield at, value & ((1 << LIMB) - 1)
        value, at = value >> LIMB, at + 1
    yield at, value


# -- Spark ------------------------------------------------------------------------------


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows whose vector is there and holds finite numbers only."""
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    named = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    return named.where(F.col("v").isNotNull() & usable)


def width_of(rows: DataFrame, parts: int = PARTS) -> int:
    """Components of the longest vector, made up to a multiple of ``parts``; 0 for no rows."""
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    return 0 if longest is None else parts * max(1, -(-longest // parts))


def first_books(rows: DataFrame, width: int, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES) -> list[Book]:
    """The codebooks of the vectors with the least ids (no id comes last, equal ids by vector).

    Some tasks narrow the candidates first, so that neither one task nor the driver
    sees a list that grows with the number of tasks.
    """
    fed = Window.partitionBy("feeder").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    few = (
        rows.select("vec_id", "v", F.pmod(F.spark_partition_id(), F.lit(FEEDERS)).alias("feeder"))
        .withColumn("rank", F.row_number().over(fed)).where(F.col("rank") <= entries)
    )
    least = few.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()  # ``entries`` rows
    first = np.zeros((len(least), width))
    for i, row in enumerate(least):
        first[i, :len(row["v"])] = row["v"]
    return [Book(whole(x, scale)) for x in np.split(first, parts, axis=1)]


def _sums(rows: DataFrame, books: Sequence[Book], width: int, scale: int) -> DataFrame:
    """(part, entry, place, limb, value) of every task: sums of the parts of each entry, place -1 counts them."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [(b, *_tree(b)) for b in books]
        total = [np.zeros(b.entries.shape, object) for b in books]
        count = [np.zeros(len(b.entries), np.int64) for b in books]
        for _, x in _blocks(batches, width):
            for p, (piece, (book, doubles, tree)) in enumerate(zip(np.split(x, parts, axis=1), made)):
                block = Block(piece, scale)
                one_by_one: list[tuple[np.ndarray, np.ndarray]] = []
                for i, j, chosen in block.assigned(book, doubles, tree):
                    if isinstance(chosen, int):
                        total[p][chosen] += block.total(i, j)
                        count[p][chosen] += j - i
                    else:
                        one_by_one.append((block.order[i:j], chosen))
                if one_by_one:
                    at, chosen = (np.concatenate(c) for c in zip(*one_by_one))
                    rank = np.argsort(chosen, kind="stable")
                    at, chosen = at[rank], chosen[rank]
                    first = np.flatnonzero(np.diff(chosen, prepend=-1))
                    laid = block.points[at].astype(np.int64) if block.exact else block.integers(at)
                    total[p][chosen[first]] += np.add.reduceat(laid, first, axis=0).astype(object)
                    count[p][chosen[first]] += np.diff(np.append(first, len(chosen)))
        out = [
            (p, int(e), place, limb, value)
            for p in range(parts) for e in np.flatnonzero(count[p])
            for place, whole_sum in enumerate([int(count[p][e]), *total[p][e].tolist()], -1)
            for limb, value in _limbs(int(whole_sum))
        ]
        for at in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out[at:at + 4096])], names=names)

    names = ["part", "entry", "place", "limb", "value"]
    found = rows.select("v").mapInArrow(run, T.StructType([T.StructField(c, T.LongType()) for c in names]))
    return found.groupBy(*names[:-1]).agg(F.sum("value").alias("value"))


def improved(rows: DataFrame, books: Sequence[Book], width: int, scale: int = SCALE) -> list[Book]:
    """One round: every used entry becomes the floored mean of its parts."""
    sums: dict[tuple[int, int], list[int]] = {}
    for r in _sums(rows, books, width, scale).collect():  # the size of the codebooks
        sums.setdefault((r["part"], r["entry"]), [0] * (1 + width // len(books)))[r["place"] + 1] += r["value"] << (LIMB * r["limb"])
    out = [Book(b.entries.copy()) for b in books]
    for (part, entry), (n, *total) in sums.items():
        out[part].entries[entry] = [t // n for t in total]
    return out


def fitted(rows: DataFrame, width: int, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Book]:
    """The codebooks after ``rounds`` rounds over all rows."""
    books = first_books(rows, width, scale, parts, entries)
    for _ in range(rounds):
        books = improved(rows, books, width, scale)
    return books


def encoded(rows: DataFrame, books: Sequence[Book], width: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error): indices as two hex digits a part, and the squared distance to the entries.

    An error beyond a long is given as the greatest long.
    """
    source = rows.select("vec_id", "label", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [(b, *_tree(b)) for b in books]
        for table, x in _blocks(batches, width):
            codes, error = np.empty((len(x), len(books)), np.uint8), np.zeros(len(x), object)
            for p, (piece, (book, doubles, tree)) in enumerate(zip(np.split(x, len(books), axis=1), made)):
                block = Block(piece, scale)
                for i, j, chosen in block.assigned(book, doubles, tree):
                    codes[block.order[i:j], p] = chosen
                top = max(np.abs(block.points).max(), np.abs(doubles).max())
                if 4 * width * top * top < EXACT:
                    error += ((block.points - doubles[codes[:, p]]) ** 2).sum(axis=1).astype(np.int64).astype(object)
                else:
                    gaps = block.integers(np.arange(len(x))) - book.entries[codes[:, p]]
                    error += (gaps * gaps).sum(axis=1)
            packed = table.to_batches()
            texts = [bytes(c).hex() for c in codes]
            at = 0
            for batch in packed:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id"), batch.column("label"), pa.array(texts[at:at + n], pa.string()),
                    pa.array([min(int(e), LONG) for e in error[at:at + n]], pa.int64()),
                ], names=["vec_id", "label", "code", "error"])
                at += n

    schema = T.StructType([*source.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return source.mapInArrow(run, schema)


def decoded(coded: DataFrame, books: Sequence[Book], scale: int = SCALE) -> DataFrame:
    """``coded`` with ``restored``: the vector its code stands for, as doubles of the original scale.

    The codebooks travel as one literal of parts * entries * width numbers.
    """
    table = F.array(*[F.array(*[F.array(*[F.lit(float(v) / scale) for v in e]) for e in b.entries.tolist()]) for b in books])
    index = [F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(books))]
    return coded.withColumn("restored", F.concat(*[F.get(F.get(table, F.lit(p)), i) for p, i in enumerate(index)]))


def digest(books: Sequence[Book]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for e in b.entries.tolist() for v in e).encode()).hexdigest()


def compress(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``vectors`` (vec_id, label, embedding) with a usable vector: code, errors, digest of the codebooks.

    Dropped are rows whose vector is null or holds a null or non-finite component, no
    others. Vectors shorter than the longest, and a length that ``parts`` does not divide,
    are made up with zeros. Rows without vec_id come last among the first entries; ties
    in distance go to the lower entry; repeated rows count each. ``label_error`` sums
    over equal labels, null being one of them, and ends at the greatest long like
    ``error``. Fewer rows than ``entries`` give as many entries; no rows give no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256: a code has two hex digits")
    prepare(vectors.sparkSession)
    rows = kept(vectors)
    width = width_of(rows, parts)
    books = fitted(rows, width, scale, parts, entries, rounds) if width else []
    key = [F.col("label").isNotNull().alias("__known"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("__key")]
    coded = written(encoded(rows, books, max(width, parts), scale), "codes").select("*", *key)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy("__known", "__key").agg(total.alias("label_error"), F.count(F.lit(1)).alias("__n"))
    joined = spread_join(coded, sums.drop("__n"), ["__known", "__key"], sums.select("__known", "__key", "__n"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
