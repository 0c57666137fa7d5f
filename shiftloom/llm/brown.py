"""Language-model scores from Brown classes: p(class | class before) * p(word | class).

The corpus is cut into blocks (some megabytes of texts, in numbers) and the vocabulary
into buckets (ranges of word hashes). Blocks count, for each of their words, the classes
of its neighbours; buckets gather these counts from all blocks and exchange words between
classes; the new classes go back to the blocks that have the words. What travels is one
packed row per block and bucket. Only sums over classes come to the driver.

Words are known by 64-bit hashes. Every training text and every word takes part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.frames import discard, prepare, written
from shiftloom.llm.words import texts

CLASSES = 32
ROUNDS = 12  # exchange passes at most
SETTLED = 0.02  # of a nat: a pass after which a training token is likelier by less is the last
FINE = 2  # buckets are 2**FINE times as many as partitions: a bucket's words must fit one task with room to spare
ALPHA = 0.1  # added to the count of every class that may follow a class
BLOCK_BYTES = 1 << 23
END_WORD = xxhash.xxh64_intdigest(b"\n")  # no word holds a line break


# -- numbers packed into binary columns -------------------------------------------------

def pack(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind)


def pack_ids(ids: np.ndarray) -> bytes:
    """Three bytes a number, low and high ones apart; a fourth where a block has 2**24 words or more."""
    high = ids.max(initial=0) >> 24
    return pack(ids & 0xFFFF, "<u2") + pack(ids >> 16 & 0xFF, "u1") + (pack(ids >> 24, "u1") if high else b"")


def unpack_ids(data: bytes, n: int) -> np.ndarray:
    out = unpack(data[:2 * n], "<u2").astype(np.int64)
    for place in range(2, len(data) // n if n else 0):
        out |= unpack(data[place * n:(place + 1) * n], "u1").astype(np.int64) << (8 * place)
    return out


class Contexts:
    """Per word of a bucket slice: how often which class stands before and after it."""

    @staticmethod
    def packed(keys: np.ndarray, counts: np.ndarray, width: int, words: int) -> dict:
        """From sorted keys word * width + context."""
        per_word = np.bincount(keys // width, minlength=words)
        large = counts >= 255
        return {
            "per_word": pack(per_word, "u1" if width < 256 else "<u2"), "context": pack(keys % width, "u1" if width < 256 else "<u2"),
            "small": pack(np.where(large, 255, counts), "u1"), "large": pack(counts[large], "<i8"),
        }

    @staticmethod
    def unpacked(part: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, context, count) of every entry."""
        kind = "u1" if width < 256 else "<u2"
        word = np.repeat(np.arange(len(part["per_word"]) // np.dtype(kind).itemsize), unpack(part["per_word"], kind))
        count = unpack(part["small"], "u1").astype(np.int64)
        count[count == 255] = unpack(part["large"], "<i8")
        return word, unpack(part["context"], kind).astype(np.int64), count


CONTEXT_FIELDS = "per_word: binary, context: binary, small: binary, large: binary"


# -- blocks -----------------------------------------------------------------------------

def sequences(tokens: np.ndarray, lengths: np.ndarray, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, class before, class after) of every token; texts begin and end with ``end``."""
    now = classes[tokens]
    before = np.concatenate(([end], now[:-1])) if len(now) else now
    after = np.concatenate((now[1:], [end])) if len(now) else now
    stops = np.cumsum(lengths)
    before[np.concatenate(([0], stops[:-1]))] = end
    after[stops - 1] = end
    return now, before, after


def block_contexts(tokens, lengths, train, classes, bounds, k: int) -> tuple[np.ndarray, list[dict]]:
    """Class transitions of the training texts, and the contexts of their words by bucket."""
    used = np.repeat(train, lengths)
    now, before, after = (x[used] for x in sequences(tokens, lengths, classes, k))
    width = 2 * (k + 1)
    matrix = np.bincount(before * (k + 1) + now, minlength=(k + 1) ** 2)
    word = tokens[used]
    keys, counts = np.unique(np.concatenate((word * width + before, word * width + k + 1 + after)), return_counts=True)
    cuts = np.searchsorted(keys, bounds * width)
    parts = [
        {"bucket": b} | Contexts.packed(keys[cuts[b]:cuts[b + 1]] - bounds[b] * width, counts[cuts[b]:cuts[b + 1]], width, int(bounds[b + 1] - bounds[b]))
        for b in np.flatnonzero(np.diff(bounds)).tolist()
    ]
    return matrix, parts


def encoded(docs: DataFrame, bits: int, k: int, block_bytes: int) -> DataFrame:
    """Texts as word numbers, block by block, with the contexts under the first classes.

    Words of a block are numbered in the order of their hashes, so the words of a bucket
    follow each other. The first class of a word is its hash modulo the classes.
    """

    def block(held: list[tuple], number: int) -> dict:
        index: dict[bytes, int] = {}
        ids, lengths = [], []
        for _, _, data in held:
            words = data.lower().split()
            ids.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)))
            ids[-1] = np.append(ids[-1], -1)  # the end
            lengths.append(len(words) + 1)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), np.uint64, len(index))
        hashes = np.append(hashes, np.uint64(END_WORD))
        tokens = np.concatenate(ids)
        hashes, place = np.unique(hashes, return_inverse=True)
        tokens, lengths = place[tokens], np.array(lengths)
        train = np.array([not h for _, h, _ in held])
        bounds = np.append(np.searchsorted(hashes >> np.uint64(64 - bits), np.arange(1 << bits, dtype=np.uint64)), len(hashes))
        matrix, parts = block_contexts(tokens, lengths, train, first_classes(hashes, k), bounds, k)
        counts = np.bincount(tokens[np.repeat(train, lengths)], minlength=len(hashes))
        for part in parts:
            i, j = bounds[part["bucket"]], bounds[part["bucket"] + 1]
            part |= {"hashes": pack(hashes[i:j], "<u8"), "counts": pack(counts[i:j], "<i8")}
        return {
            "block": number, "ids": [h[0] for h in held], "held_out": [h[1] for h in held], "lengths": pack(lengths, "<i8"),
            "tokens": pack_ids(tokens), "bounds": pack(bounds, "<i4"), "matrix": matrix.tolist(), "parts": parts,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            for row in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts(batch)):
                held.append(row)
                size += len(row[2]) + 64
                if size >= block_bytes:
                    yield packed([block(held, number)])
                    held, size, number = [], 0, number + 1
        if held:
            yield packed([block(held, number)])

    part = pa.struct([("bucket", pa.int32()), *((c, pa.binary()) for c in ("per_word", "context", "small", "large", "hashes", "counts"))])
    shape = pa.schema([
        ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("lengths", pa.binary()),
        ("tokens", pa.binary()), ("bounds", pa.binary()), ("matrix", pa.list_(pa.int64())), ("parts", pa.list_(part)),
    ])

    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, shape)

    schema = (
        "block long, ids array<long>, held_out array<boolean>, lengths binary, tokens binary, bounds binary, matrix array<long>, "
        f"parts array<struct<bucket: int, {CONTEXT_FIELDS}, hashes: binary, counts: binary>>"
    )
    return docs.mapInArrow(run, schema)


def first_classes(hashes: np.ndarray, k: int) -> np.ndarray:
    classes = (hashes % np.uint64(k)).astype(np.int64)
    classes[hashes == np.uint64(END_WORD)] = k
    return classes


def by_bucket(right: pa.Table, column: str, kind: str, bounds: np.ndarray) -> np.ndarray:
    """What the buckets sent to a block, in the order of its words."""
    out = np.zeros(int(bounds[-1]), np.int64)
    for bucket, data in zip(right.column("bucket").to_pylist(), right.column(column).to_pylist()):
        out[bounds[bucket]:bounds[bucket + 1]] = unpack(data, kind)
    return out


# -- buckets ----------------------------------------------------------------------------

def exchange(word, context, count, classes: np.ndarray, matrix: np.ndarray, k: int, movable: np.ndarray) -> np.ndarray:
    """Every movable word goes to the class in which its contexts are most likely.

    The word leaves its class first: its own counts are taken out of the class it is in.
    ``matrix`` holds the transitions of all training texts under the present classes.
    """
    seen = np.concatenate((matrix[:, :k], matrix[:k, :].T))  # context x class
    total_before, total_after = matrix[:, :k].sum(0), matrix[:k, :].sum(1)
    smooth = 0.5
    whole = np.concatenate((np.tile(total_before, (k + 1, 1)), np.tile(total_after, (k + 1, 1))))
    table = np.log(seen + smooth) - np.log(whole + smooth * (k + 1))
    words = len(classes)
    own_total = np.bincount(word, weights=count * (context <= k), minlength=words)
    own_after = np.bincount(word, weights=count * (context > k), minlength=words)
    best = classes.copy()
    order = np.argsort(word, kind="stable")
    word, context, count = word[order], context[order], count[order]
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else np.zeros(0, np.int64)
    step = 1 << 16
    for s in range(0, len(starts), step):
        some = starts[s:s + step]
        i, j = some[0], starts[s + step] if s + step < len(starts) else len(word)
        w, c, n = word[i:j], context[i:j], count[i:j]
        gain = np.add.reduceat(table[c] * n[:, None], some - i, axis=0)
        ids = word[some]
        mine = classes[w]
        at_home = mine < k
        home = np.where(at_home, mine, 0)
        rest = np.where(c <= k, whole[c, home] - own_total[w], whole[c, home] - own_after[w])
        left = np.log(np.maximum(seen[c, home] - n, 0) + smooth) - np.log(np.maximum(rest, 0) + smooth * (k + 1))
        home_gain = np.add.reduceat(left * n, some - i)
        own = classes[ids] < k
        gain[np.flatnonzero(own), classes[ids][own]] = home_gain[own]
        choice = gain.argmax(1)
        move = movable[ids] & own
        best[ids[move]] = choice[move]
    return best


def first_exchange(bucket_rows: pa.Table, matrix: np.ndarray, k: int) -> list[dict]:
    """A bucket's words out of all blocks: counts, first exchange, what each block gets."""
    rows = bucket_rows.to_pylist()
    hashes, place = np.unique(np.concatenate([unpack(r["hashes"], "<u8") for r in rows]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([unpack(r["counts"], "<i8") for r in rows]), minlength=len(hashes)).astype(np.int64)
    cuts = np.cumsum([0] + [len(r["hashes"]) // 8 for r in rows])
    index = [place[i:j] for i, j in zip(cuts, cuts[1:])]
    classes = moved(rows, index, first_classes(hashes, k), matrix, k)
    return answers(rows, index, classes, counts)


def moved(rows: list[dict], index: list[np.ndarray], classes: np.ndarray, matrix: np.ndarray, k: int) -> np.ndarray:
    width = 2 * (k + 1)
    keys, numbers = [], []
    for r, idx in zip(rows, index):
        word, context, count = Contexts.unpacked(r, width)
        keys.append(idx[word] * width + context)
        numbers.append(count)
    keys, back = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(back, weights=np.concatenate(numbers), minlength=len(keys))
    return exchange(keys // width, keys % width, count, classes, matrix, k, classes < k)


def answers(rows: list[dict], index: list[np.ndarray], classes: np.ndarray, counts: np.ndarray) -> list[dict]:
    """A row per block (its words' classes and counts) and one for the bucket itself (block -1)."""
    bucket = rows[0]["bucket"]
    out = [{
        "bucket": bucket, "block": r["block"], "index": pack(i, "<i4"), "classes": pack(classes[i], "<u2"), "counts": pack(counts[i], "<i8"), "known": 0,
    } for r, i in zip(rows, index)]
    own = {"bucket": bucket, "block": -1, "index": b"", "classes": pack(classes, "<u2"), "counts": pack(counts, "<i8")}
    return [*out, own | {"known": int((counts > 0).sum())}]


ANSWER = "bucket int, block long, index binary, classes binary, counts binary, known long"
ANSWER_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("index", pa.binary()), ("classes", pa.binary()), ("counts", pa.binary()), ("known", pa.int64())])


def summed(df: DataFrame, column: str, size: int) -> np.ndarray:
    """Element-wise sum of an array column: ``size`` numbers come to the driver."""
    rows = df.select(F.posexplode(column).alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["i"]] = r["n"]
    return out


def likelihood(matrix: np.ndarray) -> float:
    """What the classes add to the log likelihood of the training tokens: their mutual information, in nats."""
    n = matrix.astype(float)
    rows, columns = n.sum(1, keepdims=True), n.sum(0, keepdims=True)
    some = n > 0
    return float((n[some] * np.log((n * n.sum())[some] / (rows * columns)[some])).sum())


# -- the model --------------------------------------------------------------------------

def transitions(matrix: np.ndarray, rare: np.ndarray, k: int, alpha: float) -> np.ndarray:
    """log10 p(next | class before), with the share a word has of its class left out.

    Classes 0 to k-1, k for the end of a text, k + 1 for unknown words. Words seen once
    in training stand for the unknown: an unknown word is as likely after a class as they
    are, and what follows it follows them. ``rare``: per class the rare words after it,
    per class what follows rare words, and rare words after rare words.
    """
    after, follow, both = rare[:k + 1], rare[k + 1:2 * k + 2], rare[2 * k + 2]
    rows = np.vstack((matrix, follow)).astype(float)
    unknown = (np.append(after, both) + 0.5) / (rows.sum(1) + 1)
    used = matrix.sum(0) > 0  # a class without words gets nothing
    smooth = (rows + alpha * used) / np.maximum(rows.sum(1, keepdims=True) + alpha * used.sum(), 1e-300)
    smooth = np.where(used, smooth, 1e-300)
    known = np.log10((1 - unknown)[:, None] * smooth) - np.log10(np.maximum(matrix.sum(0), 1))
    return np.column_stack((known, np.log10(unknown)))


def score(docs: DataFrame, held_out, classes: int = CLASSES, rounds: int = ROUNDS, alpha: float = ALPHA,
          block_bytes: int = BLOCK_BYTES, settled: float = SETTLED) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a boolean column; texts where it is true (null: false) are scored and
    not learned from. A null text is empty and has one token, its end. Perplexity is
    10 ** (-score / n_tokens). Without training texts every token is unknown. Repeated
    rows are learned from as often as they come. An empty table gives an empty one.

    Words are exchanged until a pass makes a training token likelier by less than
    ``settled`` nats, ``rounds`` passes at most. What a pass has written goes once the next is written.
    """
    spark = prepare(docs.sparkSession)
    k, width = classes, 2 * (classes + 1)
    given = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    bits = max(4, math.ceil(math.log2(max(1, given.rdd.getNumPartitions()))) + FINE)
    blocks = written(encoded(given, bits, k, block_bytes), "blocks")
    matrix = summed(blocks, "matrix", (k + 1) ** 2).reshape(k + 1, k + 1)

    def first(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(first_exchange(table, matrix, k), ANSWER_ARROW)

    parts = blocks.select("block", F.explode("parts").alias("p")).select("block", "p.*")
    answer = state = written(parts.groupBy("bucket").applyInArrow(first, ANSWER), "classes")
    likely = likelihood(matrix)
    for _ in range(rounds - 1):
        counted = written(_contexts(blocks, answer, k), "contexts")
        matrix = summed(counted, "matrix", (k + 1) ** 2).reshape(k + 1, k + 1)
        before, likely = likely, likelihood(matrix)
        if likely - before < settled * matrix.sum():
            break
        older, answer = answer, written(_exchanged(counted, state, answer, matrix, k), "classes")
        discard(counted)
        if older is not state:
            discard(older)

    stats = written(_statistics(blocks, answer, state, k), "statistics")
    matrix = summed(stats, "matrix", (k + 1) ** 2).reshape(k + 1, k + 1)
    table = transitions(matrix, summed(stats, "rare", 2 * k + 3), k, alpha)
    vocabulary = state.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    total = int(matrix.sum())
    return _scores(stats, table, total, vocabulary, k)


def _contexts(blocks: DataFrame, answer: DataFrame, k: int) -> DataFrame:
    part = pa.struct([("bucket", pa.int32()), *((c, pa.binary()) for c in ("per_word", "context", "small", "large"))])
    shape = pa.schema([("block", pa.int64()), ("matrix", pa.list_(pa.int64())), ("parts", pa.list_(part))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            bounds = unpack(r["bounds"], "<i4").astype(np.int64)
            matrix, parts = block_contexts(
                unpack_ids(r["tokens"], int(unpack(r["lengths"], "<i8").sum())), unpack(r["lengths"], "<i8"), ~np.array(r["held_out"], bool),
                by_bucket(right, "classes", "<u2", bounds), bounds, k)
            out.append({"block": r["block"], "matrix": matrix.tolist(), "parts": parts})
        return pa.Table.from_pylist(out, shape)

    schema = f"block long, matrix array<long>, parts array<struct<bucket: int, {CONTEXT_FIELDS}>>"
    left = blocks.select("block", "held_out", "lengths", "tokens", "bounds")
    right = answer.where("block >= 0").select("block", "bucket", "classes")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)


def _exchanged(counted: DataFrame, state: DataFrame, answer: DataFrame, matrix: np.ndarray, k: int) -> DataFrame:
    """The next classes. ``state`` knows which words of a bucket a block has."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {r["block"]: r for r in right.to_pylist()}
        rows = [r for r in left.to_pylist() if r["block"] in known]
        index = [unpack(known[r["block"]]["index"], "<i4").astype(np.int64) for r in rows]
        classes = moved(rows, index, unpack(known[-1]["classes"], "<u2").astype(np.int64), matrix, k)
        out = answers(rows, index, classes, unpack(known[-1]["counts"], "<i8"))
        return pa.Table.from_pylist([r | {"index": b"", "counts": b"" if r["block"] >= 0 else r["counts"]} for r in out], ANSWER_ARROW)

    left = counted.select("block", F.explode("parts").alias("p")).select("block", "p.*")
    latest = answer.where("block = -1").select("bucket", "block", "index", "classes", "counts")
    right = state.where("block >= 0").select("bucket", "block", "index", F.lit(b"").alias("classes"), F.lit(b"").alias("counts")).unionByName(latest)
    return left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(run, ANSWER)


STATISTICS = "ids array<long>, held_out array<boolean>, n_tokens binary, n_known binary, log_count binary, log_next binary, cells binary, matrix array<long>, rare array<long>"


def _statistics(blocks: DataFrame, answer: DataFrame, state: DataFrame, k: int) -> DataFrame:
    """Per block and text: what its score is made of, once the sums over all blocks are known."""
    shape = pa.schema([
        ("ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), *((c, pa.binary()) for c in ("n_tokens", "n_known", "log_count", "log_next", "cells")),
        ("matrix", pa.list_(pa.int64())), ("rare", pa.list_(pa.int64())),
    ])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([of(r, right) for r in left.to_pylist()], shape)

    def of(r: dict, right: pa.Table) -> dict:
        bounds = unpack(r["bounds"], "<i4").astype(np.int64)
        lengths, train = unpack(r["lengths"], "<i8"), ~np.array(r["held_out"], bool)
        tokens = unpack_ids(r["tokens"], int(lengths.sum()))
        counts = by_bucket(right, "counts", "<i8", bounds)
        classes = by_bucket(right, "classes", "<u2", bounds)
        classes[counts == 0] = k + 1
        text = np.repeat(np.arange(len(lengths)), lengths)
        now, before, _ = sequences(tokens, lengths, classes, k)
        n = counts[tokens]
        used = train[text]
        matrix = np.bincount(before[used] * (k + 1) + now[used], minlength=(k + 1) ** 2)
        once = n == 1
        earlier = np.concatenate(([False], once[:-1]))
        earlier[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = False
        rare = np.concatenate((
            np.bincount(before[used & once], minlength=k + 1), np.bincount(now[used & earlier], minlength=k + 1), [np.sum(used & earlier & once)]))
        cells, numbers = np.unique(text * (k + 2) ** 2 + before * (k + 2) + now, return_counts=True)
        size = len(lengths)
        return {
            "ids": r["ids"], "held_out": r["held_out"], "n_tokens": pack(lengths, "<i8"),
            "n_known": pack(np.bincount(text, weights=n > 0, minlength=size), "<i8"),
            "log_count": pack(np.bincount(text, weights=np.log10(np.maximum(n, 1)), minlength=size), "<f8"),
            "log_next": pack(np.bincount(text, weights=np.log10(n + 1.0), minlength=size), "<f8"),
            "cells": pack(cells, "<i8") + pack(numbers, "<i4"), "matrix": matrix.tolist(), "rare": rare.tolist(),
        }

    left = blocks.select("block", "ids", "held_out", "lengths", "tokens", "bounds")
    right = answer.where("block >= 0").select("block", "bucket", "classes").join(
        state.where("block >= 0").select("block", "bucket", "counts"), ["block", "bucket"])
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, STATISTICS)


def _scores(stats: DataFrame, table: np.ndarray, total: int, vocabulary: int, k: int) -> DataFrame:
    flat = table.ravel()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n_tokens, n_known = unpack(r["n_tokens"], "<i8"), unpack(r["n_known"], "<i8")
                m = len(r["cells"]) // 12
                cells, numbers = unpack(r["cells"][:8 * m], "<i8"), unpack(r["cells"][8 * m:], "<i4")
                text, cell = np.divmod(cells, (k + 2) ** 2)
                of_model = np.bincount(text, weights=numbers * flat[cell], minlength=len(n_tokens)) + unpack(r["log_count"], "<f8")
                base = unpack(r["log_next"], "<f8") - n_tokens * math.log10(total + vocabulary + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(r["ids"], pa.int64()), pa.array(r["held_out"], pa.bool_()), pa.array(n_tokens), pa.array(n_known),
                    pa.array(np.full(len(n_tokens), total)), pa.array(base), pa.array(of_model)], names=names)

    columns = ["ids", "held_out", "n_tokens", "n_known", "log_count", "log_next", "cells"]
    return stats.select(*columns).mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
