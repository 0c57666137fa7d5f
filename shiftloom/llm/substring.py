"""Repeated passages: seeds by winnowing, extended both ways to maximal repeats.

Of the word k-grams inside a window of ``length`` words, the one with the least hash is
the window's seed. Equal windows have the same seed at the same place, so only seeds
that occur twice are looked at. The windows of one seed occurrence lie side by side; the
words they cover are its region.

* Occurrences of a seed with equal regions match over the whole region.
* Where a seed has several different regions, the matches end somewhere inside them. One
  occurrence per region is extended: a match reaches ``i`` words to the left of the seed
  and on to the end of the window there, if both have the same window at offset ``i``.
  Equality of (seed, offset, window) is a grouping and not a comparison of pairs.

Adjoining repeated windows together are the maximal repeats of at least ``length`` words.
Spans are compared by 128 bits of hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.bloom import Bloom
from shiftloom.llm.frames import prepare, written
from shiftloom.llm.words import Spans, mix, texts, word_blocks

LENGTH = 35
GRAM = 8
LOG_BITS = 26  # of the filter of occurrences to extend: 8 MB
TEXT_KEY = ["k1", "k2"]


def text_key() -> list[Column]:
    """128 bits that stand for a text: copies are worked on as one text."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def seeds(spans: Spans, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per seed occurrence: its hash, first window, number of windows, word of the seed."""
    value = spans.hashes(np.arange(spans.n - gram + 1), gram)
    place = np.arange(len(value))
    # least of 1, 2, 4 ... and then all k-grams of a window; the leftmost of equals
    reach, total = 1, length - gram + 1
    while reach < total:
        step = min(reach, total - reach)
        less = value[step:] < value[:-step]
        place = np.where(less, place[step:], place[:-step])
        value = np.where(less, value[step:], value[:-step])
        reach += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return value[first], first, np.diff(np.append(first, len(place))), place[first]


def occurrence_key(seed: np.ndarray, k1: int, k2: int, first: np.ndarray) -> np.ndarray:
    text = mix(np.array([k1, k2], np.int64).view(np.uint64))
    return mix(seed ^ text[0] ^ mix(text[1] + first.astype(np.uint64)))


def occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(seed, region, k1, k2, first, windows) of every seed occurrence of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, data in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), texts(batch)):
                at = 0
                for words in word_blocks(data, length - 1):
                    if len(words) >= length:
                        spans = Spans(words)
                        seed, first, windows, _ = seeds(spans, length, gram)
                        region = spans.hashes(first, windows + (length - 1), 1)
                        yield pa.RecordBatch.from_pydict({
                            "seed": seed.view(np.int64), "region": region.view(np.int64),
                            "k1": np.full(len(seed), k1), "k2": np.full(len(seed), k2),
                            "first": first + at, "windows": windows,
                        })
                    at += max(0, len(words) - (length - 1))

    schema = "seed long, region long, k1 long, k2 long, first long, windows long"
    return docs.select(*text_key(), "text").mapInArrow(_gathered(run), schema)


def _gathered(run, rows: int = 20_000):
    """The function with its small batches joined to larger ones."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def extensions(docs: DataFrame, chosen: Bloom, length: int, gram: int) -> DataFrame:
    """(seed, offset, window, k1, k2, first): the windows of the chosen occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k1, k2, data in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), texts(batch)):
                at = 0
                for words in word_blocks(data, length - 1):
                    if len(words) >= length:
                        spans = Spans(words)
                        seed, first, windows, place = seeds(spans, length, gram)
                        known = chosen.known(occurrence_key(seed, k1, k2, first + at))
                        if known.any():
                            seed, first, windows, place = (x[known] for x in (seed, first, windows, place))
                            begin = np.repeat(first - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
                            yield pa.RecordBatch.from_pydict({
                                "seed": np.repeat(seed, windows).view(np.int64), "offset": np.repeat(place, windows) - begin,
                                "window": spans.hashes(begin, length, 1).view(np.int64),
                                "k1": np.full(len(begin), k1), "k2": np.full(len(begin), k2), "first": begin + at,
                            })
                    at += max(0, len(words) - (length - 1))

    schema = "seed long, offset long, window long, k1 long, k2 long, first long"
    return docs.select(*text_key(), "text").mapInArrow(_gathered(run), schema)


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, log_bits: int = LOG_BITS) -> DataFrame:
    """Per text with repeated windows: k1, k2 and ``runs``, pairs (first, windows).

    A window counts if its word sequence also starts anywhere else, in the same text, in
    another one, or in a copy of the text.
    """
    prepare(docs.sparkSession)
    # Every join is between written tables, where adaptive execution can split a hot seed.
    every = written(occurrences(docs, length, gram), "seeds")
    again = written(every.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"), "again")
    hits = written(every.join(again, "seed", "left_semi"), "hits")
    one = F.struct(*TEXT_KEY, "first", "windows")
    classes = written(hits.groupBy("seed", "region").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one")), "regions")
    same = written(classes.where("n > 1").select("seed", "region"), "same")
    whole = hits.join(same, ["seed", "region"], "left_semi").select(*TEXT_KEY, "first", "windows")

    many = written(classes.groupBy("seed").agg(F.count(F.lit(1)).alias("regions")).where("regions > 1").select("seed"), "many")
    ends = classes.join(many, "seed", "left_semi").select("seed", "one.k1", "one.k2", "one.first")
    windows = written(extensions(docs, Bloom.of(_keys(ends), log_bits), length, gram), "windows")
    spot = ["seed", "offset", "window"]
    twice = written(windows.groupBy(*spot).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*spot), "twice")
    inside = windows.join(twice, spot, "left_semi").select(*TEXT_KEY, "first", F.lit(1).cast("long").alias("windows"))

    return whole.unionByName(inside).groupBy(*TEXT_KEY).agg(F.collect_set(F.struct("first", "windows")).alias("runs"))


def _keys(ends: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed, k1, k2, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seed", "k1", "k2", "first"))
            text = mix(k1.view(np.uint64)), mix(k2.view(np.uint64))
            key = mix(seed.view(np.uint64) ^ text[0] ^ mix(text[1] + first.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])

    return ends.mapInArrow(run, "key long")


def cut(data: bytes, runs: list[tuple[int, int]], length: int) -> tuple[int, bytes, list[tuple[int, int]]]:
    """Number of words, kept words joined by one space, removed word spans (end exclusive)."""
    spans: list[tuple[int, int]] = []
    for first, windows in sorted(runs):
        end = first + windows + length - 1
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((first, end))
    kept, n, at = [], 0, 0
    for words in word_blocks(data, 0):
        stop, place = n + len(words), n
        while at < len(spans) and spans[at][0] < stop:
            first, end = spans[at]
            kept += words[place - n:max(first, place) - n]
            place = max(place, min(end, stop))
            if end > stop:
                break
            at += 1
        kept += words[place - n:]
        n = stop
    return n, b" ".join(kept), spans


def remove_repeats(docs: DataFrame, *keep: str, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, n_words, n_removed, kept_text, removed.

    Every word that a repeated window covers goes; ``kept_text`` holds the others, joined
    by one space, and ``removed`` the maximal repeats as word spans (first, end). Windows
    are judged on the texts as they came. A null text has no words; a text shorter than
    ``length`` words loses none; repeated rows are each other's repeats.
    """
    runs = written(repeated(docs, length, gram), "runs")
    source = docs.select(*keep, "text", *text_key())
    joined = source.join(runs, TEXT_KEY, "left").select(*keep, "text", "runs")
    added = "n_words long, n_removed long, kept_text string, removed array<struct<first: long, end: long>>"
    schema = T.StructType(docs.select(*keep).schema.fields + T.StructType.fromDDL(added).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[(r["first"], r["windows"]) for r in x or ()] for x in batch.column("runs").to_pylist()]
            cuts = [cut(data, x, length) for data, x in zip(texts(batch), found)]
            span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in keep), pa.array([c[0] for c in cuts], pa.int64()),
                pa.array([sum(e - f for f, e in c[2]) for c in cuts], pa.int64()),
                pa.array([c[1] for c in cuts], pa.binary()).cast(pa.string()),
                pa.array([[{"first": f, "end": e} for f, e in c[2]] for c in cuts], span),
            ], names=[*keep, "n_words", "n_removed", "kept_text", "removed"])

    return joined.mapInArrow(run, schema)
