"""Benchmark passages in training texts, by spaced seeds that tolerate substitutions.

A mask covers some words of a short window and ignores the others, so a replaced, added
or misspelt word hides a window from one mask but not from all. Hashes of the masked
windows of the benchmark and of the documents are joined; around each hit the two texts
are laid side by side and compared word by word.

A phrase that many items share would join every document that holds it with all of
them. Such windows are joined by the window and two more words near it. No passage is
lost: one of 26 words or more has a half of 13 or more that is a passage as well, and
whatever words may differ in one of 13 to 25, some mask and some two neighbours of its
window stand on words that are the same (a test tries all cases).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.bloom import Bloom
from shiftloom.llm.frames import prepare, shielded, written
from shiftloom.llm.words import MASK, Spans, mix, normal, texts, word_blocks

# Fixed masks: six compared words in windows of up to eleven.
MASKS = ("111111", "11011011", "1110010101", "10110001011", "11001010011")
LOG_BITS = 24  # of the filter of benchmark hashes: 2 MB
MIN_WORDS = 13  # compared words that make a passage; a shorter item has to be there as a whole
MIN_SHARE = 0.8  # of the compared words that are the same
SHORT = 3  # items of fewer words are not looked for
LONG = 12  # from so many words on, no substitutions that MIN_SHARE allows hide an item from all MASKS
REACH = 2 * MIN_WORDS - 1  # words of the passages in which a window and its neighbours are found
HOT = 16  # items that share a masked window, from which on it is joined with neighbours
SLICE = 64  # items, about, that one task compares with a text at a time
WEIGHT = 4  # compared words of the further masks for shorter items
ROW = "__row"  # names a row of a materialised table

# Factors of the first, second ... compared word: odd, from a fixed sequence.
FACTORS = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & MASK | 1) for i in range(16)]


def masked(words: np.ndarray, masks: tuple[str, ...]) -> list[np.ndarray]:
    """Per mask the hash of the words under it, for every place it fits."""
    weight = max((m.count("1") for m in masks), default=0)
    terms = [words * FACTORS[i] for i in range(weight)]
    found = []
    for mask in masks:
        n = max(0, len(words) - len(mask) + 1)
        total = np.full(n, len(mask), np.uint64)
        for term, i in zip(terms, (i for i, used in enumerate(mask) if used == "1")):
            total += term[i:i + n]
        found.append(mix(total))
    return found


def gapped(n: int, min_share: float) -> tuple[str, ...]:
    """Masks over a whole item of ``n`` words, of which one avoids whatever words may differ.

    The words are dealt to groups; each mask leaves out as many groups as words may
    differ. There are as few groups as leave :data:`WEIGHT` words, or all but those.
    """
    k = int(n * (1 - min_share) + 1e-9)
    if not k:
        return ()
    for groups in range(k + 1, n + 1):
        masks = {"".join("0" if i % groups in gone else "1" for i in range(n)) for gone in combinations(range(groups), k)}
        if groups == n or min(m.count("1") for m in masks) >= WEIGHT:
            return tuple(sorted(masks))
    return ()


def whole_masks(n: int, masks: tuple[str, ...], min_share: float) -> tuple[str, ...]:
    """Masks over a whole item of ``n`` words, for those that ``masks`` do not find for certain."""
    exact = ("1" * n,) if n < min(map(len, masks)) else ()
    return exact + (gapped(n, min_share) if n < LONG else ())


def word_hashes(words: list[bytes]) -> np.ndarray:
    return Spans(words).hashes(np.arange(len(words)), 1)


def neighbours(mask: str) -> list[tuple[int, int]]:
    """Pairs of places, counted from the window, that follow each other when those under the mask are left out."""
    places = [i for i in range(len(mask) - REACH, REACH) if not (0 <= i < len(mask) and mask[i] == "1")]
    return list(zip(places, places[1:]))


def extended(words: np.ndarray, found: np.ndarray, at: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the windows ``at``, whose hashes are ``found[at]``, with each pair of neighbours there is."""
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n, (a, b) in enumerate(neighbours(mask)):
        p = at[(at + a >= 0) & (at + b < len(words))]
        keys.append(mix(mix(found[p] + words[p + a] * FACTORS[14] + np.uint64(n + 1)) + words[p + b] * FACTORS[15]))
        places.append(p)
    return np.concatenate(keys), np.concatenate(places)


def seeds_of(words: np.ndarray, masks: tuple[str, ...], hot: Bloom | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every masked window, hot ones with their neighbours."""
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for mask, found in zip(masks, masked(words, masks)):
        warm = hot.known(found) if hot else np.zeros(len(found), bool)
        k, p = extended(words, found, np.flatnonzero(warm), mask)
        keys += [found[~warm], k]
        places += [np.flatnonzero(~warm), p]
    return np.concatenate(keys), np.concatenate(places)


def item_seeds(items: DataFrame, masks: tuple[str, ...], min_share: float = MIN_SHARE, hot: Bloom | None = None) -> DataFrame:
    """(seed, item, place): masked windows of the benchmark; short items also as a whole.

    ``place`` is -1 - n for a mask over a whole item of n words. Windows that ``hot``
    knows have their neighbours with them, but for items too short for that.
    """
    least = min(map(len, masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, owners, places = [], [], []
            for item, data in zip(batch.column("item").to_pylist(), texts(batch)):
                words = word_hashes(normal(data).split())
                if len(words) < SHORT:
                    continue
                found = [seeds_of(words, masks, hot if len(words) >= MIN_WORDS else None)] if len(words) >= least else []
                found += [(h, np.array([-1 - len(words)])) for h in masked(words, whole_masks(len(words), masks, min_share))]
                for h, p in found:
                    seeds.append(h)
                    places.append(p)
                    owners.append(np.full(len(h), item, np.int64))
            if seeds:
                yield pa.RecordBatch.from_pydict({
                    "seed": np.concatenate(seeds).view(np.int64), "item": np.concatenate(owners), "place": np.concatenate(places)})

    return items.mapInArrow(run, "seed long, item long, place long").distinct()


def hits(docs: DataFrame, known: Bloom, masks: tuple[str, ...], whole: tuple[str, ...] = (), hot: Bloom | None = None) -> DataFrame:
    """(row, seed, at) of the masked windows of documents that the filter lets pass.

    Windows that ``hot`` knows come once more with their neighbours; those under the
    masks ``whole`` do not.
    """
    overlap = max(*map(len, (*masks, *whole)), REACH if hot else 0) - 1

    def of(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        found = masked(words, (*masks, *whole))
        every = np.concatenate(found)
        kept = np.flatnonzero(known.known(every))
        firsts = np.cumsum([0, *map(len, found)])  # of each mask's windows
        yield every[kept], kept - firsts[np.searchsorted(firsts, kept, side="right") - 1]
        if hot and len(kept):
            shared = kept[hot.known(every[kept])]
            for mask, windows, a, b in zip(masks, found, firsts, firsts[1:]):
                at = shared[(shared >= a) & (shared < b)] - a
                if len(at):
                    keys, places = extended(words, windows, at, mask)
                    there = known.known(keys)
                    yield keys[there], places[there]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seeds, places = [], [], []
            for row, data in zip(batch.column("row").to_pylist(), texts(batch)):
                at = 0
                for words in word_blocks(normal(data), overlap):
                    for keys, found in of(word_hashes(words)):
                        seeds.append(keys)
                        places.append(found + at)
                        rows.append(np.full(len(keys), row, np.int64))
                    at += max(0, len(words) - overlap)
            if seeds:
                yield pa.RecordBatch.from_pydict({
                    "row": np.concatenate(rows), "seed": np.concatenate(seeds).view(np.int64), "at": np.concatenate(places)})

    return docs.select("row", "text").mapInArrow(run, "row long, seed long, at long")


def passages(text: np.ndarray, item: np.ndarray, shifts: list[int], min_words: int, min_share: float) -> list[tuple[int, int, int, int]]:
    """(first word in text, first in item, words, same words) of the longest passage per shift.

    A shift is place in text minus place in item. Laid side by side, same words count
    ``1 - min_share`` and others ``-min_share``; a run whose sum is not negative has
    ``min_share`` of its words the same. Of the longest runs the one with most same words
    counts, and of these one that begins with a same word, then the first.
    """
    found = []
    need = min(min_words, len(item))
    for shift in shifts:
        first, last = max(0, -shift), min(len(item), len(text) - shift)
        if last - first < need:
            continue
        same = text[first + shift:last + shift] == item[first:last]
        count = np.concatenate(([0], np.cumsum(same)))
        score = count - min_share * np.arange(len(count))
        high = np.maximum.accumulate(score[::-1])[::-1]  # falls: the last place that is high enough ends the longest run
        ends = np.searchsorted(-high, 1e-9 - score, side="right") - 1
        lengths = ends - np.arange(len(score))
        words = int(lengths.max())
        if words >= need and words:
            begins = np.flatnonzero(lengths == words)
            n_same = count[begins + words] - count[begins]
            best = int(np.argmax(2 * n_same + same[begins]))
            begin = int(begins[best])
            found.append((first + begin + shift, first + begin, words, int(n_same[best])))
    return found


RESULT = T.StructType([T.StructField(c, T.LongType()) for c in ("row", "item", "first", "item_first", "n_words", "n_same")])


def contaminated(
    docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, log_bits: int = LOG_BITS,
    min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, hot: int = HOT,
) -> DataFrame:
    """(row, item, first, item_first, n_words, n_same): a passage per document, item and shift.

    ``docs`` has row (long, unique) and text; ``items`` has item and text, and is grouped
    by its items. A passage has ``min_words`` compared words, or the whole item if that
    is shorter. Null texts have no words. Repeated items count once. Windows shared by
    more than ``hot`` items are joined with neighbours, where the other parameters are
    those that this is known to hold for.
    """
    seeds = written(item_seeds(items, masks, min_share), "items")
    common = None
    if (masks, min_words, min_share) == (MASKS, MIN_WORDS, MIN_SHARE):
        shared = seeds.where("place >= 0").groupBy("seed").agg(F.count_distinct("item").alias("n")).where(F.col("n") > hot)
        shared = written(shared.select("seed"), "shared")
        if not shared.isEmpty():
            common = Bloom.of(shared, log_bits)
    plain = seeds.select("seed")
    if common:
        seeds = written(item_seeds(items, masks, min_share, common), "items")
        plain = plain.union(seeds.select("seed"))
    known = Bloom.of(plain.distinct(), log_bits)
    # lengths of the items that are looked for as a whole, too
    short = seeds.where("place < 0").select("place").distinct().collect()
    whole = tuple(m for n in sorted(-1 - r["place"] for r in short) for m in whole_masks(n, masks, min_share))
    found = written(hits(docs, known, masks, whole, common), "hits").join(seeds, "seed")
    # one row per document, item and shift, however many windows agree
    shifts = found.select("row", "item", F.when(F.col("place") < 0, F.col("at")).otherwise(F.col("at") - F.col("place")).alias("shift"))
    pairs = written(shifts.groupBy("row", "item").agg(F.collect_set("shift").alias("shifts")), "pairs")
    item = items.groupBy("item").agg(F.first("text").alias("item_text"))
    # a text meets its items in slices, so that no row holds very many of them
    slices = pairs.groupBy("row").agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("slices"))
    sliced = pairs.join(slices, "row").withColumn("slice", F.pmod(F.xxhash64("item"), F.col("slices")))
    by_row = sliced.join(item, "item").groupBy("row", "slice").agg(F.collect_list(F.struct("item", "item_text", "shifts")).alias("pairs"))
    both = docs.join(written(by_row, "suspects"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, data, wanted in zip(batch.column("row").to_pylist(), texts(batch), batch.column("pairs").to_pylist()):
                text = np.concatenate([word_hashes(w) for w in word_blocks(normal(data), 0)])
                for pair in wanted:
                    item = word_hashes(normal((pair["item_text"] or "").encode()).split())
                    for p in passages(text, item, sorted(pair["shifts"]), min_words, min_share):
                        out.append((row, pair["item"], *p))
            columns = list(zip(*out)) or [()] * len(RESULT)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=RESULT.names)

    return both.select("row", "text", "pairs").mapInArrow(run, RESULT)


def _inputs(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    prepare(docs.sparkSession)
    keyed = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "documents")
    items = benchmark.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
    return keyed, items


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and benchmark item with a common passage: the longest such passage.

    doc_id, item_id, first_word (in the document, punctuation aside), n_words, n_same. Documents without one have no row. Rows without
    doc_id or item_id are reported with null.
    """
    keyed, items = _inputs(docs.select("doc_id", "text"), benchmark)
    found = contaminated(keyed.select(F.col(ROW).alias("row"), "text"), items.select("item", "text"))
    best = found.groupBy("row", "item").agg(F.max(F.struct("n_same", "n_words", (-F.col("first")).alias("back"))).alias("best"))
    names = items.select("item", "item_id").distinct()
    return (
        best.join(names, "item").join(keyed.select(F.col(ROW).alias("row"), "doc_id"), "row")
        .select("doc_id", "item_id", (-F.col("best.back")).alias("first_word"), F.col("best.n_words").alias("n_words"), F.col("best.n_same").alias("n_same"))
    )


@shielded
def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark passage was found."""
    keyed, items = _inputs(docs, benchmark)
    found = contaminated(keyed.select(F.col(ROW).alias("row"), "text"), items.select("item", "text"))
    bad = written(found.select(F.col("row").alias(ROW)).distinct(), "leaks")
    return keyed.join(bad, ROW, "left_anti").select(*docs.columns)
