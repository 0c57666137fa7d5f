import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftloom.llm import catalog, tokens

from .helpers import corpus, frame

tokenizers = pytest.importorskip("tokenizers")
PATH = catalog.vocabulary()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.Vocabulary.read(open(PATH, encoding="utf-8").read())


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


LONG = [
    (1000, "a" * 30_000, "en", "a", 1), (1001, "=" * 5_000 + " " * 3_000, "en", "a", 1), (1002, "漢é🙂 " * 3_000, "en", "a", 1),
    (1003, "x<|endoftext|>y <|endoftext|><|endoftext|", "en", "a", 1), (1004, "don't we'll    they're\x1c", "en", "a", 1),
    (1005, "\x00\x7f​﻿", "en", "a", 1), (1006, "word " * 512, "en", "a", 1), (1007, "word " * 511, "en", "a", 1),
]


def test_counts_are_the_library_s(spark, library):
    rows = corpus(5, 60) + LONG
    df = frame(spark, rows).withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "counts").repartition(4)
    got = sorted(map(repr, map(tuple, tokens.counted(df, PATH).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect())))
    want = [(r[0], len((r[1] or "").encode()), count(library, r[1] or "")) for r in rows]
    assert got == sorted(repr((*w, w[2] > 512)) for w in want)


def test_limit_is_the_longest_prefix_that_fits(spark, library):
    rows = [r for r in LONG if len(r[1]) < 4000] + corpus(6, 8)
    for limit in (0, 1, 7, 40):
        got = tokens.truncated(frame(spark, rows), PATH, limit).collect()
        assert len(got) == len(rows)
        for row in got:
            assert count(library, row["text"]) == row["n_tokens"] <= limit
        by_id = {r[0]: r[1] or "" for r in rows}
        for row in got:
            text, at = by_id[row["doc_id"]], len(row["text"])
            assert text.startswith(row["text"])
            assert all(count(library, text[:i]) > limit for i in range(at + 1, min(len(text), at + 12) + 1))


def test_prefix_counts(spark, library):
    rows = [r for r in corpus(7, 6) if len(r[1] or "") < 400]
    for doc_id, counts in tokens.prefix_counts(frame(spark, rows), PATH).collect():
        texts = [r[1] or "" for r in rows if r[0] == doc_id]
        assert [count(library, texts[0][:i]) for i in range(len(texts[0]) + 1)] == counts


def test_no_rows(spark):
    assert tokens.counted(frame(spark, []), PATH).collect() == []


BITS = ["a", "b", " ", "  ", "'", "re", "'s", "\n", "\t", "é", "ß", "漢", "🙂", "<|endoftext|>", "1", "23", "!", "...", " ", "the", "LL", "'l", "\xa0"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=20))
def test_every_prefix(vocabulary, library, bits):
    text = "".join(bits)
    assert vocabulary.prefixes(text).tolist() == [count(library, text[:i]) for i in range(len(text) + 1)]


def test_memories_that_run_full(library, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_PIECES", 5)
    monkeypatch.setattr(tokens, "KNOWN_PAIRS", 5)
    vocabulary = tokens.Vocabulary.read(open(PATH, encoding="utf-8").read())
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join("".join(rng.choice("abcdeé ") for _ in range(9)) for _ in range(9))
        assert vocabulary.prefixes(text)[-1] == count(library, text)


def test_other_kinds_of_vocabulary_are_refused():
    spec = json.load(open(PATH, encoding="utf-8"))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError):
            tokens.Vocabulary.read(json.dumps(spec | change))
