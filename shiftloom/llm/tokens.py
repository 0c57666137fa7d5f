"""Exact token counts at every prefix of a text, for byte-level BPE vocabularies.

A merge encoding is right if and only if every two neighbouring tokens in it are what the
merges make of their bytes. So the encoding of a prefix is the encoding of a shorter
prefix and one more token, and exactly one token fits: for every position of a piece the
table keeps that last token and ``count[i] = count[i - length] + 1``. A text's table is
that of its pieces, each on top of the tokens before it. The count of a whole text, whether
it fits a budget and where it has to be cut are read from the table; nothing is encoded again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.frames import prepare

LIMIT = 512
# The pattern that splits a text before the merges, as the vocabularies' library has it.
PATTERN = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_PIECES, KNOWN_PAIRS = 1 << 18, 1 << 18  # entries of a worker's memories; a full one is kept beside a new one
ENDINGS = ("'re", "'ve", "'ll")
DOUBLE = regex.compile(r"\s\s")
SHORT = 64  # code points of a piece worth remembering


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files.

    Printable bytes stand for themselves, the others follow from code point 256 on.
    """
    plain = [b for span in ((33, 126), (161, 172), (174, 255)) for b in range(span[0], span[1] + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merge ranks of a byte-level BPE file, and the tables made with them."""

    def __init__(self, merges: Sequence[tuple[bytes, bytes]], tokens: Sequence[bytes], special: Sequence[str]):
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.parts = {a + b: (a, b) for a, b in merges}
        self.made = {a + b: i for i, (a, b) in enumerate(merges)}  # bytes come before all merges
        if len(self.made) < len(merges) or any(max(self.made.get(a, -1), self.made.get(b, -1)) >= i for i, (a, b) in enumerate(merges)):
            raise ValueError("a merge comes before what it merges, or twice")
        # what the merges never make is no token
        self.tokens = {t for t in tokens if len(t) == 1 or t in self.made and self._apart(*self.parts[t], self.made[t])}
        self.numbers = {t: i for i, t in enumerate(sorted(self.tokens))}
        self.names = sorted(self.tokens)
        self._ends: dict[int, tuple[int, dict]] = {}  # by the last byte, then the one before: the token's number or -1, and what goes on
        for t, number in self.numbers.items():
            node = self._ends
            for byte in t[:0:-1]:
                node = node.setdefault(byte, (-1, {}))[1]
            node[t[0]] = number, node[t[0]][1] if t[0] in node else {}
        self.pattern = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._pairs: dict[int, bool] = {}
        self._older_pairs: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._older_pieces: dict[str, bytes] = {}

    @classmethod
    def read(cls, content: str) -> Vocabulary:
        """From the JSON text of a byte-level BPE tokenizer without normalisation or post-processing."""
        spec = json.loads(content)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not any((split.get("add_prefix_space"), spec["normalizer"], spec["post_processor"], model.get("ignore_merges"),
                         model.get("continuing_subword_prefix"), model.get("end_of_word_suffix"), model.get("dropout")))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
        )
        if not plain:
            raise ValueError("only byte-level BPE without normalisation, prefixes or post-processing")
        letters = byte_letters()
        added = {t["content"] for t in spec["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        as_bytes: Callable[[str], bytes] = lambda t: bytes(letters[c] for c in t)
        return cls([(as_bytes(a), as_bytes(b)) for a, b in merges], [as_bytes(t) for t in model["vocab"] if t not in added], sorted(added))

    def _apart(self, a: bytes, b: bytes, before: int) -> bool:
        """Whether no merge ahead of ``before`` joins what stands left and right of the border of two tokens.

        Undoes the later of the two merges at the border again and again. Of equal merges
        the left one comes first, so a merge across the border that ties with the right
        token's wins, and one that ties with the left token's does not.
        """
        ranks, made, parts = self.ranks, self.made, self.parts
        while True:
            if ranks.get((a, b), before) < before:
                return False
            left, right = made.get(a, -1), made.get(b, -1)
            if left > right:
                before, a = left, parts[a][1]
            elif right >= 0:
                before, b = right + 1, parts[b][0]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        """Whether the tokens of these numbers stay two when they stand side by side."""
        pair = a * len(self.names) + b
        known = self._pairs.get(pair)
        if known is None:
            known = self._older_pairs.get(pair)
            if known is None:
                known = self._apart(self.names[a], self.names[b], len(self.ranks))
            if len(self._pairs) >= KNOWN_PAIRS:
                self._pairs, self._older_pairs = {}, self._pairs
            self._pairs[pair] = known
        return known

    def table(self, data: bytes) -> list[int]:
        """``out[i]``: tokens of the first i bytes of one piece."""
        counts, last = [0], [-1]
        size, pairs, fits = len(self.names), self._pairs, self.fits
        for i in range(len(data)):
            node, j = self._ends, i
            while True:
                found = node.get(data[j]) if j >= 0 else None
                if found is None:
                    raise ValueError(f"no token ends at byte {i}")
                token, node = found
                if token >= 0:
                    if j == 0:
                        break
                    known = pairs.get(last[j] * size + token)
                    if known or known is None and fits(last[j], token):
                        break
                j -= 1
            counts.append(counts[j] + 1)
            last.append(token)
        return counts

    def piece(self, text: str) -> bytes:
        """Tokens at the end of every code point of one piece, four bytes each."""
        known = self._pieces.get(text)
        if known is None:
            known = self._older_pieces.get(text)
            if known is None:
                data = text.encode()
                counts = self.table(data)
                own = counts[1:] if len(data) == len(text) else [n for n, b in zip(counts[1:], data[1:] + b"a") if b & 0xC0 != 0x80]
                if text in ENDINGS:  # their first two signs are no ending yet
                    own[:2] = 1, 2
                known = array("i", own).tobytes()
            if len(text) <= SHORT:
                if len(self._pieces) >= KNOWN_PIECES:
                    self._pieces, self._older_pieces = {}, self._pieces
                self._pieces[text] = known
        return known

    def prefixes(self, text: str) -> np.ndarray:
        """``out[i]``: tokens of the first i code points, as if the text ended there; ``out[-1]`` is the text's count.

        A cut inside a piece leaves a shorter piece of the same kind, but for two kinds:
        white space at the end of a text is one piece with the blank that would have gone
        to the next word, and an apostrophe without its ending is a sign before letters.
        """
        runs, n, before, tail = [np.zeros(1, np.int64)], 0, 0, ""
        for part, special in self._parts(text):
            if special:  # as long as its end is missing it is ordinary text, behind what was before it
                runs.append(before + self._plain(tail + part[:-1])[len(tail) + 1:])
                n += 1
                runs.append(np.array([n]))
                before, tail = n, ""
            else:
                counts = self._plain(part)
                runs.append(n + counts[1:])
                before, tail = n, part
                n += int(counts[-1])
        return np.concatenate(runs)

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield text[at:m.start()], False
            yield m[0], True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def _plain(self, text: str) -> np.ndarray:
        """The table of a text without special strings."""
        pieces = self.pattern.findall(text)
        own = [self._pieces.get(p) or self.piece(p) for p in pieces]
        counts = np.zeros(len(text) + 1, np.int64)
        counts[1:] = np.frombuffer(b"".join(own), np.int32)
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        whole = np.cumsum(counts[ends])
        counts[ends[0] + 1 if len(ends) else 1:] += np.repeat(whole[:-1], np.diff(ends))
        for i in self._blanks(pieces, text):
            # a text that ends here has the sign and the piece before it as one
            both = np.frombuffer(self.piece(pieces[i - 1] + pieces[i][0]), np.int32)[-1]
            counts[ends[i - 1] + 1] = (whole[i - 2] if i > 1 else 0) + both
        return counts

    @staticmethod
    def _blanks(pieces: list[str], text: str) -> Iterator[int]:
        """Pieces that follow white space and begin with its last sign: a blank, or any other on its own."""
        if DOUBLE.search(text):
            for i in range(1, len(pieces)):
                if DOUBLE.match(pieces[i - 1][-1] + pieces[i][0]):
                    yield i


# -- Spark --------------------------------------------------------------------------------


def cut_at(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens (a longer prefix may have fewer tokens)."""
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def counted(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit, limit_chars.

    ``vocabulary`` is the path of a byte-level BPE JSON file; it is read on the driver
    and travels with the job. Special strings in a text count as one token.
    ``limit_chars`` is the length in code points of the longest prefix of at most
    ``limit`` tokens. A null text is empty and has no tokens. Repeated rows count each,
    rows without doc_id like others; other columns are not read. The table of a very long
    text is four bytes per code point, eight while it is put together. No rows give none.
    """
    return _tables(docs, vocabulary, [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType()),
                                      ("limit_chars", T.LongType())],
                   lambda text, counts: (len(text.encode()), int(counts[-1]), bool(counts[-1] > limit), cut_at(counts, limit)))


def prefix_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of ``docs``: doc_id and ``counts``, the tokens of every prefix from 0 code points to all."""
    return _tables(docs, vocabulary, [("counts", T.ArrayType(T.IntegerType()))], lambda text, counts: (counts.tolist(),))


def truncated(docs: DataFrame, vocabulary: str, budget: int) -> DataFrame:
    """Per row of ``docs``: doc_id, ``text`` cut to the longest prefix of at most ``budget`` tokens, its ``n_tokens``.

    A null text is empty.
    """
    def cut(text: str, counts: np.ndarray) -> tuple[str, int]:
        at = cut_at(counts, budget)
        return text[:at], int(counts[at])

    return _tables(docs, vocabulary, [("text", T.StringType()), ("n_tokens", T.LongType())], cut)


_ARROW = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


class Shipped:
    """A vocabulary file on its way to the tasks; a worker builds its tables once and keeps them for later tasks."""

    def __init__(self, content: str):
        self.content = content
        self.made: Vocabulary | None = None

    def vocabulary(self) -> Vocabulary:
        self.made = self.made or Vocabulary.read(self.content)
        return self.made


def _tables(docs: DataFrame, vocabulary: str, columns: Sequence[tuple[str, T.DataType]],
            answer: Callable[[str, np.ndarray], tuple]) -> DataFrame:
    """doc_id and what ``answer`` reads from each text's table."""
    prepare(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(Shipped(file.read()))  # one to two megabytes
    source = docs.select("doc_id", "text")
    names = ["doc_id", *(c for c, _ in columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = shipped.value.vocabulary()
            rows = [answer(t or "", known.prefixes(t or "")) for t in batch.column("text").to_pylist()]
            if rows:
                answers = [pa.array(c, _ARROW[t.simpleString()]) for c, (_, t) in zip(zip(*rows), columns)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *answers], names=names)

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *(T.StructField(c, t) for c, t in columns)]))
