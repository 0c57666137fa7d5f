"""Words of a text as bytes, and hashes of word spans by prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 22  # bytes of text worked on at a time
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so invertible modulo 2**64
MASK = (1 << 64) - 1

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 of a text column; null is an empty text."""
    return [t or b"" for t in batch.column(name).cast(pa.large_binary()).to_pylist()]


def word_blocks(data: bytes, overlap: int, size: int = BLOCK) -> Iterator[list[bytes]]:
    """Words of a text in lists of about ``size`` bytes.

    Each list begins with the last ``overlap`` words before it, so every run of
    ``overlap + 1`` words stands in exactly one list. A text without words gives one
    empty list.
    """
    held: list[bytes] = []
    at = 0
    while True:
        end = min(at + size, len(data))
        while end < len(data) and not (data[end] == 32 or 9 <= data[end] <= 13):
            end += 1
        words = held + data[at:end].split()
        yield words
        if end >= len(data):
            return
        held, at = words[len(words) - overlap:] if overlap and len(words) >= overlap else words if overlap else [], end


PUNCTUATION = "\"'`.,;:!?()[]{}<>|*_~#-–—‘’“”«»¡¿…"
_ASCII = bytes(32 if c < 128 and chr(c) in PUNCTUATION else c for c in range(256))
_WIDE = [c.encode() for c in PUNCTUATION if not c.isascii()]


def normal(data: bytes) -> bytes:
    """What is compared: lower case, and words without the punctuation around them."""
    if data.isascii():
        return data.lower().translate(_ASCII)
    data = data.decode("utf-8", "replace").lower().encode().translate(_ASCII)
    for c in _WIDE:
        data = data.replace(c, b" ")
    return data


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept per process, as long as the longest text."""
    known = _POWERS.get((base, 0))
    if known is None or len(known) < n:
        size = 1 << max(16, (n - 1).bit_length())
        known = np.empty(size, np.uint64)
        known[0], done = 1, 1
        while done < size:
            known[done:2 * done] = known[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        _POWERS[(base, 0)] = known
    return known


class Spans:
    """Hashes of word spans of one text, each in constant time.

    Words are joined by one space, so two spans hash alike when their words are the
    same, whatever stood between them. ``starts[i]``/``ends[i]`` are byte offsets of
    word i in ``joined``.
    """

    def __init__(self, words: list[bytes]):
        self.joined = b" ".join(words)
        codes = np.frombuffer(self.joined, np.uint8)
        gaps = np.flatnonzero(codes == 32)
        self.n = len(words)
        self.starts = np.concatenate(([0], gaps + 1)) if self.n else np.zeros(0, np.int64)
        self.ends = np.concatenate((gaps, [len(codes)])) if self.n else np.zeros(0, np.int64)
        self._codes = codes
        self._sums: dict[int, np.ndarray] = {}

    def hashes(self, first: np.ndarray, count: int | np.ndarray, which: int = 0) -> np.ndarray:
        """64-bit hashes of the spans of ``count`` words that begin at words ``first``."""
        base = BASES[which]
        if which not in self._sums:
            sums = np.empty(len(self._codes) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(self._codes * _powers(base, len(self._codes))[:len(self._codes)], out=sums[1:])
            self._sums[which] = sums
        sums = self._sums[which]
        a, b = self.starts[first], self.ends[first + count - 1]
        back = _powers(pow(base, -1, 1 << 64), len(self._codes) + 1)
        return mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))
