import random

from shiftloom.llm.words import PUNCTUATION, normal


def plain(data):
    return data.decode("utf-8", "replace").lower().translate({ord(c): " " for c in PUNCTUATION}).encode()


def test_normal_is_lower_case_without_punctuation():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choice("aAÉéßİ–—“«…¿ñ\xa0 .,-_#\t\n日本") for _ in range(rng.randrange(12))).encode()
        broken = bytes(rng.randrange(256) for _ in range(6))
        assert normal(text) == plain(text) and normal(broken) == plain(broken)
    assert normal(b"") == b"" and normal(b"A-b") == b"a b"
