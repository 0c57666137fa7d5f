import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftloom.llm import infill

from .helpers import corpus, frame

SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    t, n = text or "", len(text or "")
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, SHA(t), SHA(t))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = t[:a], t[a:b], t[b:]
    out = f"<S>{suf}<P>{pre}<M>{mid}" if h4 % 100 < 20 else f"<P>{pre}<S>{suf}<M>{mid}"
    return (doc_id, n, "spm" if h4 % 100 < 20 else "psm", a, b - a, SHA(out), SHA(t))


def test_report_equals_brute_force(spark):
    rows = corpus(3, 80) + [
        (1000, "é漢🙂" * 4000, "en", "a", 1), (1001, "has <P> inside", "en", "a", 1), (1002, "a<S" * 50, "en", "a", 1),
        (1003, "<" * 9000 + ">", "en", "a", 1), (1004, "x" * 300_000 + "🙂", "en", "a", 1), (1005, "🙂", "en", "a", 1),
    ] + [(2000 + i, "über <M", "en", "a", 1) for i in range(200)]
    df = frame(spark, rows).withColumnRenamed("lang", "form").withColumnRenamed("source", "output").repartition(4)
    got = infill.report(df)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(brute(r[0], r[1])) for r in rows)
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}


def test_no_rows(spark):
    assert infill.report(frame(spark, [])).collect() == []


def begins(text, kind):
    """Code points at which units begin."""
    blank = " \t\n\x0b\x0c\r" if kind == "word" else "\n"
    if kind == "char":
        return list(range(len(text)))
    return [i for i in range(len(text)) if i == 0 or text[i - 1] in blank and (kind == "line" or text[i] not in blank)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\tab<é漢🙂", max_size=80), st.sampled_from(sorted(infill.UNITS)), st.integers(1, 9))
def test_every_unit_is_found(text, kind, block):
    units = infill.Units(text.encode(), kind, block)
    want = begins(text, kind)
    assert (units.n, units.chars) == (len(want), len(text))
    for k, at in enumerate([*want, len(text)]):
        assert units.begin(k) == (len(text[:at].encode()), at)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<PSM>aé \n", max_size=40), st.tuples(*[st.integers(0, 2**32 - 1)] * 4), st.sampled_from(sorted(infill.UNITS)))
def test_round_trip(text, draws, kind):
    n, form, first, middle, output = infill.transformed(text.encode(), draws, kind)
    assert infill.restored(output, form).decode() == text
    if form != "plain":
        mid = output.decode().split("<M>", 1)[1]
        assert len(mid) == middle and text[first:first + middle] == mid


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 100])
def test_fenwick(n):
    import numpy as np

    counts = np.random.default_rng(n).integers(0, 4, (n, 2))
    tree = infill.Fenwick(counts)
    for unit in range(int(counts[:, 0].sum())):
        block, before, points = tree.descend(unit)
        assert counts[:block, 0].sum() == before <= unit < before + counts[block, 0]
        assert points == counts[:block, 1].sum()
