import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftloom.llm import pii

from .helpers import corpus, frame

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def slow(text):
    def fits(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    found = [(m.start(), i, (k, m.start(), m.end())) for i, k in enumerate(PATTERNS) for m in re.finditer(PATTERNS[k], text) if fits(k, m[0])]
    return [f[2] for f in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.2+@- ()0é\n45%", max_size=60) | st.from_regex(r"(4111 1111 1111 1111|\+1 \(20|a@b\.c|1\.2\.3\.4|[ .@+x]){0,8}", fullmatch=True))
def test_patterns_as_written(text):
    assert pii.base_spans(text) == slow(text)


@pytest.fixture(scope="module")
def field():
    texts = []
    for i in range(80):
        texts.append(f"call +1 ({200 + i}) 555-{1000 + i * 7} or write user.{i}@mail{i % 7}.example.com now, order {3000000 + 911 * i} left")
        texts.append(f"host 10.{i}.3.{i + 1} paid with 4111111111111111 on 2024-01-{i % 28 + 1:02d} at 10:30 and 4111 1111 1111 1112")
    return pii.Field.fit(pii.examples(texts))


def added(text, field):
    base, spans = pii.spans_of(text, field)
    return [(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base]


def test_repetitions_take_the_label_however_far(field):
    assert added("+1 (988) 555-2485 " + "x " * 3000 + "(988) 555-2485", field) == [("phone", "(988) 555-2485")]
    assert added("bob.42@mail8.example.com, that is bob.42 (at) mail8.example.com", field) == [("email", "bob.42 (at) mail8.example.com")]


def test_alone_they_do_not(field):
    for text in ("(988) 555-2485", "order 3000911 and 98765432", "zed (at) mail.example.com", "999.1.1.1", "4111111111111112", "2024-01-15", ""):
        assert added(text, field) == []


def test_long_texts_in_linear_time(field):
    for text in ("1" * 300_000, "a." * 150_000 + "@", "1.1." * 60_000, "(at)" * 60_000, "+1" * 100_000, "4 " * 100_000):
        pii.spans_of(text, field)


def test_rows(spark, field):
    rows = corpus(5) + [(3000, "é +1 (988) 555-2485 é a@b.cd 1.2.3.4 é 4111-1111-1111-1111", "en", "a", 1)]
    df = frame(spark, rows).withColumnRenamed("lang", "base").withColumnRenamed("source", "spans")
    got = {r["doc_id"]: r for r in pii.report(df).collect()}
    assert len(got) == len({r[0] for r in rows})
    for doc_id, text, *_ in rows:
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in slow(text or ""))
        assert got[doc_id]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert [got[3000][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert pii.report(frame(spark, [])).collect() == []


def test_marginals_of_a_tree_are_exact():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    n, k = pii.LABELS, 4
    f = pii.Field(rng.normal(size=(pii.FEATURES, n)), rng.normal(size=(n, n)), rng.normal(size=(n, n)))
    x = rng.normal(size=(k, pii.FEATURES))
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[1, 3]])
    p = np.zeros((k, n))
    for y in itertools.product(range(n), repeat=k):
        w = np.exp(sum((x[i] @ f.unary)[y[i]] for i in range(k)) + f.chain[y[0], y[1]] + f.chain[y[1], y[2]] + f.skip[y[1], y[3]])
        for i in range(k):
            p[i, y[i]] += w
    p /= p.sum(1, keepdims=True)
    assert np.allclose(f.marginals(x, chain, skip, [n - 1] * k, rounds=200), p, atol=1e-3)
