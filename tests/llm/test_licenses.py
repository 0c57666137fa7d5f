import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftloom.llm import licenses
from shiftloom.llm.licenses import Scanner, Template, best
from shiftloom.llm.words import normal

from .helpers import corpus, frame, prose

WORDING = {(t.license, t.form): t.text.replace("{{", "").replace("}}", "") for t in licenses.WORDINGS}
SCANNER = Scanner(licenses.TEMPLATES, licenses.MIN_COVERAGE)


def found(spark, rows, **kw):
    df = frame(spark, rows).withColumnRenamed("lang", "license").withColumnRenamed("source", "coverage")
    return sorted(((r["doc_id"], r["license"], r["form"], r["first_word"], r["n_words"], round(r["coverage"], 2)) for r in
                   licenses.scan(df, "doc_id", **kw).collect()), key=repr)


def names(text, scanner=SCANNER):
    return [(f.license, f.form) for f in best(scanner.scan(normal(text.encode()).split()))]


def test_planted(spark):
    rng = random.Random(3)
    mit, apache = WORDING["MIT", "text"], WORDING["Apache-2.0", "notice"]
    line = "Released under the MIT License."
    rows = corpus(3) + [
        (100, prose(rng, 20) + "\n" + line + "\n" + prose(rng, 9) + " " + line, "en", "a", 1),
        (101, prose(rng, 5) + " " + mit.replace("sublicense", "lend").upper() + " " + prose(rng, 50), "en", "a", 1),
        (102, " ".join(mit.split()[:40]), "en", "a", 1), (103, "the license of the software under the version", "en", "a", 1),
        (104, prose(rng, 70000) + " " + apache, "en", "a", 1),
        (105, line * 3, "en", "a", 1),
    ]
    got = found(spark, rows)
    assert [g[:4] for g in got if g[0] == 100] == [(100, "MIT", "line", 20), (100, "MIT", "line", 34)]
    assert [g[1:4] for g in got if g[0] == 101] == [("MIT", "text", 5)]
    assert [g[1:4] for g in got if g[0] == 104] == [("Apache-2.0", "notice", 70000)]
    assert sorted(g[3] for g in got if g[0] == 105) == [0, 5, 10]
    assert {g[0] for g in got} == {100, 101, 104, 105}


def test_no_rows_and_empty_templates(spark):
    assert found(spark, []) == []
    nothing = [Template("none", "text", ""), Template("dots", "text", "..."), Template("twice", "text", "ab ab")]
    assert found(spark, corpus(1), templates=nothing) == []


@pytest.mark.parametrize("text, license", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
    ("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
    ("Released under the BSD License", "BSD"), ("Released under the BSD 2-Clause License", "BSD-2-Clause"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Licensed under the Apache License, Version 1.1.", None),
    ("Licensed under CC BY-NC 2.0.", None), ("Released under the Zope License", None),
    ("// SPDX-License-Identifier: LGPL-2.1", "LGPL-2.1"), ("SPDX-License-Identifier: GPL-3.0", "GPL-3.0"),
])
def test_names_and_versions_decide(text, license):
    assert [n for n, _ in names(text)] == ([license] if license else [])


def test_every_template_is_found_as_itself():
    for t in licenses.TEMPLATES:
        text = t.text.replace("{{", "").replace("}}", "")
        assert {n for n, _ in names("some words before " + text + " and some after")} == {t.license}, text


def test_clauses_decide():
    three = WORDING["BSD-3-Clause", "text"]
    assert names(three) == [("BSD-3-Clause", "text")]
    assert names(three.replace("the copyright holder nor", "the University nor")) == [("BSD-3-Clause", "text")]
    assert names(WORDING["BSD-2-Clause", "text"]) == [("BSD-2-Clause", "text")]


def test_neighbouring_licenses_are_told_apart():
    text = " ".join(["Released under the MIT License. Licensed under the Apache License, Version 2.0.", WORDING["ISC", "text"],
                     "This work is licensed under the GNU General Public License, version 3.", WORDING["MIT", "text"]])
    assert names(text) == [("MIT", "line"), ("Apache-2.0", "line"), ("ISC", "text"), ("GPL-3.0", "line"), ("MIT", "text")]


def test_templates_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("You may {{bake and sell}}\nthis bread, crumbs included, anywhere.")
    templates = licenses.templates_in(spark, str(tmp_path))
    assert [(t.license, t.form) for t in templates] == [("Own-1.0", "text")]
    rows = [(1, "x y you may bake and sell this bread, crumbs included, anywhere", "a", "b", 1), (2, "you may bake or sell this bread, crumbs included, anywhere", "a", "b", 1)]
    assert found(spark, rows, templates=templates) == [(1, "Own-1.0", "text", 2, 10, 1.0)]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def test_brute_force_over_all_windows():
    """Every window against every template by a common subsequence: the same licenses, whatever the edits."""
    rng = random.Random(8)
    templates = [Template("a", "t", "alpha beta gamma delta {{omega one}} epsilon zeta eta theta"),
                 Template("b", "t", "quick brown foxes jump over lazy dogs every single morning before breakfast time"),
                 Template("c", "t", "north east {{south west}} winds")]
    scanner = Scanner(templates, 0.8)
    hits = 0
    for _ in range(400):
        words, planted = prose(rng, rng.randint(0, 12)).split(), rng.sample(templates, rng.randint(0, 3))
        for t in planted:
            own = t.text.replace("{{", "").replace("}}", "").split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(own))
                own[k:k + 1] = rng.choice([[], ["other"], [own[k], "added"]])
                own = own or ["other"]
            words += own + prose(rng, rng.randint(0, 12)).split()
        expected = set()
        for shape in scanner.shapes:
            reach = shape.size + shape.size // 2
            for s in range(len(words)):
                window = [w.encode() for w in words[s:s + reach]]
                pieces = [shape.words[p.start:p.stop] for p in shape.pieces]
                whole = all(any(window[i:i + len(p)] == p for i in range(len(window))) for p in pieces)
                if whole and longest_common(window, shape.words) >= shape.least:
                    expected.add(shape.license)
        hits += len(expected)
        assert {f.license for f in scanner.scan([w.encode() for w in words])} == expected, words
    assert hits > 200


def test_increasing():
    values = [3, 1, 4, 1, 5, 9, 2, 6]
    chain = [values[i] for i in licenses.increasing(values)]
    assert len(chain) == 4 and chain == sorted(set(chain))
    assert licenses.increasing([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=14), st.lists(st.sampled_from("abcdefgh"), max_size=14))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)
