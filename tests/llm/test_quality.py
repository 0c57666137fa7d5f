import random
from collections import Counter

from shiftloom.llm import quality

from .helpers import WORD, corpus, frame, prose, words


def slow(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for p in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def junk():
    rng = random.Random(4)
    good = [prose(rng, 60) + ".\n" + prose(rng, 30) + "." for _ in range(300)]
    return [
        *((i, t, "en", "a", 1) for i, t in enumerate(good)),
        (1000, " ".join(w + "%%%" for w in good[0].split()), "en", "a", 1), (1001, good[1].upper().replace("W", "WORDS"), "en", "a", 1),
        (1002, (prose(rng, 12) + "\n") * 9, "en", "a", 1), (1003, "too short", "en", "a", 1),
        (1004, "a b c d e a b c d e a b c d e f g h i j k\n\n \nx\nx\r\nx", "en", "a", 1), (1005, "ÄÖ é # | <x> " * 4, "de", "b", 1),
    ]


def test_counts_equal_brute_force(spark):
    rows = corpus(2) + junk()
    df = frame(spark, rows).withColumnRenamed("n_chars", "n_words")
    got = quality.report(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], *slow(r[1]))) for r in rows)


def test_thresholds_follow_the_data(spark):
    rows = junk()
    kept = {r["doc_id"] for r in quality.report(frame(spark, rows)).where("kept").collect()}
    assert set(range(300)) <= kept and not kept & {1000, 1001, 1002, 1003, 1004}
    # where every text has symbols, they are ordinary
    many = [(i, " ".join(w + "#" * (1 + i % 3) for w in prose(random.Random(i), 40).split()), "en", "b", 1) for i in range(400)]
    assert {r["doc_id"] for r in quality.report(frame(spark, rows + many)).where("kept and doc_id < 400").collect()} >= set(range(300, 400))


def test_filter_keeps_columns_and_rows(spark):
    df = frame(spark, corpus(2)).withColumnRenamed("n_chars", "kept")
    out = quality.keep_good(df)
    assert out.columns == df.columns
    want = [r[0] for r in corpus(2) if not slow(r[1])[-1]]
    assert sorted(map(repr, (r["doc_id"] for r in out.collect()))) == sorted(map(repr, want))
    assert quality.keep_good(frame(spark, [])).collect() == []


def test_no_python_in_tasks(spark):
    plan = quality.keep_good(frame(spark, corpus(2)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_limits_move_with_groups_in_which_most_have_none(spark):
    rng = random.Random(9)
    plain = [prose(rng, 80) + ".\n" + prose(rng, 40) + "." for _ in range(600)]
    tables = ["\n".join(" | ".join(prose(rng, 1) for _ in range(6)) + f" | {i}" for i in range(20)) for _ in range(80)]
    rows = [
        *((i, t, "en", "plain", 1) for i, t in enumerate(plain[:300])), *((300 + i, t, "en", "tables", 1) for i, t in enumerate(plain[300:])),
        *((1000 + i, t, "en", "tables", 1) for i, t in enumerate(tables[1:])), (2000, tables[0], "en", "plain", 1),
        # a few symbols say nothing, in short texts and long ones
        (2001, plain[0] + " $ & #", "en", "plain", 1), (2002, "one two three four five six seven eight nine ten % & $", "en", "plain", 1),
    ]
    got = {r["doc_id"]: r for r in quality.report(frame(spark, rows)).collect()}
    assert {i for i, r in got.items() if not r["kept"]} == {2000}
    # a fifth of the documents being tables, tables are what the source holds
    assert got[1000]["limit_symbol_share"] > 10 * got[2000]["limit_symbol_share"] > 0
    # longer texts, finer limits
    longer = quality.report(frame(spark, [(r[0], (r[1] + "\n") + prose(rng, 600), *r[2:]) for r in rows[:300]])).first()
    assert 0 < longer["limit_symbol_share"] < got[0]["limit_symbol_share"] / 3
