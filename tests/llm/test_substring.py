import hashlib
from collections import Counter

from shiftloom.llm import substring, words as w
from shiftloom.llm.catalog import SQL

from .helpers import corpus, frame, prose, words


def slow(rows, length):
    seen = Counter()
    for r in rows:
        x = words(r[1])
        seen.update(tuple(x[i:i + length]) for i in range(len(x) - length + 1))
    out = []
    for r in rows:
        x = words(r[1])
        gone = {p for i in range(len(x) - length + 1) if seen[tuple(x[i:i + length])] > 1 for p in range(i, i + length)}
        kept = " ".join(t for i, t in enumerate(x) if i not in gone)
        out.append((r[0], len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def found(df, **kw):
    rows = substring.remove_repeats(df, "doc_id", **kw).collect()
    for r in rows:
        assert sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"]
    return sorted(repr((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest())) for r in rows)


def test_equal_to_brute_force(spark):
    import random

    rng = random.Random(9)
    rows = corpus(9)
    rows.append((1000, "x " * 100, "en", "a", 1))  # repeats itself at every place
    rows.append((1001, prose(rng, 40) + " " + rows[7][1][-200:] + " " + prose(rng, 10), "en", "a", 1))
    shared = prose(rng, 80).split()
    rows += [(1100 + i, " ".join(shared[i:i + 40]), "en", "a", 1) for i in range(12)]  # shifted overlaps of one passage
    df = frame(spark, rows).withColumnRenamed("lang", "k1").withColumnRenamed("n_chars", "runs")
    assert found(df) == slow(rows, 35)
    assert found(df, length=12, gram=4) == slow(rows, 12)


def test_long_texts_in_blocks(spark, monkeypatch):
    import random

    from pyspark import cloudpickle

    rng = random.Random(2)
    passage = prose(rng, 90)
    rows = [(i, prose(rng, 300 + i) + " " + passage + " " + prose(rng, 200), "en", "a", 1) for i in range(3)]
    blocks = w.word_blocks
    monkeypatch.setattr(substring, "word_blocks", lambda data, overlap: blocks(data, overlap, 300))
    cloudpickle.register_pickle_by_value(__import__("tests.llm.test_substring", fromlist=["x"]))
    assert found(frame(spark, rows)) == slow(rows, 35)


def test_no_rows(spark):
    assert substring.remove_repeats(frame(spark, []), "doc_id").collect() == []


def test_sql_is_whole():
    assert "LIMIT" not in SQL["op3_substring"].upper()
