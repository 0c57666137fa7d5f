import random

import numpy as np

from shiftloom.llm import decontam

from .helpers import corpus, frame, prose

ITEMS = "item_id long, text string"


def planted():
    rng = random.Random(11)
    items = [(i, prose(rng, 30 + i, 5000)) for i in range(6)] + [(6, "four quite short words"), (7, None), (8, ""), (None, prose(rng, 25, 5000)), (0, "two")]
    rows = corpus(12)
    around = lambda t: prose(rng, 40, 5000) + " " + t + " " + prose(rng, 40, 5000)
    want = set()

    def add(doc_id, item, text):
        rows.append((doc_id, around(text), "en", "a", 1))
        want.add((doc_id, item))

    add(2000, 0, items[0][1])
    add(2001, 1, items[1][1].upper().replace(" ", ", "))
    x = items[2][1].split()
    for i in range(3, len(x), 7):
        x[i] = "other"
    add(2002, 2, " ".join(x))
    add(2003, 3, " ".join(items[3][1].split()[10:]))  # most of it
    add(2004, 6, "Four quite SHORT words!")
    add(2005, None, items[9][1])
    rows.append((2006, around(" ".join(items[4][1].split()[:8])), "en", "a", 1))  # too little
    y = items[5][1].split()
    rows.append((2007, around(" ".join(w if i % 2 else "other" for i, w in enumerate(y))), "en", "a", 1))  # too different
    rows.append((2008, items[0][1] + " " + prose(rng, 60000, 5000) + " " + items[1][1], "en", "a", 1))  # very long, both ends
    want |= {(2008, 0), (2008, 1)}
    return rows, items, want


def test_planted_passages_are_found_and_nothing_else(spark):
    rows, items, want = planted()
    df = frame(spark, rows).withColumnRenamed("lang", "row").withColumnRenamed("source", "item")
    got = decontam.report(df, frame(spark, items, ITEMS).repartition(3))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    kept = [r["doc_id"] for r in decontam.clean(df, frame(spark, items, ITEMS)).collect()]
    assert sorted(map(repr, kept)) == sorted(repr(r[0]) for r in rows if r[0] not in {w[0] for w in want})


def test_report_says_where(spark):
    items = [(1, " ".join(f"k{i}" for i in range(20)))]
    rows = [(5, "a b c " + items[0][1].replace("k7", "z") + " d", "en", "a", 1)]
    got = decontam.report(frame(spark, rows), frame(spark, items, ITEMS)).collect()
    assert [tuple(r) for r in got] == [(5, 1, 3, 20, 19)]


def test_no_rows(spark):
    none, items = frame(spark, []), frame(spark, [(1, "some words that nobody has")], ITEMS)
    assert decontam.report(none, items).collect() == []
    assert decontam.report(frame(spark, corpus(1)), frame(spark, [], ITEMS)).collect() == []
    assert decontam.clean(frame(spark, corpus(1)), frame(spark, [], ITEMS)).count() == len(corpus(1))


def test_masks_agree_on_equal_words_only():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 62, 40).astype(np.uint64)
    changed = words.copy()
    changed[20] += np.uint64(1)
    for mask, a, b in zip(decontam.MASKS, decontam.masked(words, decontam.MASKS), decontam.masked(changed, decontam.MASKS)):
        differ = {i for i in range(len(a)) if a[i] != b[i]}
        assert differ == {20 - j for j, used in enumerate(mask) if used == "1"}


def longest(same, min_share=0.8):
    n = len(same)
    return max((e - b for b in range(n) for e in range(b + 1, n + 1) if 10 * sum(same[b:e]) >= 10 * min_share * (e - b)), default=0)


def test_longest_passage_equals_brute_force():
    from itertools import combinations

    rng = random.Random(6)
    for n in range(5, 31):
        item = np.arange(n, dtype=np.uint64)
        changes = [c for k in (0, 1, 2) for c in combinations(range(n), k)] + [rng.sample(range(n), k) for k in range(3, n // 2) for _ in range(30)]
        for change in changes:
            text = np.concatenate((np.full(4, 1000, np.uint64), item, np.full(4, 1001, np.uint64)))
            text[[4 + c for c in change]] = 999
            same = [i not in set(change) for i in range(n)]
            got = decontam.passages(text, item, [4], 13, 0.8)
            want = longest(same)
            assert [g[2] for g in got] == ([want] if want >= min(13, n) else []), (n, change)
            assert all(g[0] == g[1] + 4 and g[3] == sum(same[g[1]:g[1] + g[2]]) >= 0.8 * g[2] for g in got)


def test_items_with_substitutions_at_all_places(spark):
    rng, items, rows, want = random.Random(9), [], [], set()
    for n in (5, 7, 9, 10, 11, 12, 13, 15, 20):
        item = [f"i{n}w{i}" for i in range(n)]
        items.append((n, " ".join(item)))
        for k in range(1, n // 5 + 2):
            for start in range(n):
                change = {start, *rng.sample(range(n), k - 1)} if k > 1 else {start}
                same = [i not in change for i in range(n)]
                rows.append((len(rows), " ".join(["a b c", *(w if s else "other" for w, s in zip(item, same)), "d e f"]), "en", "a", 1))
                if longest(same) >= min(13, n):
                    want.add((rows[-1][0], n))
    got = decontam.report(frame(spark, rows), frame(spark, items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want


def test_no_substitutions_hide_a_passage_from_windows_with_neighbours():
    from itertools import combinations

    for n in range(decontam.MIN_WORDS, decontam.REACH + 1):
        differ = np.array([sum(1 << i for i in c) for c in combinations(range(n), int(n * (1 - decontam.MIN_SHARE) + 1e-9))])
        for mask in decontam.MASKS:
            under = [i for i, used in enumerate(mask) if used == "1"]
            for at in range(n - len(mask) + 1):
                for a, b in decontam.neighbours(mask):
                    if at + a >= 0 and at + b < n:
                        key = sum(1 << at + i for i in (*under, a, b))
                        differ = differ[differ & key != 0]
        assert not len(differ), n


def brute(rows, items):
    """(row, item) with a passage, every text against every item at every shift."""
    found = set()
    for row, text in rows:
        t = decontam.word_hashes(decontam.normal(text.encode()).split())
        for item, x in items:
            i = decontam.word_hashes(decontam.normal(x.encode()).split())
            if len(i) >= decontam.SHORT and decontam.passages(t, i, list(range(-len(i), len(t) + 1)), decontam.MIN_WORDS, decontam.MIN_SHARE):
                found.add((row, item))
    return found


def test_shared_phrases_lose_no_passage(spark):
    rng = random.Random(31)
    phrase = "which of the following best describes the idea".split()
    items, docs = [], []
    for i in range(40):
        words = [*(f"w{rng.randrange(60)}" for _ in range(rng.randrange(3, 15))), *phrase, *(f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 25)))]
        items.append((i, " ".join(words)))
        for _ in range(3):
            start = rng.randrange(0, max(1, len(words) - 12))
            piece = list(words[start:start + rng.randrange(12, 30)])
            for p in rng.sample(range(len(piece)), min(len(piece), rng.randrange(0, 6))):
                piece[p] = rng.choice(["other", "w1", "w2"])
            docs.append((len(docs), " ".join([*(f"w{rng.randrange(60)}" for _ in range(rng.randrange(20))), *piece, "x", "y", *phrase, "z"])))
    df, it = spark.createDataFrame(docs, "row long, text string"), spark.createDataFrame(items, "item long, text string")
    want = brute(docs, items)
    assert len(want) > 40
    for hot in (0, 5, 1000):
        assert {(r["row"], r["item"]) for r in decontam.contaminated(df, it, hot=hot).collect()} == want, hot


def test_a_phrase_in_all_items_makes_no_product(spark, monkeypatch):
    n, phrase, seen = 300, "which of the following best describes", {}
    items = [(i, " ".join([*(f"a{i}x{k}" for k in range(12)), phrase, *(f"b{i}x{k}" for k in range(12))])) for i in range(n)]
    rows = [(i, " ".join([*(f"c{i}x{k}" for k in range(30)), phrase, *(f"d{i}x{k}" for k in range(30))]), "en", "a", 1) for i in range(n)]
    rows += [(n, f"so {items[3][1]} it", "en", "a", 1), (n + 1, " ".join(items[7][1].split()[9:22]), "en", "a", 1)]
    keep = decontam.written

    def counted(df, label):
        out = keep(df, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(decontam, "written", counted)
    got = decontam.report(frame(spark, rows), frame(spark, items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(n, 3), (n + 1, 7)}
    assert seen["pairs"] < n  # of n * n


def test_a_text_with_very_many_items(spark):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(15))) for i in range(300)]
    rows = [(1, " ".join(t for _, t in items), "en", "a", 1), (2, "nothing of it", "en", "a", 1)]
    assert sorted(r["item_id"] for r in decontam.report(frame(spark, rows), frame(spark, items, ITEMS)).collect()) == list(range(300))
