"""Small tables with every edge case, and what tests compare with."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, vocabulary=400):
    return " ".join("w%d" % int(vocabulary * rng.random() ** 2) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and one-word texts, odd spaces, repeated rows."""
    return [
        (None, "alone without an id", "en", "a", 1), (900, None, "en", "a", None), (901, "", None, None, 0),
        (902, "one", "de", None, 3), (903, " \t\n\x0b\f\r ", "en", "b", 6), (904, "a b c d", "fr", "b", 7),
        (905, "repeated row here", "en", "a", 2), (905, "repeated row here", "en", "a", 2),
    ]


def corpus(seed=1, n=60):
    """Prose with copies, near copies and shared passages, and the edge rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(5, 150)) for _ in range(n)]
    passage = prose(rng, 50)
    rows = []
    for i, t in enumerate(texts):
        if i % 10 == 3:
            t = texts[i - 1]
        if i % 10 == 5:
            words = texts[i - 1].split()
            words[len(words) // 2] = "changed"
            t = " ".join(words)
        if i % 10 == 7:
            t = t + " " + passage + " " + prose(rng, 20)
        rows.append((i, t, ("en", "de", "fr")[i % 3], "src%d" % (i % 4), len(t)))
    return rows + edge_rows()


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
