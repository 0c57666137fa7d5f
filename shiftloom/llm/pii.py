"""Personal data: fixed patterns, and what a skip-chain CRF adds to them.

Mentions (numbers, addresses) are the nodes of a conditional random field per document.
Neighbouring mentions share an edge, and so do mentions that repeat each other: the same
digits written in another way, the same mailbox spelled out. Loopy belief propagation
over both kinds of edges lets a mention that a pattern recognises speak for its
repetitions, however far away they stand.

Weights are fitted by pseudo-likelihood on a bounded sample of documents
(:data:`SAMPLE`), whose labels are the patterns' matches.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.llm.frames import prepare

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1000  # documents the weights are fitted on, at most
SURE = 0.9  # probability from which a mention is added
LABELS = len(KINDS) + 1  # the last label: none
CERTAIN = 100.0  # what evidence adds to a label's weight

Span = tuple[str, int, int]
# features, keys and labels of a text's nodes, and how many of the first are neighbours
Example = tuple[np.ndarray, list[str], np.ndarray, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|\b[Aa][Tt]\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def octets(quad: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in quad.split("."))


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Around every @ in turn, so that no character is looked at twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            done = found.end()
        else:
            done = at
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and not overlapping within a kind."""
    if not _ANY.search(text):
        return []
    spans = list(emails(text))
    for m in _IP.finditer(text):
        if octets(m[0]):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = only_digits(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(only_digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# -- nodes ------------------------------------------------------------------------------

_NUMBER = re.compile(r"[+(]?[0-9][0-9().+-]*")
_AT = re.compile(r"@|\x20?[(\[]at[)\]]\x20?", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]+)*", re.I)
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\.?")
FEATURES = 23


def mentions(text: str) -> list[tuple[int, int]]:
    """Spans that may be personal data: runs of numeric words, and mailboxes in any spelling."""
    found: list[tuple[int, int]] = []
    done = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at.end()) if start < at.start() else None
        done = host.end() if host else at.end()
        if host:
            found.append((start, done))
    run: tuple[int, int] | None = None
    last = -2
    for m in re.finditer(r"(?<![^\x20\x09-\x0D])[+(]?[0-9][^\x20\x09-\x0D]*", text):
        word = m[0].rstrip(".,;:!?\"'")
        if not _NUMBER.fullmatch(word):
            continue
        start, end = m.start(), m.start() + len(word)
        alone = bool(_QUAD.fullmatch(word)) or len(only_digits(word)) >= 12
        if run and not alone and word[0] != "+" and start == last + 1 and text[last] == " ":
            run = (run[0], end)
        else:
            if run:
                found.append(run)
            run = (start, end)
        last = end if not alone and len(word) == len(m[0]) else -2
    if run:
        found.append(run)
    return sorted(s for s in found if "a" in (t := text[s[0]:s[1]].lower()) or "@" in t or _QUAD.fullmatch(t) or len(only_digits(t)) >= 7)


def key_of(mention: str) -> str:
    """Mentions with one key repeat each other."""
    low = mention.lower()
    if "@" in low or "at" in low:
        return "@" + re.split(r"@|\x20?[(\[]at[)\]]", low)[0].strip(" ([")
    if _QUAD.fullmatch(mention):
        return "." + mention.rstrip(".")
    digits = only_digits(mention)
    return digits if len(digits) >= 12 else digits[-7:]


def features(mention: str, evidence: int) -> np.ndarray:
    """``evidence``: label a pattern gives the mention, the last label for none."""
    f = np.zeros(FEATURES)
    digits = only_digits(mention)
    f[0] = 1
    f[1 + evidence] = 1
    n = len(digits)
    f[6 + (0 if n < 7 else 1 if n < 9 else 2 if n < 12 else 3 if n < 16 else 4 if n == 16 else 5 if n < 20 else 6)] = 1
    f[13] = "@" in mention
    f[14] = "a" in mention.lower() and "@" not in mention
    f[15] = mention[:1] == "+"
    f[16] = "(" in mention
    f[17] = "-" in mention
    f[18] = bool(_QUAD.fullmatch(mention)) and octets(mention.rstrip("."))
    f[19] = n >= 12 and luhn(digits)
    f[20] = " " in mention
    f[21] = "." in mention
    f[22] = bool(_QUAD.fullmatch(mention)) and not f[18]
    return f


class Document:
    """Nodes of a text, with their features, evidence and edges."""

    def __init__(self, text: str, base: list[Span]):
        self.spans = mentions(text)
        self.evidence = evidence_of(self.spans, base)
        words = [text[a:b] for a, b in self.spans]
        self.features = np.array([features(w, e) for w, e in zip(words, self.evidence)]).reshape(-1, FEATURES)
        self.keys = [key_of(w) for w in words]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return edges(self.keys)


def evidence_of(spans: list[tuple[int, int]], base: list[Span]) -> list[int]:
    """Per span the label of a match that overlaps it, the last label for none."""
    found = [LABELS - 1] * len(spans)
    for label, kind in enumerate(KINDS):
        own = sorted((a, b) for k, a, b in base if k == kind)
        starts = [a for a, _ in own]
        for i, (a, b) in enumerate(spans):
            before = bisect_left(starts, b) - 1
            if before >= 0 and own[before][1] > a and found[i] == LABELS - 1:
                found[i] = label
    return found


def edges(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Chain edges, and skip edges from each mention to its next repetition."""
    chain = [(i, i + 1) for i in range(len(keys) - 1)]
    skip, last = [], {}
    for i, key in enumerate(keys):
        if key in last:
            skip.append((last[key], i))
        last[key] = i
    return np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)


# -- the field --------------------------------------------------------------------------

class Field:
    """Weights: features x labels, and label x label for chain and skip edges."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(
        self, x: np.ndarray, chain: np.ndarray, skip: np.ndarray, evidence: list[int], rounds: int = 30, damp: float = 0.5,
    ) -> np.ndarray:
        """Label probabilities by loopy sum-product; messages are normalised and damped.

        A mention with evidence keeps that label: the patterns are not doubted.
        """
        local = x @ self.unary
        for i, label in enumerate(evidence):
            local[i, label] += CERTAIN if label < LABELS - 1 else 0
        pairs = np.concatenate((chain, skip))
        potential = np.concatenate((np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)))
        source = np.concatenate((pairs[:, 0], pairs[:, 1]))
        target = np.concatenate((pairs[:, 1], pairs[:, 0]))
        potential = np.concatenate((potential, potential.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(pairs), 2 * len(pairs)), np.arange(len(pairs))))
        message = np.zeros((len(source), LABELS))
        belief = local
        for _ in range(rounds):
            out = belief[source] - message[back]
            new = np.logaddexp.reduce(out[:, :, None] + potential, axis=1) if len(source) else message
            new -= new.max(axis=1, keepdims=True) if len(source) else 0
            change = np.abs(new - message).max() if len(source) else 0
            message = damp * message + (1 - damp) * new
            belief = local.copy()
            np.add.at(belief, target, message)
            if change < 1e-4:
                break
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    @classmethod
    def fit(cls, examples: list[Example], steps: int = 2000, rate: float = 1.0, decay: float = 1e-5) -> Field:
        """By pseudo-likelihood: each label given its features and its neighbours' labels."""
        rows, labels = [], []
        eye = np.eye(LABELS)
        for x, keys, y, chained in examples:
            near, far = np.zeros((len(y), LABELS)), np.zeros((len(y), LABELS))
            for pairs, side in zip((edges(keys[:chained])[0], edges(keys)[1]), (near, far)):
                for i, j in pairs:
                    side[i] += eye[y[j]]
                    side[j] += eye[y[i]]
            rows.append(np.hstack((x, near, far)))
            labels.append(y)
        x = np.vstack(rows) if rows else np.zeros((0, FEATURES + 2 * LABELS))
        y = np.concatenate(labels) if rows else np.zeros(0, np.int64)
        w, speed = np.zeros((x.shape[1], LABELS)), np.zeros((x.shape[1], LABELS))
        for _ in range(steps if len(y) else 0):
            p = x @ w
            p = np.exp(p - p.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            speed = 0.9 * speed - rate * (x.T @ p / len(y) + decay * w)
            w += speed
        near, far = w[FEATURES:FEATURES + LABELS], w[FEATURES + LABELS:]
        if not len(y):
            w[1 + LABELS - 1, LABELS - 1] = 10.0  # nothing learned: add nothing
        return cls(w[:FEATURES], (near + near.T) / 2, (far + far.T) / 2)


def disguised(kind: str, text: str) -> str:
    """The same datum in a spelling that the patterns miss."""
    if kind == "phone":
        return re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", text) or text
    if kind == "email":
        return text.replace("@", " (at) ")
    return text


def broken(kind: str, text: str) -> str:
    """Much the same, but no personal data: a check digit or an octet is wrong."""
    if kind == "card":
        return text[:-1] + str((int(text[-1]) + 1) % 10)
    if kind == "ip":
        return "999" + text[text.index("."):]
    return disguised(kind, text)


def examples(texts: list[str]) -> list[Example]:
    """Labelled nodes of the sample.

    Each text's matches are repeated once in a spelling without evidence, under the same
    label: that is what a skip edge is to carry. The matches of the text before stand
    there as well, broken or in a spelling without evidence, and without a partner:
    nothing says that these are personal data, so their label is none.
    """
    found, before = [], []
    none = LABELS - 1
    for text in texts:
        base = base_spans(text)
        document = Document(text, base)
        x, keys, y = list(document.features), list(document.keys), list(document.evidence)
        own = [(k, text[a:b]) for k, a, b in base]
        more = [(disguised(*o), KINDS.index(o[0])) for o in own]
        more += [(words, none) for words in (broken(*o) for o in before) if key_of(words) not in keys]
        for words, label in more:
            x.append(features(words, none))
            keys.append(key_of(words))
            y.append(label)
        before = own
        if y:
            found.append((np.array(x), keys, np.array(y), len(document.keys)))
    return found


def spans_of(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and these with what the field adds."""
    base = base_spans(text)
    if not _ANY.search(text):
        return base, base
    document = Document(text, base)
    none = LABELS - 1
    if all(e != none for e in document.evidence):
        return base, base
    p = field.marginals(document.features, *document.edges(), document.evidence)
    added = [
        (KINDS[int(q[:none].argmax())], *s) for s, e, q in zip(document.spans, document.evidence, p)
        if e == none and q[:none].max() >= SURE
    ]
    return base, in_order(base + added)


# -- Spark ------------------------------------------------------------------------------

def fitted(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """A field fitted on ``sample`` documents with something like personal data in them.

    Which ones depends on hashes of the documents only.
    """
    some = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).where(
        F.col("text").rlike(r"@|\+[0-9]|[0-9]{7}|[0-9]\.[0-9]+\.[0-9]"))
    # hashes first: a text comes to the driver only if it is one of the sample
    hashes = [r["h"] for r in some.select("h").orderBy("h").limit(sample).collect()]
    if not hashes:
        return Field.fit([])
    last = F.lit(hashes[-1])
    rows = sorted(some.where(F.col("h") <= last).dropDuplicates(["h"]).select("h", "text").collect())
    return Field.fit(examples([r["text"] for r in rows]))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find(docs: DataFrame, *keep: str, field: Field | None = None) -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, ``base`` and ``spans``.

    Both are arrays of (kind, start, end) in code points, end exclusive, in order of
    start, then kind; ``base`` holds the patterns' matches, ``spans`` these and the ones
    added. A null text is empty and has none. Repeated rows are worked on each.
    """
    prepare(docs.sparkSession)
    source = docs.select(*keep, "text")
    field = field or fitted(docs)
    one = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(c, T.ArrayType(one)) for c in ("base", "spans"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of(t or "", field) for t in batch.column("text").to_pylist()]
            columns = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], SPANS) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, "base", "spans"])

    return source.mapInArrow(run, schema)


def digest(spans: str):
    one = F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the base matches by kind, a digest of them, and all spans as text."""
    found = find(docs, "doc_id")
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))
