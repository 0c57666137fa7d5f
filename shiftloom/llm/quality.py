"""Quality rules with thresholds that follow the data of each language and source.

Every metric is sketched per (lang, source) in a KLL sketch; sketches of small groups
are merged to the language's and then to that of all documents. A document fails a rule
if its metric is far above what nine tenths of its group stay below, measured by the
distance from there to the median, or, where hardly any document shows the thing
counted, by what a single occurrence makes in a text of the group's median size: no
share is given as a number. Everything is column expressions: no Python runs in tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.frames import prepare, shielded, written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GRAM = 5
FEW_WORDS = 10
REPEAT_PERCENT = 20

SKETCH = 1024  # k of the sketches: ranks are right to about a third of a percent
GROUP = 200  # rows from which a group has thresholds of its own
MIDDLE, HIGH = 0.5, 0.9
SPREAD = 6.0  # distances, or occurrences, above the upper quantile
# (counted, out of, what one occurrence counts): a window that comes twice covers two times its words
METRICS = {
    "symbol_share": ("n_symbols", "word_chars", 1), "upper_share": ("n_upper", "word_chars", 1),
    "repeat_share": ("n_repeat_words", "n_words", 2 * GRAM), "line_share": ("n_dup_lines", "n_lines", 1),
}
SIZES = sorted({whole for _, whole, _ in METRICS.values()})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more."""

    def of_sorted(s: Column) -> Column:
        def alike(j: Column) -> Column:
            return F.coalesce(F.get(s, j)["x"] == F.get(s, j - 1)["x"], F.lit(False)) | F.coalesce(
                F.get(s, j)["x"] == F.get(s, j + 1)["x"], F.lit(False))

        every = F.sequence(F.lit(0), F.size(s) - 1)
        return F.sort_array(F.transform(F.filter(every, alike), lambda j: F.get(s, j)["i"]))

    def reach(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.coalesce(F.least(F.lit(GRAM), F.get(p, k + 1) - x), F.lit(GRAM)))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    pairs = F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        _let(_let(F.sort_array(pairs), of_sorted), reach))


def features(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words.

    A null text counts as empty. Lines count if they hold a word. Windows of five words
    are compared by 64-bit hashes within their text.
    """
    text = F.coalesce(text, F.lit(""))

    def count(w: Column) -> Column:
        last = F.size(w) - GRAM
        windows = F.when(last >= 0, F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(GRAM)))
        )).otherwise(F.array().cast("array<long>"))
        return F.struct(F.size(w).cast("long").alias("n_words"), _let(windows, _covered).cast("long").alias("n_repeat_words"))

    def lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.char_length(text)

    def left_by(chars: str) -> Column:
        return F.char_length(F.translate(text, chars, ""))

    return F.struct(
        _let(F.array_remove(F.split(text, SPACE), ""), count).alias("words"), _let(with_word, lines).alias("lines"),
        left_by(" \t\n\x0b\f\r").cast("long").alias("word_chars"), (n_chars - left_by(SYMBOLS)).cast("long").alias("n_symbols"),
        (n_chars - left_by(UPPER)).cast("long").alias("n_upper"),
    )


FIELDS = {
    "n_words": "words.n_words", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_dup_lines": "lines.n_dup_lines",
    "n_repeat_words": "words.n_repeat_words", "n_upper": "n_upper", "n_lines": "lines.n_lines",
}
Q, LIMITS = "__quality", "__limits"


def field(name: str) -> Column:
    return F.col(f"{Q}.{FIELDS[name]}")


def metric(name: str) -> Column:
    part, whole, _ = METRICS[name]
    return F.coalesce(F.try_divide(field(part).cast("double"), field(whole).cast("double")), F.lit(0.0))


def limits(scored: DataFrame, spread: float = SPREAD, group: int = GROUP) -> DataFrame:
    """Upper limit of every metric per (lang, source): the sketches' part.

    A group of fewer than ``group`` rows takes the limits of its language, a language of
    fewer than that those of all rows. A null language or source is a value like others.
    """
    own = scored.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(metric(m), F.lit(SKETCH)).alias(m) for m in METRICS],
        *[F.kll_sketch_agg_double(field(w).cast("double"), F.lit(SKETCH)).alias(w) for w in SIZES])
    own = written(own, "sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(SKETCH)).alias(m) for m in [*METRICS, *SIZES]]]
    langs = own.groupBy("lang").agg(*merged)
    every = own.agg(*merged)

    def quantile(name: str, rank: float) -> Column:
        chosen = F.when(F.col("o.n") >= group, F.col(f"o.{name}")).when(F.col("l.n") >= group, F.col(f"l.{name}")).otherwise(F.col(f"a.{name}"))
        return F.kll_sketch_get_quantile_double(chosen, F.lit(rank))

    def upper(m: str) -> Column:
        _, whole, one = METRICS[m]
        high, typical = quantile(m, HIGH), F.greatest(quantile(whole, MIDDLE), F.lit(1.0))
        return (high + spread * F.greatest(high - quantile(m, MIDDLE), one / typical)).alias(m)

    o, l = own.alias("o"), langs.alias("l")
    # the sketch of all rows is one row
    both = o.join(l, F.col("o.lang").eqNullSafe(F.col("l.lang"))).crossJoin(F.broadcast(every.alias("a")))
    return both.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), F.struct(*map(upper, METRICS)).alias(LIMITS))


def judged(docs: DataFrame, *keep: str, spread: float = SPREAD, group: int = GROUP) -> DataFrame:
    """Per row of ``docs``: the columns ``keep``, the features, ``base_failed`` and ``kept``.

    The features are those of :func:`features` under :data:`Q`. ``base_failed``: fewer
    than 10 words, or over 20 % of the words in repeated windows. ``kept``: not failed,
    and no metric above its group's limit; :data:`SPREAD` occurrences are none too many
    in any text. No row is lost or repeated; an empty table
    gives an empty one.
    """
    prepare(docs.sparkSession)
    held = dict.fromkeys([*keep, "lang", "source"])
    scored = written(docs.withColumn(Q, features(F.col("text"))).select(*held, Q), "features")
    found = written(limits(scored, spread, group), "limits").select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"), LIMITS)
    joined = scored.join(found, scored["lang"].eqNullSafe(found["__lang"]) & scored["source"].eqNullSafe(found["__source"]), "left")
    failed = (field("n_words") < FEW_WORDS) | (100 * field("n_repeat_words") > REPEAT_PERCENT * field("n_words"))
    kept = ~failed
    for m, (part, _, one) in METRICS.items():
        kept = kept & ((metric(m) <= F.col(f"{LIMITS}.{m}")) | (field(part) <= spread * one))
    return joined.select(*keep, Q, LIMITS, failed.alias("__failed"), kept.alias("__kept"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the limits that applied."""
    out = judged(docs.select("doc_id", "text", "lang", "source"), "doc_id")
    return out.select(
        "doc_id", *[field(n).alias(n) for n in FIELDS], F.col("__failed").alias("base_failed"), F.col("__kept").alias("kept"),
        *[F.col(f"{LIMITS}.{m}").alias(f"limit_{m}") for m in METRICS],
    )


@shielded
def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return judged(docs, *docs.columns).where("__kept").select(*docs.columns)
