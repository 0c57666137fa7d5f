"""Date layouts found from a whole column and not text by text.

``03/04/2024`` fits two layouts; the column it stands in, as a rule, fits one. One pass counts per
column and layout how many texts fit (counts add up over partitions and files); a
layout that all texts fit, where it is the only one, is the column's. Where several remain they
are reported, and the caller has to say which one holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.functions.dates import parse_date
from shiftloom.operators.projection import q
from shiftloom.sources import readers

LAYOUTS = ("yyyy-MM-dd", "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy")
CERTAIN, AMBIGUOUS, MIXED, UNKNOWN, EMPTY = "certain", "ambiguous", "mixed", "unknown", "empty"


class Undecided(ValueError):
    """Columns of which the texts do not say how their dates are written."""


def evidence(texts: DataFrame, columns: Sequence[str], layouts: Sequence[str] = LAYOUTS, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, column, layout, n, fits, excluded): how many texts there are and how many fit.

    One aggregation, combined before the shuffle; ``excluded`` is a text that does not
    fit, null if all do. Empty texts are not counted.
    """
    counts = []
    for c in columns:
        text = F.trim(q(c))
        there = F.coalesce(text != "", F.lit(False))
        for layout in layouts:
            fits = parse_date(text, layout).isNotNull()
            counts.append(F.struct(
                F.lit(c).alias("column"), F.lit(layout).alias("layout"), F.count_if(there).alias("n"), F.count_if(there & fits).alias("fits"),
                F.min(F.when(there & ~fits, text)).alias("excluded"),
            ))
    rows = texts.groupBy(*[q(b) for b in by]).agg(F.array(*counts).alias("a"))
    return rows.select(*[q(b) for b in by], F.inline("a"))


def verdicts(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, column, verdict, layouts): what the evidence says of each column.

    certain: all texts fit one layout and no other. ambiguous: several layouts fit all
    texts. mixed: no layout fits all texts, ``layouts`` are those that fit most. unknown:
    no text fits any. empty: there is no text. Layouts come in alphabetical order.
    """
    keys = [*by, "column"]
    best = F.max("fits").over(Window.partitionBy(*[q(k) for k in keys]))  # as many rows a column as there are layouts
    top = found.withColumn("best", best).where(F.col("fits") == F.col("best"))
    decided = top.groupBy(*[q(k) for k in keys]).agg(
        F.max("n").alias("n"), F.max("best").alias("best"), F.sort_array(F.collect_list("layout")).alias("layouts"))
    verdict = (
        F.when(F.col("n") == 0, EMPTY).when(F.col("best") == 0, UNKNOWN).when(F.col("best") < F.col("n"), MIXED)
        .when(F.size("layouts") > 1, AMBIGUOUS).otherwise(CERTAIN)
    )
    none = F.array().cast("array<string>")
    return decided.select(*[q(k) for k in keys], verdict.alias("verdict"),
                          F.when(F.col("best") == 0, none).otherwise(F.col("layouts")).alias("layouts"))


@dataclass(frozen=True)
class Feed:
    """A typed feed, the layout of each of its date columns, and what was said of them."""

    rows: DataFrame
    layouts: Mapping[str, str]
    verdicts: Mapping[str, str]


def conform_by_layout(texts: DataFrame, columns: Mapping[str, str], layouts: Sequence[str] = LAYOUTS,
                      assume: Mapping[str, str] | None = None) -> Feed:
    """``{column: type}`` of a frame of texts, every date column read in one layout of its own.

    The driver sees one row per column. ``assume`` says what holds where the texts leave
    it open (it may not contradict them). A column without texts needs no layout. Texts
    that do not fit their column's layout become null, as misfits do; a mixed column is
    read in the layout most texts fit, if that is one.
    """
    dates, told = [c for c, t in columns.items() if t == "date"], dict(assume or {})
    if not dates:
        return Feed(readers.conform(texts, columns), {}, {})
    found = {r["column"]: r for r in verdicts(evidence(texts, dates, layouts)).collect()}
    chosen, open_columns = {}, {}
    for c in dates:
        fitting = found[c]["layouts"]
        if c in told and fitting and told[c] not in fitting:
            raise Undecided(f"{c} is not written as {told[c]}; its texts fit {fitting}")
        if len(fitting) == 1 or c in told:
            chosen[c] = told.get(c) or fitting[0]
        elif found[c]["verdict"] == EMPTY:
            chosen[c] = layouts[0]
        else:
            open_columns[c] = (found[c]["verdict"], fitting)
    if open_columns:
        raise Undecided(f"say how these columns are written: {open_columns}")
    rest = [c for c in texts.columns if c == "ingest_seq" and c not in columns]
    typed = [parse_date(F.trim(q(c)), chosen[c]) if t == "date" else readers.typed(q(c), t) for c, t in columns.items()]
    rows = texts.select(*[v.alias(c) for c, v in zip(columns, typed)], *rest)
    return Feed(rows, chosen, {c: found[c]["verdict"] for c in dates})
