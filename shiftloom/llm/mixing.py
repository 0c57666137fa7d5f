"""Mixing to target weights by iterative proportional fitting, as column expressions.

Tokens are counted per cell (source, lang, topic). Raking multiplies the cells' weights
in turn so that the totals per source, per language and per topic meet their targets,
and never lets a cell weigh more than the tokens it has. Values that have less than their
target are taken whole, and the others share what they lack. A cell's probability is
weight over tokens; each document is drawn by a hash of itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.llm.frames import prepare, shielded, written

# Target share of a value: proportional to its share in the data to this power.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}
DIMS = list(POWERS)
CELL = {"source": "__source", "lang": "__lang", "topic": "__topic"}
KEYS = list(CELL.values())
TOLERANCE = 5e-3  # a round that moves no weight by more is the last
ROUNDS = 25
SLACK = 0.95  # of what the scarcest value allows; near 1 raking only creeps up to the caps
KEEP = 2 / 3  # of all tokens are taken at least, however little the scarcest value allows
SEED = 7


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, pages with contact data, everything else."""
    return (
        F.when(text.contains(" | "), F.lit("table"))
        .when(text.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]"), F.lit("contact"))
        .otherwise(F.lit("prose"))
    )


def _keyed(docs: DataFrame, topic: Column | None) -> DataFrame:
    topic = topic_of(F.coalesce("text", F.lit(""))) if topic is None else topic
    return docs.withColumns({"__source": F.col("source"), "__lang": F.col("lang"), "__topic": topic, "__tokens": tokens_of(F.col("text"))})


def tokens_of(text: Column) -> Column:
    """Words of a text and its end: one at least."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def targets(cells: DataFrame, powers: dict[str, float]) -> dict[str, DataFrame]:
    """Per dimension its values with ``have`` (tokens) and ``share`` (target share)."""
    found = {}
    for dim, power in powers.items():
        have = cells.groupBy(F.col(CELL[dim]).alias("value")).agg(F.sum("tokens").alias("have"))
        weight = F.pow(F.col("have").cast("double"), F.lit(power))
        total = have.agg(F.sum(weight)).first()[0] or 1.0
        found[dim] = written(have.withColumn("share", weight / F.lit(total)), f"target-{dim}")
    return found


def budget_of(aims: dict[str, DataFrame]) -> float:
    """Tokens to take in all: :data:`SLACK` of what the scarcest value allows, but :data:`KEEP` of all tokens at least."""
    found = [aim.agg(F.min(F.col("have") / F.col("share")), F.sum("have")).first() for aim in aims.values()]
    return max(SLACK * min((f[0] or 0.0) for f in found), KEEP * max((f[1] or 0) for f in found))


def dues(aim: DataFrame, budget: float) -> DataFrame:
    """``aim`` with ``due``, tokens to take of a value, and ``scarce``: it has too few and is taken whole.

    What scarce values lack is added to the others in proportion to their shares; that
    may make further ones scarce.
    """
    level, known = budget, 0
    while True:
        scarce = F.col("have") < F.col("share") * level
        n, taken, free = aim.agg(
            F.count_if(scarce), F.sum(F.when(scarce, F.col("have"))), F.sum(F.when(scarce, 0.0).otherwise(F.col("share")))).first()
        if n == known or not free:
            return aim.withColumn("scarce", scarce).withColumn("due", F.least(F.col("share") * level, F.col("have").cast("double")))
        level, known = (budget - taken) / free, n


def rake(cells: DataFrame, aims: dict[str, DataFrame], tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``weight``: tokens to take, at most those the cell has.

    ``aims`` holds per dimension ``value``, ``have`` and ``share``. Cells of a scarce
    value are taken whole; the others are raked to what is left of their targets.
    """
    budget = budget_of(aims)
    for dim, aim in aims.items():
        due = dues(aim, budget).select(F.col("value").alias("__value"), F.col("due").alias(f"__due_{dim}"), F.col("scarce").alias(f"__scarce_{dim}"))
        cells = cells.join(due, F.col(CELL[dim]).eqNullSafe(F.col("__value"))).drop("__value")
    whole = F.greatest(*[F.col(f"__scarce_{dim}") for dim in aims])
    cells = written(cells.withColumn("__whole", whole).withColumn("weight", F.col("tokens").cast("double")), "weights")
    for _ in range(rounds):
        step = cells.withColumn("__old", F.col("weight"))
        for dim in aims:
            fixed = F.sum(F.when(F.col("__whole"), F.col("weight")).otherwise(0.0)).alias("__fixed")
            free = F.sum(F.when(F.col("__whole"), 0.0).otherwise(F.col("weight"))).alias("__sum")
            total = step.groupBy(F.col(CELL[dim]).alias("__value")).agg(free, fixed)
            left = F.greatest(F.col(f"__due_{dim}") - F.col("__fixed"), F.lit(0.0))
            step = step.join(total, F.col(CELL[dim]).eqNullSafe(F.col("__value"))).withColumn("weight", F.when(
                F.col("__whole") | (F.col("__sum") == 0), F.col("weight")
            ).otherwise(F.least(F.col("weight") * left / F.col("__sum"), F.col("tokens").cast("double")))).drop("__value", "__sum", "__fixed")
        cells = written(step, "weights")
        change = cells.agg(F.max(F.abs(F.col("weight") - F.col("__old")) / F.when(F.col("__old") > 0, F.col("__old")))).first()[0]
        if change is None or change <= tolerance:
            break
    return cells


def _raked(keyed: DataFrame, powers: dict[str, float]) -> tuple[DataFrame, dict[str, DataFrame]]:
    cells = keyed.groupBy(*KEYS).agg(F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    cells = written(cells, "cells")
    aims = targets(cells, powers)
    return rake(cells, aims), aims


def marginals(docs: DataFrame, topic: Column | None = None, powers: dict[str, float] | None = None, within: float = 0.01) -> DataFrame:
    """Per dimension and value: have, target and taken (tokens), and whether the target is met up to ``within``."""
    prepare(docs.sparkSession)
    cells, aims = _raked(_keyed(docs, topic), powers or POWERS)
    budget, found = budget_of(aims), None
    for dim, aim in aims.items():
        taken = cells.groupBy(F.col(CELL[dim]).alias("__value")).agg(F.sum("weight").alias("taken"))
        target = F.col("share") * budget
        part = aim.join(taken, F.col("value").eqNullSafe(F.col("__value"))).select(
            F.lit(dim).alias("dim"), F.col("value").cast("string").alias("value"), "have", target.alias("target"), "taken",
            (F.abs(F.col("taken") - target) <= within * target).alias("met"))
        found = part if found is None else found.unionByName(part)
    return found


def _drawn(keyed: DataFrame, powers: dict[str, float] | None) -> DataFrame:
    weights = _raked(keyed, powers or POWERS)[0].select(
        *[F.col(k).alias(f"{k}_") for k in KEYS], (F.col("weight") / F.col("tokens")).alias("__p"))
    joined = keyed.join(weights, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in KEYS], "left")
    return joined.withColumn("__drawn", F.col("__u") < F.col("__p"))


def _chance(seed: int) -> Column:
    """A number in [0, 1) for each document: 53 bits of a hash, which a double holds exactly."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11).cast("double") / float(1 << 53)


def drawn(docs: DataFrame, topic: Column | None = None, powers: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with __topic, __tokens, __p (probability) and __drawn.

    Null sources, languages and topics are values like others; a null text has one
    token, its end. Rows alike in doc_id and text are drawn alike. An empty table gives
    an empty one.
    """
    prepare(docs.sparkSession)
    return _drawn(_keyed(docs, topic).withColumn("__u", _chance(seed)), powers)


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, source, lang, topic, tokens, probability, selected. Texts are read once."""
    prepare(docs.sparkSession)
    keyed = _keyed(docs.select("doc_id", "text", "source", "lang"), None).withColumn("__u", _chance(SEED))
    return _drawn(written(keyed.drop("text"), "measured"), None).select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
        F.col("__p").alias("probability"), F.col("__drawn").alias("selected"))


@shielded
def mix(docs: DataFrame, topic: Column | None = None, powers: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that were drawn, with all their columns."""
    return drawn(docs, topic, powers, seed).where("__drawn").select(*docs.columns)
