"""Business rules as a table: any number of rules, one equality join.

A rule has a priority, a test per attribute and the values it gives. Tests are ``in`` (equal),
``starts``, ``ends``, ``null`` and ``any`` (also where the test is null). The tests of
a rule and the lengths of its prefixes and suffixes make up its shape. Every distinct
combination of attributes gives one key per shape in the table, every rule has one key, and
the first rule by priority among those with a key in common decides. The plan holds the
shapes and not the rules, so a thousand rules are as deep as one; a fact is joined once,
with one row per combination.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.operators import joins
from shiftloom.operators.projection import q

TESTS = ("any", "in", "starts", "ends", "null")
SHAPES = 4096  # different shapes of rules in a table at most
COMBO, KEY, FOUND, PRIORITY = "__combo", "__key", "__found", "priority"

Rule = tuple[Mapping[str, tuple[str, object]], Mapping[str, object]]


def rule_table(spark: SparkSession, attributes: Sequence[str], outputs: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """The table of rules given as ``({attribute: (test, argument)}, {output: value})``, first rule first.

    The argument of ``in`` may be a list: one row each, of equal priority. Attributes left
    out match anything, outputs left out are null.
    """
    rows = []
    for i, (tests, values) in enumerate(rules):
        expanded: list[dict[str, tuple[str, str | None]]] = [{}]
        for a, (test, arg) in tests.items():
            args = arg if isinstance(arg, (list, tuple)) else [arg]
            expanded = [{**e, a: (test, x)} for e in expanded for x in args]
        for e in expanded:
            cells = [x for a in attributes for x in e.get(a, ("any", None))]
            rows.append((i, *cells, *[values.get(o) for o in outputs]))
    text = T.StringType()
    names = [x for a in attributes for x in (test_of(a), a)]
    schema = T.StructType([T.StructField(PRIORITY, T.LongType()), *[T.StructField(n, text) for n in [*names, *outputs]]])
    return spark.createDataFrame(rows, schema)


def test_of(attribute: str) -> str:
    return f"{attribute}_test"


def _test(attribute: str) -> Column:
    return F.coalesce(q(test_of(attribute)), F.lit("any"))


def _length(attribute: str) -> Column:
    """Length of a prefix or suffix; 0 for tests to which it does not matter."""
    return F.when(_test(attribute).isin("starts", "ends"), F.length(q(attribute))).otherwise(F.lit(0))


def _sign(test: str, text: Column) -> Column:
    """One attribute's part of a key: the test's sign, then the text with its length, so that parts cannot run together."""
    return F.concat(F.lit(test[0] if test != "any" else "*"), F.length(text).cast("string"), F.lit(":"), text)


def _rule_part(a: str) -> Column:
    part = F.lit("*")
    for test in ("in", "starts", "ends"):
        part = F.when(_test(a) == test, _sign(test, q(a))).otherwise(part)
    return F.when(_test(a) == "null", F.lit("0")).otherwise(part)


def _value_part(value: Column, test: str, length: int) -> Column:
    """The same part made from an attribute's value; null where no such rule can hold."""
    if test == "any":
        return F.lit("*")
    if test == "null":
        return F.when(value.isNull(), F.lit("0"))
    if test == "in":
        return _sign(test, value)
    cut = F.substring(value, 1, length) if test == "starts" else F.right(value, F.lit(length))
    return F.when(F.length(value) >= length, _sign(test, cut))


def shapes_of(table: DataFrame, attributes: Sequence[str]) -> list[tuple[tuple[str, int], ...]]:
    """The distinct shapes of a table's rules: (test, length) per attribute."""
    odd = table.where(F.lit(False) if not attributes else _any([~_test(a).isin(*TESTS) for a in attributes]))
    rows = table.select(*[F.struct(_test(a).alias("t"), _length(a).alias("n")).alias(f"s{i}") for i, a in enumerate(attributes)])
    found = rows.where(_any([F.col(f"s{i}")["n"].isNotNull() for i in range(len(attributes))])).distinct().limit(SHAPES + 1).collect()
    if len(found) > SHAPES:
        raise ValueError(f"more than {SHAPES} shapes of rules")
    if bad := odd.limit(1).collect():
        raise ValueError(f"unknown test in {bad[0]}")
    return sorted(tuple((s["t"], s["n"]) for s in r) for r in found if all(s["n"] is not None for s in r))


def _any(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def apply_rules(table: DataFrame, attributes: Sequence[str], outputs: Mapping[str, Column | None], last: bool = False):
    """Adds ``{output: value where no rule holds}`` from the first rule that holds, by ``priority``.

    ``last``: the last one decides, as in a chain of overrides. Where the rule that
    decides gives null the value without a rule stands. Rules of equal
    priority are decided by their outputs, the least first. A rule whose test needs an
    argument and has none never holds. Attributes are compared as texts.
    """
    shapes = shapes_of(table, attributes)
    names = list(outputs)
    ordered = -F.col(PRIORITY) if last else F.col(PRIORITY)
    best = F.min(F.struct(ordered.alias("p"), *[q(o) for o in names])).alias(FOUND)
    keyed = table.withColumn(KEY, F.concat_ws("|", *[F.coalesce(_rule_part(a), F.lit("\0")) for a in attributes])).groupBy(KEY).agg(best)

    def op(df: DataFrame) -> DataFrame:
        texts = [q(a).cast("string") for a in attributes]
        whole = F.concat_ws("|", *[F.coalesce(_sign("in", c), F.lit("0")) for c in texts])
        coded = df.withColumn(COMBO, whole)
        combos = coded.select(COMBO, *[c.alias(f"a{i}") for i, c in enumerate(texts)]).dropDuplicates([COMBO])
        parts = [sorted({s[i] for s in shapes}) for i in range(len(attributes))]
        made = combos.select(COMBO, *[
            F.array(*[_value_part(F.col(f"a{i}"), test, n) for test, n in p]).cast("array<string>").alias(f"p{i}") for i, p in enumerate(parts)])
        places = F.array(*[F.array(*[F.lit(p.index(c)) for p, c in zip(parts, s)]) for s in shapes]).cast("array<array<int>>")
        keys = F.transform(places, lambda s: _joined([F.get(F.col(f"p{i}"), F.get(s, F.lit(i))) for i in range(len(attributes))]))
        met = made.select(COMBO, F.explode(F.array_compact(keys)).alias(KEY)).join(keyed, KEY)
        decided = met.groupBy(COMBO).agg(F.min(FOUND).alias(FOUND))
        joined = joins.spread_join(coded, decided, [COMBO])
        values = {o: F.col(FOUND)[o] if default is None else F.coalesce(F.col(FOUND)[o], default) for o, default in outputs.items()}
        return joined.withColumns(values).drop(COMBO, FOUND)

    return op


def _joined(parts: Sequence[Column]) -> Column:
    """Parts with a bar between them; null if any part is."""
    out = [parts[0]]
    for p in parts[1:]:
        out += [F.lit("|"), p]
    return F.concat(*out)
