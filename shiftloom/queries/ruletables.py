"""Rules kept in tables, on the queries whose rules are also wired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.operators.ruletable import apply_rules
from shiftloom.plans import rule_tables as R
from shiftloom.plans import rules_as_tables as RT
from shiftloom.queries.basics import _FLOW_LOB_SQL, _PART_FLOW_SQL, _PART_UNIT_SQL, part_units
from shiftloom.queries.registry import Tables, query
from shiftloom.queries.reshape import _CODE_SQL, _group_sql, order_codes


@query("rules_codes", f"SELECT o_orderkey, code, {_group_sql('code')} AS codes_group FROM (SELECT o_orderkey, {_CODE_SQL} AS code FROM orders)")
def rules_codes(t: Tables) -> DataFrame:
    coded = order_codes(t).select("o_orderkey", "code")
    return coded.transform(apply_rules(RT.code_rules(t.spark), ["code"], {"codes_group": F.lit(R.DEFAULT_GROUP)}))


@query(
    "rules_lob",
    f"""
    WITH parts AS (SELECT p_partkey, {_PART_UNIT_SQL} AS unit, {_PART_FLOW_SQL} AS flow, p_brand AS lob FROM part)
    SELECT p_partkey, unit, flow, CASE WHEN unit = 'LERT' AND flow = 'LERT' THEN 'LERT'
      WHEN unit = 'CUSTOMER_SUPPORT' AND flow = 'IDVAAS' THEN 'CO - Customer Support'
      WHEN unit = 'COMMUNITY_OPS' THEN {_FLOW_LOB_SQL} ELSE lob END AS lob FROM parts
    """,
)
def rules_lob(t: Tables) -> DataFrame:
    """A chain of overrides: the last rule that holds decides, and a pair without a rule keeps its lob."""
    rows = part_units(t).drop("p_size")
    return rows.transform(apply_rules(RT.lob_rules(t.spark), ["unit", "flow"], {"lob": F.col("lob")}, last=True))


# A rule per part: its tests follow from the part's key.
_RULES = {
    "priority": "(p_partkey * 7919) % 10007",
    "p_brand_test": "CASE p_partkey % 4 WHEN 0 THEN 'in' WHEN 1 THEN 'starts' WHEN 2 THEN 'ends' END",
    "p_brand": "CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN substring(p_brand, 1, CAST(6 + p_partkey % 3 AS INTEGER)) "
               "WHEN 2 THEN right(p_brand, 1) END",
    "kind_test": "CASE p_partkey % 5 WHEN 0 THEN 'any' WHEN 1 THEN 'null' ELSE 'in' END",
    "kind": "p_type",
    "p_size_test": "'in'",
    "p_size": "CAST(p_size AS STRING)",
    "rule": "CONCAT('rule ', CAST(p_partkey AS STRING))",
}
_KIND = "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_type END"


@query(
    "rules_many",
    "WITH rules AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in _RULES.items()) + " FROM part), "
    f"""parts AS (SELECT p_partkey, p_brand, {_KIND} AS kind, p_size FROM part),
    met AS (SELECT p.p_partkey, r.priority, r.rule FROM parts p JOIN rules r ON r.p_size = CAST(p.p_size AS VARCHAR)
      AND (r.kind_test = 'any' OR r.kind_test = 'null' AND p.kind IS NULL OR r.kind_test = 'in' AND p.kind = r.kind)
      AND CASE r.p_brand_test WHEN 'in' THEN p.p_brand = r.p_brand WHEN 'starts' THEN starts_with(p.p_brand, r.p_brand)
        WHEN 'ends' THEN ends_with(p.p_brand, r.p_brand) ELSE TRUE END)
    SELECT p_partkey, p_brand, kind, p_size, (SELECT min_by(rule, (priority, rule)) FROM met m WHERE m.p_partkey = p.p_partkey) AS rule FROM parts p
    """,
)
def rules_many(t: Tables) -> DataFrame:
    """As many rules as there are parts, over three attributes, with prefixes, suffixes, wildcards and nulls."""
    rules = t.part.select(*[F.expr(v).alias(k) for k, v in _RULES.items()])
    parts = t.part.select("p_partkey", "p_brand", F.expr(_KIND).alias("kind"), "p_size")
    return parts.transform(apply_rules(rules, ["p_brand", "kind", "p_size"], {"rule": None}))
