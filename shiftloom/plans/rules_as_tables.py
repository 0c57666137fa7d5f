"""The schedule's rules as rows, for :mod:`shiftloom.operators.ruletable`.

A deployment may keep these tables in files of its own and change them without code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftloom.operators.ruletable import rule_table
from shiftloom.plans import rule_tables as R


def code_rules(spark: SparkSession, ruleset: str = "full") -> DataFrame:
    """code to codes_group; codes without a rule are :data:`~shiftloom.plans.rule_tables.DEFAULT_GROUP`."""
    return rule_table(spark, ["code"], ["codes_group"], [({"code": (t, a)}, {"codes_group": g}) for t, a, g in R.CODE_RULESETS[ruleset]])


def unit_rules(spark: SparkSession) -> DataFrame:
    """lob to unit; other lobs are their own unit."""
    return rule_table(spark, ["lob"], ["unit"], [
        ({"lob": ("in", R.CUSTOMER_LOB)}, {"unit": R.CUSTOMER_UNIT}),
        ({"lob": ("starts", R.COMMUNITY_PREFIX)}, {"unit": R.COMMUNITY_UNIT}),
        ({"lob": ("in", R.COMMUNITY_LOBS)}, {"unit": R.COMMUNITY_UNIT}),
    ])


def lob_rules(spark: SparkSession, after_changes: bool = False) -> DataFrame:
    """(unit, flow) to lob, the last rule that holds; other pairs keep their lob."""
    customer = {"unit": ("in", R.CUSTOMER_UNIT)} | ({} if after_changes else {"flow": ("in", R.CUSTOMER_FLOW)})
    rules = [({"unit": ("in", R.LERT), "flow": ("in", R.LERT)}, {"lob": R.LERT}), (customer, {"lob": R.CUSTOMER_LOB})]
    rules += [({"unit": ("in", R.COMMUNITY_UNIT), "flow": ("in", f)}, {"lob": lob}) for f, lob in R.COMMUNITY_FLOWS.items()]
    return rule_table(spark, ["unit", "flow"], ["lob"], rules)
