"""Unpivot, pivot, split, unnest, code classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import rules
from shiftloom.operators import reshape
from shiftloom.plans import rule_tables as R
from shiftloom.plans import schedule as S
from shiftloom.queries.registry import Tables, query

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "unpivot_schedule",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, '{m}' AS date, "
        f"CAST({'nullif(l_discount, 0)' if m == 'l_discount' else m} AS VARCHAR) AS value FROM lineitem"
        for m in _MEASURES
    ),
)
def unpivot_schedule(t: Tables) -> DataFrame:
    wide = t.lineitem.withColumn("l_discount", rules.zero_to_null("l_discount"))
    wide = wide.drop("l_returnflag", "l_linestatus", "l_shipdate")
    return wide.transform(reshape.unpivot(("l_orderkey", "l_linenumber"), ids_are_range=True))


_DAYS = ["0", "1", "2", "3", "4", "5", "6"]


@query(
    "unpivot_explicit",
    """
    WITH w AS (SELECT o_custkey, (dayofweek(o_orderdate) + 6) % 7 AS d, count(*) AS n FROM orders GROUP BY 1, 2),
    days AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS d)
    SELECT c.o_custkey, CAST(days.d AS VARCHAR) AS date, CAST(w.n AS VARCHAR) AS value
    FROM (SELECT DISTINCT o_custkey FROM orders) c CROSS JOIN days
    LEFT JOIN w ON w.o_custkey = c.o_custkey AND w.d = days.d
    """,
)
def unpivot_explicit(t: Tables) -> DataFrame:
    coded = t.orders.select("o_custkey", F.weekday("o_orderdate").cast("string").alias("weekday"))
    wide = coded.transform(reshape.pivot_groups(["o_custkey"], "weekday", _DAYS, F.count(F.lit(1))))
    return wide.transform(reshape.unpivot(["o_custkey"], _DAYS))


@query(
    "pivot_groups",
    "SELECT user_id, " + ", ".join(
        f"nullif(count(*) FILTER (WHERE event_type = '{k}'), 0) AS \"{k}\"" for k in ("click", "error", "view")
    ) + " FROM events GROUP BY user_id",
)
def pivot_groups(t: Tables) -> DataFrame:
    return t.events.transform(
        reshape.pivot_groups(["user_id"], "event_type", ["click", "error", "view"], F.count(F.lit(1)))
    )


_STATUSES = {"available": "view", "coaching": "click", "meal": "purchase", "break": "signup", "unavailable": "error"}


@query(
    "conditional_pivot",
    "SELECT user_id, CAST(ts AS DATE) AS day, "
    + ", ".join(f"max(value) FILTER (WHERE event_type = '{s}') AS \"{c}\"" for c, s in _STATUSES.items())
    + " FROM events GROUP BY 1, 2",
)
def conditional_pivot(t: Tables) -> DataFrame:
    rows = t.events.withColumn("day", F.col("ts").cast("date"))
    return rows.transform(reshape.conditional_max(["user_id", "day"], "event_type", "value", _STATUSES))


@query("split_columns", "SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number, "
                        "CAST(NULL AS VARCHAR) AS rest FROM customer")
def split_columns(t: Tables) -> DataFrame:
    split = t.customer.select("c_custkey", "c_name").transform(
        reshape.split_columns("c_name", "#", ["kind", "number", "rest"])
    )
    return split.drop("c_name")


@query(
    "multi_value_unnest",
    """
    SELECT DISTINCT ticket_id, eid FROM (
      SELECT event_id AS ticket_id, 'u' || user_id AS eid FROM events
      UNION ALL SELECT event_id, 'u' || (user_id + event_id % 3) FROM events
      UNION ALL SELECT event_id, 'u' || (user_id + 2 * (event_id % 5)) FROM events WHERE event_id % 2 = 0)
    """,
)
def multi_value_unnest(t: Tables) -> DataFrame:
    def person(add) -> Column:
        return F.concat(F.lit("u"), (F.col("user_id") + add).cast("string"))

    def later(add) -> Column:
        return F.concat(F.lit("@"), F.rpad("event_type", 16, "."), F.lit("7#"), person(add))

    third = F.when(F.col("event_id") % 2 == 0, later(2 * (F.col("event_id") % 5))).otherwise(F.lit(""))
    cell = F.concat(person(0), later(F.col("event_id") % 3), third)
    tickets = t.events.select(F.col("event_id").alias("ticket_id"), cell.alias("eid"))
    return tickets.transform(reshape.unnest_ids("eid", "eid")).dropna("any")


# Code text of an order, from its status, priority and key: every ending a rule asks for.
_ENDINGS = ["", "1", "ct", "fa", "mpl", "2", "t", "wri", "ml", "3", "4", "5", "6", "9", "(s)", "8"]
_FIRSTS = {"O": "M", "F": "V", "P": "L"}
_CODE_SQL = (
    "(CASE o_orderstatus WHEN 'O' THEN 'M' WHEN 'F' THEN 'V' ELSE 'L' END || "
    f"({_ENDINGS!r})[CAST(o_orderkey % {len(_ENDINGS)} AS INTEGER) + 1])"
)


def order_codes(t: Tables) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(e) for e in _ENDINGS]), (F.col("o_orderkey") % len(_ENDINGS)).cast("int") + 1)
    code = F.concat(rules.value_map("o_orderstatus", _FIRSTS), ending)
    sheet = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("OLD")).otherwise(F.lit("MF"))
    return t.orders.select("o_orderkey", sheet.alias("indice"), code.alias("code"), F.col("o_orderpriority").alias("description"))


def _group_sql(c: str) -> str:
    tests = {"in": lambda a: f"{c} IN ({', '.join(repr(x) for x in a)})", "starts": lambda a: f"{c} LIKE '{a}%'",
             "ends": lambda a: f"{c} LIKE '%{a}'"}
    return "CASE " + " ".join(f"WHEN {tests[k](a)} THEN '{g}'" for k, a, g in R.CODE_RULESETS["full"]) + " ELSE 'Work' END"


@query(
    "classify_codes",
    f"SELECT DISTINCT code, {_group_sql('code')} AS codes_group FROM "
    f"(SELECT {_CODE_SQL} AS code FROM orders WHERE o_orderpriority <> '5-LOW')",
)
def classify_codes(t: Tables) -> DataFrame:
    return order_codes(t).transform(S.classify_codes())


@query(
    "schedule_flags",
    f"""
    WITH cells AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN 'T'
        ELSE {_CODE_SQL} END AS value FROM orders),
    codes AS (SELECT DISTINCT code, {_group_sql('code')} AS grp FROM
      (SELECT {_CODE_SQL} AS code FROM orders WHERE o_orderpriority <> '5-LOW'))
    SELECT o_orderkey, value,
      CAST(coalesce(value, '-') NOT IN ('L1', 'L2', '-') AS INTEGER) AS "Schedule",
      CAST(coalesce(grp IN ('Work', 'Trainees'), FALSE) AS INTEGER) AS "WD",
      CAST(coalesce(grp = 'LOA', FALSE) AS INTEGER) AS "LOA",
      CAST(coalesce(grp = 'Vacation', FALSE) AS INTEGER) AS "PTO",
      CAST(coalesce(value, '-') IN ('L1', 'L2') AS INTEGER) AS "Leave"
    FROM cells LEFT JOIN codes ON value = code
    """,
)
def schedule_flags(t: Tables) -> DataFrame:
    coded = order_codes(t)
    k = F.col("o_orderkey") % 11
    cell = rules.decision_list([(k == 0, F.lit(None).cast("string")), (k == 1, "T")], F.col("code"))
    cells = coded.select("o_orderkey", cell.alias("value"))
    return cells.transform(S.schedule_flags(coded.transform(S.classify_codes())))
