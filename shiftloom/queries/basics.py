"""Projections, filters, conditionals, set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftloom.functions import dates, rules, text
from shiftloom.operators import filters, projection, sets
from shiftloom.plans import rule_tables as R
from shiftloom.plans import schedule as S
from shiftloom.plans.roster import normalize_workflow
from shiftloom.queries.registry import RUN_DATE, Tables, query

# -- projections --------------------------------------------------------------------


@query("final_projection", "SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem")
def final_projection(t: Tables) -> DataFrame:
    return t.lineitem.transform(
        projection.project(["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"])
    )


@query("rename_map", 'SELECT o_orderkey AS "order id", o_custkey AS "EID", o_orderstatus AS "STATUS", o_totalprice, '
                     "o_orderdate, o_orderpriority FROM orders")
def rename_map(t: Tables) -> DataFrame:
    return t.orders.transform(
        projection.rename({"o_orderkey": "order id", "o_custkey": "EID", "o_orderstatus": "STATUS"})
    )


@query("normalize_headers", "SELECT c_custkey AS cust_key, c_name AS cust_full_name, c_acctbal AS acct_bal FROM customer")
def normalize_headers(t: Tables) -> DataFrame:
    raw = t.customer.select(
        F.col("c_custkey").alias("Cust - Key"), F.col("c_name").alias("Cust  Full Name"), F.col("c_acctbal").alias("Acct Bal")
    )
    return raw.transform(projection.normalize_headers(lower=True))


@query("suffix_headers", "SELECT c_custkey AS c_custkey_cf, c_name AS c_name_cf, c_nationkey AS c_nationkey_cf, "
                         "c_acctbal AS c_acctbal_cf, c_mktsegment AS c_mktsegment_cf FROM customer")
def suffix_headers(t: Tables) -> DataFrame:
    return t.customer.transform(projection.suffix_headers("_cf"))


@query("drop_columns", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
                       "l_shipdate FROM lineitem")
def drop_columns(t: Tables) -> DataFrame:
    tolerant = t.lineitem.transform(projection.drop_columns(["l_returnflag", "l_comment", "e_id"]))
    return tolerant.transform(projection.drop_columns(["l_suppkey", "l_linestatus"], strict=True))


@query("drop_by_regex", "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, "
                        "l_linenumber FROM lineitem")
def drop_by_regex(t: Tables) -> DataFrame:
    return t.lineitem.transform(projection.drop_matching("key$"))


@query("slice_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def slice_columns(t: Tables) -> DataFrame:
    return t.lineitem.transform(projection.keep_leading(5))


@query("column_range", "SELECT l_orderkey, l_partkey, l_suppkey, l_discount, l_tax, l_returnflag FROM lineitem")
def column_range(t: Tables) -> DataFrame:
    return t.lineitem.transform(projection.column_ranges((None, "l_suppkey"), ("l_discount", "l_returnflag")))


@query("insert_constants", "SELECT 'CO' AS program, s_suppkey, s_name, '' AS phase, s_nationkey, s_acctbal, "
                           "'' AS moved FROM supplier")
def insert_constants(t: Tables) -> DataFrame:
    return t.supplier.transform(
        projection.insert_constants([(0, "program", "CO"), (3, "phase", ""), (None, "moved", "")])
    )


@query("conform_schema", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS DATE) AS joined, "
                         "CAST(NULL AS DOUBLE) AS hours FROM customer")
def conform_schema(t: Tables) -> DataFrame:
    target = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.LongType()), T.StructField("joined", T.DateType()),
        T.StructField("hours", T.DoubleType()),
    ])
    return t.customer.transform(projection.conform_schema(target))


@query("cast_columns", "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity, "
                       "CAST(l_discount AS VARCHAR) AS l_discount, TRY_CAST(l_returnflag AS DOUBLE) AS l_returnflag, "
                       "CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem")
def cast_columns(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate").transform(
        projection.cast_columns(
            {"l_orderkey": "string", "l_quantity": "int", "l_discount": "string", "l_returnflag": "double",
             "l_shipdate": "date"}
        )
    )


@query("stamp_run", "SELECT o_orderkey, o_orderdate, o_orderdate AS date_str, DATE '2024-01-15' AS creation_date, "
                    "'122923' AS mfdate FROM orders")
def stamp_run(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").transform(
        projection.stamp({"creation_date": RUN_DATE, "mfdate": "122923"}, copies={"date_str": "o_orderdate"})
    )


@query("sort_keys", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey")
def sort_keys(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey").orderBy("o_custkey", "o_orderdate", "o_orderkey")


# -- filters ------------------------------------------------------------------------


@query("filter_sentinel", "SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS name FROM orders "
                          "WHERE nullif(o_orderpriority, '3-MEDIUM') IS DISTINCT FROM '5-LOW'")
def filter_sentinel(t: Tables) -> DataFrame:
    named = t.orders.select("o_orderkey", rules.sentinel_to_null("o_orderpriority", "3-MEDIUM").alias("name"))
    return named.transform(filters.not_sentinel("name", "5-LOW"))


@query("filter_eq_or", "SELECT * FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'P'")
def filter_eq_or(t: Tables) -> DataFrame:
    return t.orders.transform(filters.equals_any("o_orderstatus", ["F", "P"]))


@query("filter_in_list", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'F') "
                         "AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def filter_in_list(t: Tables) -> DataFrame:
    return (
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
        .transform(filters.equals_any("o_orderstatus", ["O", "F"]))
        .transform(filters.not_in("o_orderpriority", ["1-URGENT", "2-HIGH"]))
    )


@query("filter_notnull", "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events "
                         "WHERE event_type <> 'error'")
def filter_notnull(t: Tables) -> DataFrame:
    v = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", v.alias("v")).transform(filters.present("v"))


@query("shift_cutoff", "SELECT event_id, ts FROM events WHERE date_trunc('second', ts) <= TIMESTAMP '2024-01-15 10:00:00'")
def shift_cutoff(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts").transform(filters.started_by("ts", RUN_DATE, 10))


@query("event_horizon", "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-13'")
def event_horizon(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.col("ts").cast("date").alias("day")).transform(
        filters.within_horizon("day", RUN_DATE, 2)
    )


@query("tz_strip", "SELECT event_id, ts AS shift_start FROM events")
def tz_strip(t: Tables) -> DataFrame:
    zoned = t.events.select("event_id", F.col("ts").cast("timestamp").alias("shift_start"))
    return zoned.withColumn("shift_start", dates.drop_zone("shift_start"))


# -- conditionals -------------------------------------------------------------------


@query("decision_list", "SELECT p_partkey, CASE WHEN p_size < 5 THEN 'small' WHEN p_type = 'PROMO' THEN 'promo' "
                        "WHEN p_brand LIKE 'Brand#1%' THEN 'first' ELSE p_type END AS grp FROM part")
def decision_list(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        rules.decision_list(
            [(F.col("p_size") < 5, "small"), (F.col("p_type") == "PROMO", "promo"),
             (text.starts("p_brand", "Brand#1"), "first")],
            F.col("p_type"),
        ).alias("grp"),
    )


# Flow and unit of a part, standing in for those of a person.
_PART_FLOW = {
    "ECONOMY": "Messenger", "SMALL": "IDVAAS", "MEDIUM": "MISREPRESENTATION", "PROMO": "GTM", "STANDARD": "Policy",
}
_PART_FLOW_SQL = "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PART_FLOW.items()) + " ELSE 'Non-Rec' END"
_PART_UNIT_SQL = "CASE p_size % 3 WHEN 0 THEN 'COMMUNITY_OPS' WHEN 1 THEN 'CUSTOMER_SUPPORT' ELSE 'LERT' END"


def part_units(t: Tables) -> DataFrame:
    flow = rules.decision_list([(F.col("p_type") == k, v) for k, v in _PART_FLOW.items()], "Non-Rec")
    unit = rules.decision_list(
        [(F.col("p_size") % 3 == 0, "COMMUNITY_OPS"), (F.col("p_size") % 3 == 1, "CUSTOMER_SUPPORT")], "LERT"
    )
    return t.part.select("p_partkey", unit.alias("unit"), flow.alias("flow"), F.col("p_brand").alias("lob"), "p_size")


_FLOW_LOB_SQL = (
    "CASE flow " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.COMMUNITY_FLOWS.items()) + " ELSE lob END"
)


@query(
    "override_chain",
    f"""
    WITH parts AS (SELECT p_partkey, {_PART_UNIT_SQL} AS unit, {_PART_FLOW_SQL} AS flow, p_brand AS lob, p_size FROM part),
    first_pass AS (
      SELECT p_partkey, unit, flow, p_size, CASE WHEN unit = 'LERT' AND flow = 'LERT' THEN 'LERT'
        WHEN unit = 'CUSTOMER_SUPPORT' AND flow = 'IDVAAS' THEN 'CO - Customer Support'
        WHEN unit = 'COMMUNITY_OPS' THEN {_FLOW_LOB_SQL} ELSE lob END AS lob FROM parts),
    second_pass AS (
      SELECT p_partkey, unit, flow, p_size, CASE WHEN unit = 'LERT' AND flow = 'LERT' THEN 'LERT'
        WHEN unit = 'CUSTOMER_SUPPORT' THEN 'CO - Customer Support'
        WHEN unit = 'COMMUNITY_OPS' THEN {_FLOW_LOB_SQL} ELSE lob END AS lob FROM first_pass),
    flows AS (SELECT p_partkey, unit, p_size, lob,
        CASE WHEN lob = 'CO - Customer Support' THEN 'IDVAAS' ELSE flow END AS flow FROM second_pass)
    SELECT p_partkey, unit, flow,
      CASE WHEN flow IN ('Policy', 'Training') AND p_size % 2 = 0 THEN 'CO - PTQ' ELSE lob END AS lob FROM flows
    """,
)
def override_chain(t: Tables) -> DataFrame:
    rows = part_units(t).withColumn("lob", S.line_of_business("unit", "flow", "lob"))
    return rows.transform(S.settle_lob("unit", "flow", "lob", F.col("p_size") % 2 == 0)).drop("p_size")


@query(
    "business_unit",
    """
    WITH l AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'CO - Customer Support' WHEN 1 THEN 'CO - GTM'
      WHEN 2 THEN 'Non-Rec' WHEN 3 THEN p_type END AS lob FROM part)
    SELECT p_partkey, lob, CASE WHEN lob = 'CO - Customer Support' THEN 'CUSTOMER_SUPPORT'
      WHEN lob LIKE 'CO -%' THEN 'COMMUNITY_OPS' WHEN lob IN ('Non-Rec', 'CO - Non-Rec') THEN 'COMMUNITY_OPS'
      ELSE lob END AS pbu FROM l
    """,
)
def business_unit(t: Tables) -> DataFrame:
    size = F.col("p_size") % 5
    lob = rules.decision_list(
        [(size == 0, "CO - Customer Support"), (size == 1, "CO - GTM"), (size == 2, "Non-Rec"), (size == 3, F.col("p_type"))],
        F.lit(None).cast("string"),
    )
    return t.part.select("p_partkey", lob.alias("lob")).withColumn("pbu", S.business_unit("lob"))


@query(
    "value_map",
    "SELECT o_orderkey, CASE flow " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in R.WORKFLOW_FAMILIES.items())
    + " ELSE flow END AS flow FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'IDRA' "
    "WHEN '2-HIGH' THEN 'Object' WHEN '3-MEDIUM' THEN 'Misrepresentation' ELSE o_orderpriority END AS flow FROM orders)",
)
def value_map(t: Tables) -> DataFrame:
    raw = rules.value_map(
        "o_orderpriority", {"1-URGENT": "IDRA", "2-HIGH": "Object", "3-MEDIUM": "Misrepresentation"}
    )
    return t.orders.select("o_orderkey", raw.alias("flow")).withColumn("flow", normalize_workflow("flow"))


@query("zero_to_null", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount FROM lineitem")
def zero_to_null(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", rules.zero_to_null("l_discount").alias("l_discount"))


@query(
    "sentinel_to_null",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS graduation FROM orders",
)
def sentinel_to_null(t: Tables) -> DataFrame:
    written = F.when(F.col("o_orderstatus") == "F", F.lit("Rolled-off")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", written.alias("graduation")).withColumn(
        "graduation", dates.parse_date(rules.sentinel_to_null("graduation", "Rolled-off"), "yyyy-MM-dd")
    )


@query("fill_constant", "SELECT event_id, coalesce(nullif(event_type, 'error'), '-') AS value FROM events")
def fill_constant(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("value")).fillna("-", ["value"])


@query(
    "dated_override",
    """
    WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
      CASE WHEN o_orderstatus = 'F' THEN 'CUSTOMER_SUPPORT' ELSE 'LERT' END AS pbu,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'CO - Customer Support' ELSE 'LERT' END AS lob FROM orders)
    SELECT o_orderkey, date,
      CASE WHEN date >= DATE '1999-06-01' AND pbu = 'CUSTOMER_SUPPORT' THEN 'COMMUNITY_OPS' ELSE pbu END AS pbu,
      CASE WHEN date >= DATE '1999-06-01' AND lob = 'CO - Customer Support' THEN 'CO - Graph Integrity' ELSE lob END AS lob
    FROM s
    """,
)
def dated_override(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("CUSTOMER_SUPPORT")).otherwise(F.lit("LERT")).alias("pbu"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("CO - Customer Support")).otherwise(F.lit("LERT")).alias("lob"),
    )
    return rows.transform(S.dated_override("pbu", "lob", since=dt.date(1999, 6, 1)))


# -- set operations -------------------------------------------------------------------


@query(
    "union_by_name",
    """
    SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS event_type FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, user_id, NULL, event_type FROM events WHERE event_type = 'view'
    UNION ALL SELECT event_id, NULL, value, event_type FROM events WHERE event_type IN ('view', 'error')
    """,
)
def union_by_name(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return sets.stack(
        t.events.where(kind == "click").select("value", "event_id", "user_id"),
        t.events.where(kind == "view").select("event_id", "event_type", "user_id"),
        t.events.where(kind.isin("view", "error")).select("event_type", "event_id", "value"),
    )


@query(
    "union_distinct",
    """
    SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events WHERE event_type IN ('click', 'view')
    UNION SELECT user_id, CAST(ts AS DATE), nullif(event_type, 'view') FROM events WHERE event_type IN ('view', 'error')
    """,
)
def union_distinct(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    second = rows.where(F.col("event_type").isin("view", "error"))
    return sets.stack_distinct(
        rows.where(F.col("event_type").isin("click", "view")),
        second.withColumn("event_type", rules.sentinel_to_null("event_type", "view")),
    )
