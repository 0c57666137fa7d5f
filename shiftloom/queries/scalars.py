"""Text, date and number expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftloom.functions import dates, rules, text
from shiftloom.operators import projection
from shiftloom.plans import rule_tables as R
from shiftloom.plans import schedule as S
from shiftloom.queries.registry import Tables, query, week_sql


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


@query("str_case", "SELECT c_custkey, lower(c_name) AS eid, upper(c_mktsegment) AS market FROM customer")
def str_case(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.lower("c_name").alias("eid"), F.upper("c_mktsegment").alias("market"))


@query("str_replace_chain", "SELECT p_partkey, replace(replace(replace(p_name, 'small', 'S'), 'red', 'R'), 'S r', 'Sr') AS name "
                            "FROM part")
def str_replace_chain(t: Tables) -> DataFrame:
    chain = text.replace_chain("p_name", [("small", "S"), ("red", "R"), ("S r", "Sr")])
    return t.part.select("p_partkey", chain.alias("name"))


@query("str_regex_replace", "SELECT c_custkey, regexp_replace(c_name, '#0*', '-', 'g') AS name FROM customer")
def str_regex_replace(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.regex_replace("c_name", "#0*", "-").alias("name"))


@query("replace_all_strings", "SELECT p_partkey, replace(p_name, 'D', ' & ') AS p_name, replace(p_brand, 'D', ' & ') AS p_brand, "
                              "replace(p_type, 'D', ' & ') AS p_type, p_size, p_retailprice FROM part")
def replace_all_strings(t: Tables) -> DataFrame:
    return t.part.transform(projection.with_all_strings(lambda c: text.regex_replace(c, "D", " & ")))


@query(
    "shift_bucket",
    """
    SELECT p_partkey, p_type, CASE WHEN contains(p_type, 'E') THEN 'Evening' WHEN contains(p_type, 'N') THEN 'Night'
      WHEN contains(p_type, 'M(s)') THEN 'Middle' WHEN contains(p_type, 'M') THEN 'Morning' ELSE '-' END AS shift
    FROM (SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN 'M(s)'
      WHEN p_size % 7 = 2 THEN 'L1' ELSE p_type END AS p_type FROM part)
    """,
)
def shift_bucket(t: Tables) -> DataFrame:
    k = F.col("p_size") % 7
    cell = rules.decision_list([(k == 0, F.lit(None).cast("string")), (k == 1, "M(s)"), (k == 2, "L1")], F.col("p_type"))
    return t.part.select("p_partkey", cell.alias("p_type")).withColumn("shift", S.shift_bucket("p_type"))


@query(
    "str_slice",
    "SELECT c_custkey, left(c_name, length(c_name) - 2) AS cut, substr(c_name, 17) AS tail, "
    "CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_custkey || '.5' END AS srt_id FROM customer",
)
def str_slice(t: Tables) -> DataFrame:
    as_float = F.concat(
        F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, F.lit(".0")).otherwise(F.lit(".5"))
    )
    return t.customer.select(
        "c_custkey", text.drop_last("c_name", 2).alias("cut"), text.from_char("c_name", 16).alias("tail"),
        text.strip_float_suffix(as_float).alias("srt_id"),
    )


@query("str_rstrip_set", "SELECT c_custkey, rtrim('#' || c_custkey || '.0', '.0') AS srt_id FROM customer")
def str_rstrip_set(t: Tables) -> DataFrame:
    raw = F.concat(F.lit("#"), F.col("c_custkey").cast("string"), F.lit(".0"))
    return t.customer.select("c_custkey", text.rstrip_set(raw, ".0").alias("srt_id"))


@query(
    "date_parse",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
)
def date_parse(t: Tables) -> DataFrame:
    written = F.when(F.col("o_orderstatus") == "P", F.lit("open")).otherwise(F.date_format("o_orderdate", "MM-dd-yyyy"))
    return t.orders.select("o_orderkey", dates.parse_date(written, "MM-dd-yyyy").alias("day"))


@query("date_parse_multi", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_parse_multi(t: Tables) -> DataFrame:
    written = rules.decision_list(
        [(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM-dd-yyyy")),
         (F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy"))],
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    parsed = dates.parse_any_date(written, ["MM-dd-yyyy", "M/d/yyyy", "yyyy-MM-dd"])
    return t.orders.select("o_orderkey", parsed.alias("day"))


@query("date_format", "SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS us, strftime(o_orderdate, '%m-%d-%Y') AS dashed, "
                      "strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
def date_format(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", dates.date_text("o_orderdate").alias("us"), dates.date_text("o_orderdate", "MM-dd-yyyy").alias("dashed"),
        dates.date_text("o_orderdate", "yyyy-MM-dd").alias("iso"),
    )


@query("date_add_days", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS effective, "
                        "o_orderdate + INTERVAL 10 HOUR AS cutoff FROM orders")
def date_add_days(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.date_add(order_day(), 1).alias("effective"), (F.col("o_orderdate") + F.expr("INTERVAL 10 HOURS")).alias("cutoff")
    )


_SERIAL_SQL = "datediff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE))"


@query(
    "excel_serial_date",
    f"SELECT o_orderkey, {_SERIAL_SQL} AS serial, CAST(o_orderdate AS DATE) AS day, "
    "CASE WHEN o_orderstatus = 'O' THEN DATE '1900-01-01' ELSE CAST(o_orderdate AS DATE) END AS roll_off FROM orders",
)
def excel_serial_date(t: Tables) -> DataFrame:
    serial = F.datediff(order_day(), F.lit(dates.SERIAL_EPOCH)).cast("bigint")
    off = F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(serial)
    return t.orders.select(
        "o_orderkey", serial.alias("serial"), dates.serial_to_date(serial).alias("day"),
        dates.serial_or_sentinel(off).alias("roll_off"),
    )


@query("mixed_date_headers", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def mixed_date_headers(t: Tables) -> DataFrame:
    serial = F.datediff(order_day(), F.lit(dates.SERIAL_EPOCH)).cast("string")
    header = F.when(F.col("o_orderkey") % 2 == 0, serial).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return t.orders.select("o_orderkey", dates.header_to_date(header).alias("day"))


@query("week_ending_friday", f"SELECT o_orderkey, {week_sql('CAST(o_orderdate AS DATE)')} AS week_ending FROM orders")
def week_ending_friday(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.week_ending_friday(order_day()).alias("week_ending"))


@query("weekday_num", "SELECT o_orderkey, CAST((dayofweek(o_orderdate) + 6) % 7 AS INTEGER) AS weekday FROM orders")
def weekday_num(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.weekday_num(order_day()).alias("weekday"))


@query("minutes_to_hours", "SELECT event_id, round(floor(value) / 60, 2) AS hours FROM events")
def minutes_to_hours(t: Tables) -> DataFrame:
    return t.events.select("event_id", rules.minutes_to_hours(F.floor("value")).alias("hours"))


@query("worked_hours_text", "SELECT event_id, CASE WHEN value > 0.33 THEN CAST(value AS VARCHAR) ELSE event_type END AS wh FROM events")
def worked_hours_text(t: Tables) -> DataFrame:
    return t.events.select("event_id", rules.hours_text("value", "event_type", R.WORKED_THRESHOLD).alias("wh"))
