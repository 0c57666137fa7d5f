"""Feeds with rows that do not fit, landed as CSV first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.queries.registry import Tables, query
from shiftloom.session import scratch_path
from shiftloom.sources import quarantine

COLUMNS = {"o_orderkey": "bigint", "o_orderdate": "date", "o_totalprice": "double"}
_DAY = "CASE WHEN o_orderkey % 31 = 3 THEN strftime(o_orderdate, '%d.%m.%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END"
_PRICE = "CASE WHEN o_orderkey % 37 = 5 THEN 'n/a' WHEN o_orderkey % 37 = 6 THEN '' ELSE CAST(o_totalprice AS VARCHAR) END"
_TWICE = "o_orderkey % 41 = 7"  # these records have a field too many
_LANDED_SQL = f"""
landed AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, {_DAY} AS d, {_PRICE} AS p, {_TWICE} AS twice,
    row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS record FROM orders)"""


def landed(t: Tables) -> str:
    """One CSV file per month, its records by key."""
    key = F.col("o_orderkey")
    day = F.when(key % 31 == 3, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    price = F.when(key % 37 == 5, F.lit("n/a")).when(key % 37 == 6, F.lit("")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", key.cast("string"), day, price, F.when(key % 41 == 7, F.lit("surplus")))
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    body = t.orders.select(month, key.alias("rank"), line.alias("value"))
    heads = t.orders.select(month).distinct().select("month", F.lit(-1).cast("bigint").alias("rank"), F.lit(",".join(COLUMNS)).alias("value"))
    path = scratch_path(t.spark, "months-csv")
    (
        heads.unionByName(body).repartition("month").sortWithinPartitions("month", "rank").drop("rank")
        .write.partitionBy("month").text(path)
    )
    return path


def _month() -> F.Column:
    return F.regexp_extract("file", "month=([0-9-]+)", 1).alias("month")


@query(
    "misfit_rows",
    f"""
    WITH {_LANDED_SQL}
    SELECT month, record, 'o_orderdate' AS "column", d AS text, 'type' AS reason FROM landed WHERE o_orderkey % 31 = 3
    UNION ALL SELECT month, record, 'o_totalprice', p, 'type' FROM landed WHERE p = 'n/a'
    UNION ALL SELECT month, record, NULL, o_orderkey || ',' || d || ',' || p || ',surplus', 'fields' FROM landed WHERE twice
    """,
)
def misfit_rows(t: Tables) -> DataFrame:
    """File (its month), record, column and text of everything that does not fit."""
    records = quarantine.read_records(t.spark, landed(t))
    found = quarantine.misfit_rows(quarantine.audit(records, COLUMNS))
    return found.select(_month(), "record", "column", "text", "reason")


@query(
    "quarantine",
    f"""
    WITH {_LANDED_SQL}, judged AS (SELECT *, o_orderkey % 31 = 3 OR p = 'n/a' OR twice AS bad FROM landed)
    SELECT month, count(*) AS records, count(*) FILTER (WHERE bad) AS rejected,
      sum(o_orderkey) FILTER (WHERE NOT bad)::BIGINT AS kept_keys, sum(o_orderkey) FILTER (WHERE bad)::BIGINT AS rejected_keys
    FROM judged GROUP BY month
    """,
)
def quarantined(t: Tables) -> DataFrame:
    """Every record is in the feed or in the quarantine; counts and sums per month come from both."""
    tables = [scratch_path(t.spark, n) for n in ("feed", "quarantine")]
    got = quarantine.land(t.spark, landed(t), COLUMNS, *tables, max_share=0.2)
    good = got.feed.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderkey").alias("kept"))
    bad = got.quarantine.select(_month(), F.col("texts.o_orderkey").cast("bigint").alias("rejected"))
    both = good.unionByName(bad, allowMissingColumns=True).groupBy("month")
    return both.agg(F.count(F.lit(1)).alias("records"), F.count("rejected").alias("rejected"),
                    F.sum("kept").alias("kept_keys"), F.sum(F.col("rejected")).alias("rejected_keys"))
