"""Feeds whose dates are written in one way each, found from the whole column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.queries.registry import Tables, query
from shiftloom.sources import layouts

WAYS = ["dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "yyyy-MM-dd"]
_DUCK = {"yyyy-MM-dd": "%Y-%m-%d", "yyyy/M/d": "%Y/%m/%d", "M/d/yyyy": "%m/%d/%Y", "d/M/yyyy": "%d/%m/%Y",
         "M-d-yyyy": "%m-%d-%Y", "d-M-yyyy": "%d-%m-%Y", "d.M.yyyy": "%d.%m.%Y"}
_WAYS_SQL = {"dd/MM/yyyy": "%d/%m/%Y", "MM/dd/yyyy": "%m/%d/%Y", "dd.MM.yyyy": "%d.%m.%Y", "yyyy-MM-dd": "%Y-%m-%d"}


def feed(t: Tables, i: int) -> DataFrame:
    """A fourth of the orders, with dates as one office writes them."""
    rows = t.orders.where(F.col("o_orderkey") % len(WAYS) == i)
    return rows.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.date_format("o_orderdate", WAYS[i]).alias("o_orderdate"))


@query("layout_by_column", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def layout_by_column(t: Tables) -> DataFrame:
    """Day-first and month-first feeds, told apart by their columns."""
    typed = [layouts.conform_by_layout(feed(t, i), {"o_orderkey": "bigint", "o_orderdate": "date"}).rows for i in range(len(WAYS))]
    return reduce(DataFrame.unionByName, typed)


_FITS = " UNION ALL ".join(
    f"SELECT office, '{way}' AS layout, count(*) AS n, count(try_strptime(d, '{fmt}')) AS fits, "
    f"min(CASE WHEN try_strptime(d, '{fmt}') IS NULL THEN d END) AS excluded FROM texts GROUP BY office" for way, fmt in _DUCK.items())


@query(
    "layout_evidence",
    "WITH texts AS (SELECT o_orderkey % 4 AS office, CASE o_orderkey % 4 "
    + " ".join(f"WHEN {i} THEN strftime(o_orderdate, '{_WAYS_SQL[w]}')" for i, w in enumerate(WAYS))
    + f" END AS d FROM orders) SELECT office, 'o_orderdate' AS \"column\", layout, n, fits, excluded FROM ({_FITS})",
)
def layout_evidence(t: Tables) -> DataFrame:
    """Per office and layout: how many texts fit, and one that does not."""
    rows = reduce(DataFrame.unionByName, [feed(t, i).withColumn("office", F.lit(i).cast("bigint")) for i in range(len(WAYS))])
    return layouts.evidence(rows, ["o_orderdate"], by=["office"])
