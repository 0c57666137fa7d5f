"""Scans. Tables are landed as CSV in the shared scratch folder, then read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftloom.queries.registry import Tables, query
from shiftloom.session import scratch_path
from shiftloom.sources import readers, schemas
from shiftloom.sources.writers import write_csv, write_latest, write_snapshot


@query("scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(t: Tables) -> DataFrame:
    return readers.read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet")


@query("scan_parquet_pruned", "SELECT l_orderkey, l_shipdate, l_quantity FROM lineitem WHERE l_quantity > 40")
def scan_parquet_pruned(t: Tables) -> DataFrame:
    wanted = ["l_orderkey", "l_shipdate", "l_quantity"]
    return readers.read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet", wanted).where(F.col("l_quantity") > 40)


@query("scan_csv_pruned", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_csv_pruned(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-csv")
    write_csv(t.orders, path)
    return readers.read_csv(
        t.spark, path, {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}
    )


def land_with_preamble(t: Tables, df: DataFrame, key: str, title: str) -> str:
    """CSV files that start with a title line and have their header in the second line."""
    files = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    body = df.select(F.pmod(F.xxhash64(key), F.lit(files)).alias("file"), F.lit(2).alias("rank"), line.alias("value"))
    heads = t.spark.range(files).select(
        F.col("id").alias("file"),
        F.inline(F.array(
            F.struct(F.lit(0).alias("rank"), F.lit(title).alias("value")),
            F.struct(F.lit(1).alias("rank"), F.lit(",".join(df.columns)).alias("value")),
        )),
    )
    path = scratch_path(t.spark, "preamble-csv")
    (
        heads.unionByName(body).repartition("file").sortWithinPartitions("file", "rank")
        .drop("rank").write.partitionBy("file").text(path)
    )
    return path


@query("header_offset_read", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def header_offset_read(t: Tables) -> DataFrame:
    source = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = land_with_preamble(t, source, "c_custkey", "Customer export")
    return readers.read_below_preamble(t.spark, path, 1, ["c_custkey", "c_name", "c_mktsegment"])


@query("headerless_codes", "SELECT p_type AS indice, p_brand AS code, p_name AS description FROM part")
def headerless_codes(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "codes-csv")
    write_csv(t.part.select("p_type", "p_brand", "p_name"), path, header=False)
    return readers.read_headerless(t.spark, path, schemas.CODES)


@query(
    "multi_file_union",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')",
)
def multi_file_union(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "events-csv")
    kinds = ["click", "view", "purchase", "signup"]
    rows = t.events.where(F.col("event_type").isin(kinds)).select(
        "event_id", "user_id", "event_type", "value", F.col("event_type").alias("sheet")
    )
    rows.write.option("header", True).partitionBy("sheet").csv(base)
    return readers.read_csv(
        t.spark, [f"{base}/sheet={k}" for k in kinds],
        {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double"},
    )


@query("scan_csv_quoted", "SELECT doc_id, text || '\"' || chr(10) || ', ' || chr(10) AS text, lang FROM documents")
def scan_csv_quoted(t: Tables) -> DataFrame:
    """Texts with quotes, commas, line breaks and spaces at the end."""
    path = scratch_path(t.spark, "documents-csv")
    write_csv(t.documents.select("doc_id", F.concat("text", F.lit('"\n, \n')).alias("text"), "lang"), path)
    return readers.read_csv(t.spark, path, {"doc_id": "bigint", "text": "string", "lang": "string"})


@query("scan_csv_reordered", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_csv_reordered(t: Tables) -> DataFrame:
    """Two folders whose headers have the same names in another order."""
    columns, paths = ["c_custkey", "c_name", "c_mktsegment"], []
    for i, order in enumerate((columns, columns[::-1])):
        paths.append(scratch_path(t.spark, "customer-csv"))
        write_csv(t.customer.where(F.col("c_custkey") % 2 == i).select(*order), paths[-1])
    return readers.read_csv(t.spark, paths, {"c_custkey": "bigint", "c_name": "string", "c_mktsegment": "string"})


@query("scan_csv_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def scan_csv_dates(t: Tables) -> DataFrame:
    """One date column in the three ways in which feeds write dates."""
    ways = ["yyyy-MM-dd", "MM/dd/yyyy", "M-d-yyyy"]
    text = F.coalesce(*[F.when(F.col("o_orderkey") % 3 == i, F.date_format("o_orderdate", w)) for i, w in enumerate(ways)])
    path = scratch_path(t.spark, "dates-csv")
    write_csv(t.orders.select("o_orderkey", text.alias("o_orderdate")), path)
    return readers.read_csv(t.spark, path, {"o_orderkey": "bigint", "o_orderdate": "date"})


@query("sink_latest", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sink_latest(t: Tables) -> DataFrame:
    """The latest state after it has been written twice."""
    path, wanted = scratch_path(t.spark, "latest"), ["o_orderkey", "o_custkey", "o_totalprice"]
    for df in (t.orders.select(*wanted).withColumn("o_totalprice", F.lit(0.0)), t.orders.select(*wanted)):
        write_latest(df, path, compression="none")
    return readers.read_parquet(t.spark, path)


@query(
    "sink_snapshot",
    "SELECT c_custkey, c_name, d AS run_date FROM customer, (VALUES (DATE '2024-01-01'), (DATE '2024-01-02')) v(d)",
)
def sink_snapshot(t: Tables) -> DataFrame:
    """Two dated copies, the second one written again."""
    path, df = scratch_path(t.spark, "snapshots"), t.customer.select("c_custkey", "c_name")
    for day in (1, 2, 2):
        write_snapshot(df, path, dt.date(2024, 1, day))
    return readers.read_parquet(t.spark, path)


@query(
    "sink_csv",
    "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN NULL ELSE ' ' || p_name || ' \"x\"' END AS note FROM part",
)
def sink_csv(t: Tables) -> DataFrame:
    """Empty, null and quoted texts, written and read back."""
    note = F.when(F.col("p_partkey") % 3 == 0, F.lit("")).when(
        F.col("p_partkey") % 3 == 2, F.concat(F.lit(" "), "p_name", F.lit(' "x"')))
    path = scratch_path(t.spark, "export")
    write_csv(t.part.select("p_partkey", note.alias("note")), path)
    return readers.read_csv(t.spark, path, {"p_partkey": "bigint", "note": "string"})
