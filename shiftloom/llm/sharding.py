"""Contiguous shards of near equal size, by a global prefix sum over byte sizes.

Rows are put in one global order: by a hash of the text, so equal texts stand side by
side, then by doc_id. The order is laid out over range partitions, whose totals give
each partition its offset; with the running sum inside the partition every row knows how
many bytes come before it, and the shards are cut at equal targets.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftloom.llm.frames import prepare, shielded, written

SHARDS = 40
ROW_BYTES = 16  # counted for a row besides its text
ORDER = ["__group", "__known", "__id", "__size", "__crc"]


def _order(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({
        "__group": F.xxhash64(text), "__known": F.col("doc_id").isNotNull(), "__id": F.coalesce("doc_id", F.lit(0)),
        "__size": F.octet_length(text).cast("long") + ROW_BYTES, "__crc": F.crc32(text.cast("binary")),
    })


def placed(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row of ``docs``: the order's columns, ``doc_id``, ``shard`` and ``slot``.

    Row i with b bytes before it and size s lies in the shard of byte b + s/2, so a
    shard's size differs from the target by one row at most. ``slot`` counts from 0
    within a shard. A null text has no bytes; rows without doc_id come first within
    their group; rows that are alike in all that is ordered by are interchangeable. An
    empty table has no shards.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    prepare(docs.sparkSession)
    slim = _order(docs.select("doc_id", "text")).select("doc_id", *ORDER)
    laid = written(slim.repartitionByRange(*ORDER).withColumn("__part", F.spark_partition_id()), "ordered")
    # one row per partition comes to the driver
    totals = laid.groupBy("__part").agg(F.sum("__size").alias("size"), F.count(F.lit(1)).alias("n")).orderBy("__part").collect()
    offsets, size, n = [], 0, 0
    for part in totals:
        offsets.append((part["__part"], size, n))
        size, n = size + part["size"], n + part["n"]
    base = docs.sparkSession.createDataFrame(offsets, "__part int, __bytes long, __rows long")
    inside = Window.partitionBy("__part").orderBy(*ORDER)
    before = F.col("__bytes") + F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")
    middle = (2 * before + F.col("__size")) * shards
    found = laid.join(base, "__part").select(
        "doc_id", *ORDER, F.least(F.floor(middle / F.lit(float(2 * max(size, 1)))), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("__rows") + F.row_number().over(inside) - 1).alias("__place"),
    )
    found = written(found, "placed")
    first = F.broadcast(found.groupBy("shard").agg(F.min("__place").alias("__first")))  # ``shards`` rows at most
    return found.join(first, "shard").select("doc_id", *ORDER, "shard", (F.col("__place") - F.col("__first")).alias("slot"))


def manifest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    return placed(docs, shards).select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def cuts(docs: DataFrame, shards: int = SHARDS) -> list[tuple]:
    """(shard, key of its first row) of every shard but the first, in order: ``shards`` rows at most."""
    first = placed(docs, shards).groupBy("shard").agg(F.min(F.struct(*ORDER)).alias("first"))
    return [(r["shard"], tuple(r["first"])) for r in first.orderBy("shard").collect()][1:]


STEP = 64  # cuts looked at together


@shielded
def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with a column ``shard``: texts stay where they are and are compared with the cuts.

    The cuts are one sorted array, searched in two steps, whatever their number. A column
    of that name is replaced. Rows that are alike stay in one shard.
    """
    found = cuts(docs, shards)
    fields = ", ".join(f"`{c}`: {t}" for c, t in zip(ORDER, ("bigint", "boolean", "bigint", "bigint", "bigint")))
    told = json.dumps([{"at": at, "key": dict(zip(ORDER, first))} for at, first in found])
    whole = F.from_json(F.lit(told), f"array<struct<at: int, key: struct<{fields}>>>")
    heads = F.from_json(F.lit(json.dumps([{"at": at, "key": dict(zip(ORDER, first))} for at, first in found[::STEP]])),
                        f"array<struct<at: int, key: struct<{fields}>>>")
    key = F.struct(*[F.col(c) for c in ORDER])
    block = F.size(F.filter(heads, lambda c: c["key"] <= key))
    near = F.slice(whole, F.greatest(block - 1, F.lit(0)) * STEP + 1, F.lit(STEP))
    last = F.get(F.filter(near, lambda c: c["key"] <= key), F.size(F.filter(near, lambda c: c["key"] <= key)) - 1)
    number = F.when(block > 0, last["at"]).otherwise(F.lit(0))
    return _order(docs).withColumn("shard", number.cast("int")).drop(*ORDER)
