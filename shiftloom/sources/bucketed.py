"""Co-partitioned storage: tables bucketed and sorted by entity, joined without an exchange.

A fact, a roster and event feeds that are joined every day are dealt out by entity once,
when they are written. Joins of such tables on the entity (and more), and windows per entity,
then find their rows in place. All rows of an entity lie in one bucket, so this is for tables
whose entities have a bounded number of rows, such as one per calendar day; feeds with
hot entities are combined to one row per day first, or stay plain tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shiftloom.session import configure


def save_bucketed(df: DataFrame, table: str, path: str, entity: str, order: Sequence[str] = (), buckets: int = 200) -> None:
    """Writes ``df`` to ``path`` as a catalog table with one sorted file per bucket."""
    (
        df.repartition(buckets, entity).sortWithinPartitions(entity, *order)
        .write.mode("overwrite").bucketBy(buckets, entity).sortBy(entity, *order).option("path", path).saveAsTable(table)
    )


def colocated(spark: SparkSession) -> SparkSession:
    """A session over the same catalog in which joins make use of buckets.

    Tables bucketed by the entity then also meet on (entity, day) in place, and neither
    side is sent around, whatever its size.
    """
    session = configure(spark.newSession())
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return session
