"""Frames between jobs: materialised tables and connected components."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftloom.session import configure, scratch_path

# Rows of an Arrow batch: texts of tens of kilobytes must not add up to a batch
# that a Python worker cannot hold. Only used where the session keeps the default.
ARROW_ROWS = "512"


def prepare(spark: SparkSession) -> SparkSession:
    """Library defaults, and small Arrow batches where the session says nothing."""
    configure(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, ARROW_ROWS)
    return spark


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder.

    It cuts lineage and is read again by every later job as it was written, so row
    ids and partition numbers in it stay what they are when executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(table: DataFrame) -> None:
    """Removes a table of :func:`written` that nothing reads any more: whatever came of it has been written itself."""
    jvm = table.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(table.written_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return the columns of ``docs``: whatever these are called.

    The operators' own columns begin with two underscores. Columns of ``docs`` that do so
    have other names while the operator works, and their own again in its result.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        taken = {c.lower() for c in docs.columns}
        there: dict[str, str] = {}
        for c in docs.columns:
            if c.startswith("__"):
                n = 0
                while f"kept{n}{c}".lower() in taken:
                    n += 1
                there[c] = f"kept{n}{c}"
                taken.add(there[c].lower())
        return operator(docs.withColumnsRenamed(there), *args, **options).withColumnsRenamed({v: k for k, v in there.items()})

    return run


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``links(u, v)``: one row (node, root) per linked node.

    Alternates large-star and small-star steps, each a grouped minimum and a join,
    until the edges no longer change; then every edge leads from a node to the least
    node of its component. The number of rounds grows with the logarithm of the
    component's size. Self links and repeats are allowed, nulls are ignored.
    """
    u, v = F.col("u"), F.col("v")
    edges = written(links.select("u", "v").where(u != v).distinct(), "links")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        large = both.join(low, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        edges = written(small, "stars")
        state = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen:
            return edges.select(u.alias("node"), v.alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
