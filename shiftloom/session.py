"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. They are only set where the session
# (or the cluster's defaults) says nothing, so an operator's own tuning wins.
DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a join partition that holds a hot key, even if that costs an
    # additional shuffle further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Static settings: only a session that is being built can take them.
STATIC = {
    # No stack trace per column expression: plans of this library have hundreds.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set every runtime default the session does not set itself."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in DEFAULTS.items():
        if key not in explicit and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "shiftloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**DEFAULTS, **STATIC, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder the cluster names.

    Data written between two stages must be readable by every executor and must
    outlive any of them, so the parent is ``spark.checkpoint.dir``. Only where a
    local session names none (tests, a laptop) a temporary folder stands in for it;
    on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; {master} needs a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shiftloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
