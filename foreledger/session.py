"""Session settings the library relies on, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings a session for this library is best started with.

    Capturing the Python call site of every Column costs several round trips
    each, more than planning itself, and can only be switched off at the start.
    """
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Zone-less timestamps are compared through UTC everywhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a source; a very large number when it has none."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        return int(str(plan.stats().sizeInBytes()))
    except AttributeError:  # a session without a JVM handle
        return 1 << 62


_OWN: dict[str, str] = {}  # application -> its folder, where one machine does all the work


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Only a session that runs in one process may fall back to its own disk; its
    settings are left as they are.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="foreledger-")
    return _OWN[application]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The copy survives lost executors, its rows no longer move between
    partitions when a task is retried, and its size is known to the planner,
    which then broadcasts small ones on its own.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
