"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows up to which a side that was counted is sent to every task; beyond it is joined.
BROADCAST_ROWS = 100_000


def build_session(app_name: str = "obsflow", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the package relies on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    """One folder a process, for local sessions without a configured one; goes when it ends."""
    root = tempfile.mkdtemp(prefix="obsflow-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def _scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a machine-local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_scratch()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{_scratch_root(spark)}/obsflow-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, to a reliable checkpoint, where several jobs use a result.

    The files go when the frame is no longer referenced and the session's context cleaner runs.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def counted_side(df: DataFrame) -> DataFrame:
    """A materialised join side: sent to every task where its count is within ``BROADCAST_ROWS``."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
