"""Session settings the library depends on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="tablewright-")
    context.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/tablewright/{label}-{uuid.uuid4().hex}"


def materialize(df):
    """Cut the lineage with a reliable checkpoint: the rows survive lost executors."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
