"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders of single-process sessions (tests) that set no spark.checkpoint.dir, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; cluster sizing is left to the caller."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A series block (at most ~22k rows) fits the window buffer without going through the sorter.
    spark.conf.set("spark.sql.windowExec.buffer.in.memory.threshold", "32768")
    # The JVM does not compile methods above 8000 bytes of bytecode; wide panels run faster as split
    # functions than as one such method.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidewick-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir`` (a temp folder only in local mode)."""
    return f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a summary table to the shared folder and read it back.

    The read-back table has its real size in the planner's statistics, so a join against it is
    broadcast only when it is below ``spark.sql.autoBroadcastJoinThreshold`` and is a shuffle join
    otherwise.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
