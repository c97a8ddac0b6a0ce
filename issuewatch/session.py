"""Spark session helpers.

Everything in the library takes a SparkSession from the caller; these helpers only
build a local session for tests/bench and resolve the shared checkpoint folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Stages whose whole-stage generated method exceeds HotSpot's JIT limit (8000 bytes)
# fall back to split expression code, which the JIT compiles; a larger method would run
# interpreted. Matters for the unrolled 64-wide dot products (keywords.mmr).
JIT_METHOD_LIMIT = 8000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "issuewatch") -> SparkSession:
    """A local[*] session configured like the cluster profile (AQE on, UTC, Arrow)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_LIMIT))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def check_zone(spark: SparkSession) -> None:
    """Warn if the session's zone is not UTC: stored times are UTC wall times. The caller's
    settings are never changed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        warnings.warn(f"spark.sql.session.timeZone is {zone}; times are read as UTC wall times", stacklevel=2)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder that `spark.checkpoint.dir` names.

    Where it is unset, a local session (one machine) gets a scratch folder; on a cluster
    every executor would write to its own disk, so that is an error.
    """
    cp = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not cp:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cp = tempfile.mkdtemp(prefix="issuewatch-cp-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", cp)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cp)
    return cp


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub folder of the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark's switch for deleting a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, each query's shuffle files go when it ends; else they stay until the driver
    happens to collect its garbage, and those of a whole job add up. The caller's setting is
    put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
