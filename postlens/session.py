"""Session construction and cluster-safe scratch locations.

Library code never invents local folders: lineage cuts and intermediate
tables go under the shared directory named by ``spark.checkpoint.dir``.
Only tests and the bench (local mode) set that directory themselves, and
only when it is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "postlens",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.postlens.balanceScans", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory.  A local session without one
    gets a scratch folder; on a cluster that is an error."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = current.get() if current.isDefined() else None
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="postlens-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable lineage cut (survives executor loss): ``checkpoint()`` to
    the shared directory, never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint directory and
    read it back: the lineage is cut, and later readers prune columns and push
    filters down."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
