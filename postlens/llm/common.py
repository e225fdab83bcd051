"""Helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    the lineage is cut and a lost executor loses nothing.  The shuffle files of
    the write have no reader after it, and Spark removes them at its end."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, a null as the empty text."""
    return [x or "" for x in column.to_pylist()]


@functools.cache
def _package_file(application: str) -> str:
    """This package as a zip file that Spark can hand to Python workers."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = __name__.split(".")[0]
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as file:
        for folder, _, files in os.walk(os.path.join(root, name)):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    file.write(full, os.path.relpath(full, root))
    return path


def ship(spark: SparkSession) -> None:
    """Let Spark send this package's code to its Python workers, wherever
    they run."""
    context = spark.sparkContext
    path = _package_file(context.applicationId)
    if path not in _sent:
        context.addPyFile(path)
        _sent.add(path)


_sent: set[str] = set()


def map_in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


@functools.cache
def vocabulary(name: str) -> str:
    """Where this machine keeps the public vocabulary file ``name`` (an
    absolute path is taken as it is)."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
