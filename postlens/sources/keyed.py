"""Keyed tables on disk: K1 and K3 as writes.

A keyed table is Parquet partitioned by a bucket of its key; the name of the
partition column holds the number of buckets.  A write reads and rewrites only
the buckets that its updates fall into (dynamic partition overwrite), so its
cost follows the updates and not the table, up to the size of a bucket.

The rewritten buckets are first written under ``spark.checkpoint.dir`` and from
there into the table: nothing is read where it is being replaced, and the same
updates give the same table however often they are written.  If the driver
itself is lost while the new buckets are moved into place, their rows are in
that folder.

Updates with a null key are left out.  Of several updates of one key the latest
by ``order`` wins, see ``sinks.latest_per_key``.  Extra columns are kept; a
field that the table does not have is added, null in the other rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from . import sinks

PREFIX = "bucket_of_"


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(f"{PREFIX}{buckets}", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))


def _write(df: DataFrame, path: str, buckets: int) -> None:
    column = f"{PREFIX}{buckets}"
    (df.repartition(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(column).parquet(path))


def _raw(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    df = spark.read.option("mergeSchema", "true").parquet(path)
    column = next(c for c in df.columns if c.startswith(PREFIX))
    return df, int(column.removeprefix(PREFIX))


def create(df: DataFrame, path: str, key: str, buckets: int = 64) -> str:
    """A new keyed table of the rows of ``df``; more ``buckets`` make writes of
    few keys cheaper and files smaller."""
    _write(_bucketed(df, key, buckets), path, buckets)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    df, buckets = _raw(spark, path)
    return df.drop(f"{PREFIX}{buckets}")


def _rewrite(path: str, updates: DataFrame, key: str, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Replaces the buckets of the updates' keys by ``change(rows, updates)``;
    gives how many they are."""
    table, buckets = _raw(updates.sparkSession, path)
    column = f"{PREFIX}{buckets}"
    new = stored(_bucketed(updates.where(F.col(key).isNotNull()), key, buckets), "updates")
    touched = [r[0] for r in new.select(column).distinct().collect()]     # at most ``buckets``
    if touched:
        old = table.where(F.col(column).isin(touched)).drop(column)
        changed = change(old, new.drop(column))
        _write(stored(_bucketed(changed, key, buckets), "buckets"), path, buckets)
    return len(touched)


def upsert_into(path: str, updates: DataFrame, key: str, set_cols: list[str],
                order: list[str] | None = None) -> int:
    """K1 as a write: the named fields of the updates are set in the stored
    rows of their keys, rows of new keys are inserted."""
    return _rewrite(path, updates, key, lambda old, new: sinks.upsert(old, new, key, set_cols, order))


def replace_into(path: str, updates: DataFrame, key: str, stamp=None, order: list[str] | None = None) -> int:
    """K3 as a write: the updates' rows replace the stored rows of their keys."""
    return _rewrite(path, updates, key, lambda old, new: sinks.replace_by_key(old, new, key, stamp, order))
