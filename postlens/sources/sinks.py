"""Sinks and keyed writes.

The reference upserts into a document store.  Here a table is a Parquet
directory: an upsert computes the new version with one full outer join on
the key and writes it to a new path (the caller swaps paths), which is
safe to re-run after a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_key(df: DataFrame, out: str = "key") -> DataFrame:
    """K2: ``_id`` when not null, else ``post_id``."""
    return df.withColumn(out, F.coalesce(F.col("_id"), F.col("post_id")))


def latest_per_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Duplicate update keys: the later record (by ``order``) wins, and among
    equally late ones that with the largest hash of its fields, so the choice
    is reproducible."""
    rest = [c for c in df.columns if c != key]
    tie = [F.xxhash64(*rest).desc()] if rest else []
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order or []],
                                        *(tie or [F.col(key)]))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def upsert(target: DataFrame, updates: DataFrame, key: str, set_cols: list[str],
           order: list[str] | None = None) -> DataFrame:
    """K1: field-level ``$set`` upsert.  Named fields are overwritten (also
    with null) for matching keys, other stored fields are kept, new keys are
    inserted (fields not in the update are null)."""
    u = latest_per_key(updates.select(key, *set_cols, *(order or [])), key, order) \
        .select(F.col(key).alias("__uk"), *[F.col(c).alias(f"__u_{c}") for c in set_cols])
    j = target.join(u, target[key] == u["__uk"], "full_outer")
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.coalesce(F.col(key), F.col("__uk")).alias(key))
        elif c in set_cols:
            cols.append(F.when(F.col("__uk").isNotNull(), F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    extra = [F.col(f"__u_{c}").alias(c) for c in set_cols if c not in target.columns]
    return j.select(*cols, *extra)


def replace_by_key(target: DataFrame, updates: DataFrame, key: str, stamp: Column | None = None,
                   order: list[str] | None = None) -> DataFrame:
    """K3: whole-row replace by key, with a ``last_updated`` stamp; of the
    updates of one key the latest (by ``order``) is taken."""
    u = latest_per_key(updates, key, order).withColumn("last_updated", stamp if stamp is not None else F.current_timestamp())
    return target.join(u.select(key), key, "left_anti").unionByName(u, allowMissingColumns=True)


def snapshot_id(prefix: str, at: Column) -> Column:
    """K4: run id ``<prefix>_YYYYmmdd_HHMMSS``."""
    return F.concat(F.lit(prefix + "_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def append_snapshot(df: DataFrame, path: str, prefix: str, at: Column) -> None:
    """K4: append a snapshot row set tagged with its run id."""
    df.withColumn("_id", snapshot_id(prefix, at)).withColumn("saved_at", at) \
      .write.mode("append").parquet(path)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """K4: the newest snapshot, with a null ``error``; without any, one row
    that has nothing but the error."""
    newest = snapshots.orderBy(F.col("saved_at").desc(), F.col("_id").desc()).limit(1)
    message = F.lit("no snapshot has been saved")
    one = snapshots.sparkSession.range(1).select(F.lit(1).alias("__one"))
    return one.join(newest.withColumn("__one", F.lit(1)), "__one", "left").select(
        *snapshots.columns, F.when(F.col("_id").isNull(), message).alias("error"))


def write_json(df: DataFrame, path: str) -> None:
    """K5: JSON lines, UTF-8, non-ASCII kept as is."""
    df.write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, by: str = "subreddit") -> None:
    """K6: one JSON directory per community."""
    df.write.mode("overwrite").partitionBy(by).json(path)
