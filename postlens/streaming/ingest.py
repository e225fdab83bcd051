"""Structured Streaming ingest.

New post drops land as files; the stream keeps posts not older than the
watermark (the feed's look-back window, 720 hours by default), drops
repeated ids within the watermark, and merges each micro-batch into the
stored table with a left anti-join on the key, so a re-run batch inserts
nothing twice (exactly-once per id; where ``ts`` is given, only if an id's
time never changes, see ``merge_batch``).  ``run_upserts`` updates stored
posts instead, field by field, and sets late rows apart.  ``enriched`` applies the stateless
preprocessing and flag stages to the streaming DataFrame (ST2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.flags import behaviour_flags
from ..operators.ingest import DEFAULT_SINCE_HOURS
from ..plans.preprocess import preprocess
from ..session import scratch_path, stored
from ..sources import keyed
from ..sources.sinks import latest_per_key


def stream_posts(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 glob: str | None = None, ts: str = "created_utc", key: str = "id",
                 since_hours: int = DEFAULT_SINCE_HOURS) -> DataFrame:
    """Streaming source with watermark and per-id dedup within it."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(path)
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, f"{since_hours} hours").dropDuplicatesWithinWatermark([key])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the stored table has been created.  Only its absence means a
    first batch; any other error is raised."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def merge_batch(batch: DataFrame, table_path: str, key: str, ts: str | None = None) -> None:
    """foreachBatch sink: insert rows whose key is not stored yet.  With a
    time column ``ts`` the caller asserts that a key's time never changes;
    only stored rows as recent as the batch's oldest are read then, and a
    stored key that comes with a later time would be inserted again."""
    spark = batch.sparkSession
    new = batch
    if table_exists(spark, table_path):
        stored = spark.read.parquet(table_path)
        if ts is not None:
            oldest = batch.agg(F.min(ts)).first()[0]
            stored = stored.where(F.col(ts) >= F.lit(oldest)) if oldest is not None else stored
        new = batch.join(stored.select(key), key, "left_anti")
    new.write.mode("append").parquet(table_path)


def run_ingest(stream: DataFrame, table_path: str, key: str = "id",
               checkpoint: str | None = None, ts: str | None = None) -> str:
    """Drain the available files once (``availableNow``) into the table."""
    spark = stream.sparkSession
    ck = checkpoint or scratch_path(spark, "ingest-checkpoint")
    q = (stream.writeStream.foreachBatch(lambda b, _id: merge_batch(b, table_path, key, ts))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return table_path


def ingest_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` file as a stream of posts, ingested into a
    fresh table under the shared checkpoint directory."""
    from ..sources.tables import table
    schema = table(spark, sf_dir, "events").schema
    s = stream_posts(spark, sf_dir, schema, glob="events.parquet", ts="ts", key="event_id")
    out = run_ingest(s.select("event_id", "ts", "user_id", "event_type", "value"),
                     scratch_path(spark, "events-ingested"), key="event_id", ts="ts")
    return spark.read.parquet(out)


def enriched(posts: DataFrame) -> DataFrame:
    """ST2: preprocessing and behaviour flags, per row, on a stream (or
    batch) of posts with ``id``, ``title``, ``body``, ``content``."""
    return behaviour_flags(preprocess(posts))


def upsert_batch(batch: DataFrame, batch_id: int, table_path: str, late_path: str, key: str, set_cols: list[str],
                 ts: str, cutoff, order: list[str] | None = None) -> None:
    """foreachBatch sink with the F1 cutoff and K1: rows older than ``cutoff``
    (and those without a time) go to ``late_path``, under the batch's number;
    the others are upserted into the keyed table.  The batch is written once
    and both read that copy.  A replayed batch leaves both tables as they
    were."""
    rows = stored(batch, "batch")
    fresh = F.coalesce(F.col(ts) >= F.lit(cutoff).cast("timestamp"), F.lit(False))
    rows.where(~fresh).write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
    new = rows.where(fresh)
    if table_exists(batch.sparkSession, table_path):
        keyed.upsert_into(table_path, new, key, set_cols, order)
    else:
        keyed.create(latest_per_key(new.where(F.col(key).isNotNull()), key, order), table_path, key)


def run_upserts(stream: DataFrame, table_path: str, late_path: str, key: str, set_cols: list[str], ts: str, cutoff,
                order: list[str] | None = None, checkpoint: str | None = None) -> DataFrame:
    """ST1, ST3: drain the available files once into the keyed table and give
    the number of late rows of every batch so far (batch, late)."""
    spark = stream.sparkSession
    q = (stream.writeStream.foreachBatch(lambda b, n: upsert_batch(
            b, n, table_path, late_path, key, set_cols, ts, cutoff, order))
         .option("checkpointLocation", checkpoint or scratch_path(spark, "upsert-checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    late = spark.read.schema(StructType(list(stream.schema.fields)).add("batch", "long")).parquet(late_path)
    return late.groupBy("batch").agg(F.count("*").alias("late"))
