"""Incremental ingest of post drops.

Batch form: keep the drop's posts of the configured communities that are
not older than the cutoff and not already stored (left anti-join on the
key), and count scanned / kept / skipped per community.  The streaming
form is in ``postlens.streaming.ingest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.sinks import latest_per_key
from . import eda as EDA

# Default look-back window (hours) of the feed.
DEFAULT_SINCE_HOURS = 720


def incremental_ingest(new: DataFrame, existing: DataFrame, cutoff: Column,
                       communities: list[str] | None = None, key: str = "id",
                       ts: str = "created_utc", group: str = "subreddit",
                       fixed_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """Returns (rows to insert, per-community counters).  ``scanned`` counts
    the drop's posts at or after the cutoff (an id that the drop repeats is
    one post, the latest record), ``skipped`` those already stored, ``kept`` =
    ``inserted`` the new ones.  All stored keys are compared, unless the caller
    asserts by ``fixed_time`` that an id's time never changes: then a stored
    post older than the cutoff cannot meet a kept one, and the stored table
    is pruned by it."""
    feed = new
    if communities is not None:
        feed = feed.where(F.col(group).isin(*communities))
    feed = latest_per_key(feed.where(F.col(ts) >= cutoff), key, [ts])
    known = existing.where(F.col(ts) >= cutoff) if fixed_time and ts in existing.columns else existing
    known = known.select(F.col(key).alias("__known")).distinct()
    marked = feed.join(known, feed[key] == known["__known"], "left")
    rows = marked.where(F.col("__known").isNull()).drop("__known")
    counters = marked.groupBy(group).agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(F.col("__known").isNull()).alias("kept"),
        F.count_if(F.col("__known").isNotNull()).alias("skipped"))
    counters = counters.select(group, "scanned", "kept", F.col("kept").alias("inserted"), "skipped",
                               F.round(F.col("skipped") * 100.0 / F.greatest(F.col("scanned"), F.lit(1)), 1)
                               .alias("pct_skipped"))
    return rows, counters


def post_key(*names: str) -> Column:
    """The first of these columns that is not null or empty, as a
    string (``post_id``, ``id``, ``_id`` by default)."""
    return F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names or ("post_id", "id", "_id")])


def normalize_posts(raw: DataFrame, site: str, ts: str = "created_utc") -> DataFrame:
    """Raw feed posts (id, author, title, selftext, is_self,
    permalink, subreddit, ``ts``) as stored posts.  A missing title is empty,
    the body belongs to self posts alone, an empty hashtag list is null, the
    time is ISO with Z, and the permalink gets the site in front."""
    title = F.coalesce("title", F.lit(""))
    body = F.when(F.col("is_self"), F.coalesce("selftext", F.lit(""))).otherwise("")
    tags = F.array_sort(F.array_union(T.hashtags_a(title), T.hashtags_a(body)))
    key = F.col("id").cast("string")
    return raw.select(
        key.alias("_id"), key.alias("id"), "author", title.alias("title"),
        T.build_content(title, body).alias("content"), F.when(F.size(tags) > 0, tags).alias("hashtags"),
        EDA.iso_z(F.col(ts)).alias("created_utc"), F.when(F.col("is_self"), body).alias("body"),
        "subreddit", F.concat(F.lit(site), "permalink").alias("permalink"), "is_self")
