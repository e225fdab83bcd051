"""Reporting tables: per-post summaries (JN1) and dashboard counters (G19);
overview and community summaries are in ``summaries``.

JN1 is a chain of left equi-joins on ``post_id``.  Every enrichment is
first reduced to one row per key (last record wins), which hash-partitions
it on ``post_id``; the joins then reuse that partitioning, so each input
is shuffled once and the chain adds no further exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import stats as ST
from ..session import scratch_path

_SCORED = "struct<label:string,confidence:double,all_scores:map<string,double>>"
PART_TYPES = {
    "sentiment_analysis": _SCORED,
    "named_entities": ("struct<entity_count:int,linked_count:int,entities:array<struct<entity:string,"
                       "type:string,wikipedia_title:string,wikipedia_url:string,snippet:string>>>"),
    "emotion_detection": _SCORED,
    "keywords_hashtags": "struct<keywords:array<string>,hashtags:array<string>,keyword_count:int,hashtag_count:int>",
    "topic_classification": "struct<label:string,confidence:double>",
    "behavior_flags": "struct<spam:boolean,offensive:boolean,promotional:boolean,question:boolean,discussion:boolean>",
    "generated_summary": "string",
}


def last_by_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per ``key``; the later record wins ("later" = larger values
    of ``order``, e.g. a processing stamp).  Without an order column any
    one record per key is kept."""
    df = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    order = [c for c in (order or []) if c in df.columns]
    if not order:
        return df.dropDuplicates([key])
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def bucketed(df: DataFrame, name: str, key: str = "post_id", buckets: int = 32) -> DataFrame:
    """``df`` written once as a table bucketed and sorted by ``key`` (as a
    string) under the shared checkpoint folder.  Parts with the same number of
    buckets meet in ``post_summaries`` without an exchange; at 100 TB take the
    number of buckets so that one is about the size of a file."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    at = f"{name}_{path.rsplit('-', 1)[1]}"
    df = df.withColumn(key, F.col(key).cast("string"))
    # rows meet their bucket's writer first, so that each bucket is one file
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
       .option("path", path).option("compression", "zstd").saveAsTable(at))
    return spark.table(at)


def post_summaries(base: DataFrame, sentiment: DataFrame | None = None,
                   entities: DataFrame | None = None, emotion: DataFrame | None = None,
                   keywords: DataFrame | None = None, topics: DataFrame | None = None,
                   flags: DataFrame | None = None, summaries: DataFrame | None = None,
                   key: str = "post_id", posts: DataFrame | None = None) -> DataFrame:
    """JN1: one row per post of ``base`` (the preprocessed table) with the
    seven optional result parts under ``nlp_results``; an absent part is a
    null struct.  Of several records of a part for one post the one with the
    latest stamp (``processed_at``, ``enriched_at``) wins, any one where the
    part has no stamp.  ``posts`` (raw, keyed by ``id``) supplies score,
    comments and url, which the preprocessed table does not carry."""
    b = last_by_key(base, key, ["preprocessed_at"])
    cols = b.columns

    def col_or(name, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in cols else F.lit(default)
    out = b.select(
        F.col(key).cast("string").alias("post_id"),
        col_or("title", "N/A").alias("title"), col_or("subreddit", "unknown").alias("subreddit"),
        col_or("author", "unknown").alias("author"),
        (F.col("created_utc") if "created_utc" in cols else F.lit(None).cast("timestamp")).alias("created_utc"),
        col_or("permalink", "").alias("permalink"))
    if posts is not None:
        pc = posts.columns
        meta = posts.select(F.col("id").cast("string").alias("post_id"),
                            (F.col("score").cast("long") if "score" in pc else F.lit(None).cast("long")).alias("score"),
                            (F.col("num_comments").cast("long") if "num_comments" in pc else F.lit(None).cast("long")).alias("num_comments"),
                            (F.col("url") if "url" in pc else F.lit(None).cast("string")).alias("url"))
        out = out.join(last_by_key(meta, "post_id"), "post_id", "left")
    else:
        out = out.select("*", F.lit(None).cast("long").alias("score"),
                         F.lit(None).cast("long").alias("num_comments"), F.lit(None).cast("string").alias("url"))
    out = out.withColumn("score", F.coalesce("score", F.lit(0))) \
             .withColumn("num_comments", F.coalesce("num_comments", F.lit(0))) \
             .withColumn("url", F.coalesce("url", F.lit("")))

    parts = []

    def attach(df, kcol, name, value, stamp=None):
        nonlocal out
        if df is None:
            parts.append(F.lit(None).cast(PART_TYPES[name]).alias(name))
            return
        p = last_by_key(df.withColumn("__k", F.col(kcol).cast("string")), "__k", stamp) \
            .select(F.col("__k").alias("post_id"), value.alias(f"__p_{name}"))
        out = out.join(p, "post_id", "left")
        parts.append(F.col(f"__p_{name}").alias(name))

    attach(sentiment, key, "sentiment_analysis", F.struct(
        F.coalesce(F.col("sentiment.label"), F.lit("N/A")).alias("label"),
        F.coalesce(F.col("sentiment.score"), F.lit(0.0)).alias("confidence"),
        F.col("sentiment.scores").alias("all_scores")), ["processed_at"])
    attach(entities, key, "named_entities", F.struct(
        F.coalesce(F.col("entity_count"), F.lit(0)).alias("entity_count"),
        F.coalesce(F.col("linked_entity_count"), F.lit(0)).alias("linked_count"),
        F.transform(F.col("linked_entities"), lambda e: F.struct(
            e["entity"].alias("entity"), e["type"].alias("type"),
            e["wikipedia"]["title"].alias("wikipedia_title"), e["wikipedia"]["url"].alias("wikipedia_url"),
            e["wikipedia"]["snippet"].alias("snippet"))).alias("entities")), ["processed_at"])
    attach(emotion, "id" if emotion is not None and "id" in emotion.columns else key, "emotion_detection",
           F.struct(F.coalesce(F.col("emotion.label"), F.lit("N/A")).alias("label"),
                    F.coalesce(F.col("emotion.score"), F.lit(0.0)).alias("confidence"),
                    F.col("emotion.scores").alias("all_scores")), ["processed_at"])
    attach(keywords, key, "keywords_hashtags", F.struct(
        F.coalesce(F.col("keywords"), F.array().cast("array<string>")).alias("keywords"),
        F.coalesce(F.col("hashtags"), F.array().cast("array<string>")).alias("hashtags"),
        F.coalesce(F.size("keywords"), F.lit(0)).alias("keyword_count"),
        F.coalesce(F.size("hashtags"), F.lit(0)).alias("hashtag_count")), ["enriched_at"])
    attach(topics, "id" if topics is not None and "id" in topics.columns else key, "topic_classification",
           F.struct(F.coalesce(F.col("topic.label"), F.lit("N/A")).alias("label"),
                    F.coalesce(F.col("topic.score"), F.lit(0.0)).alias("confidence")), ["processed_at"])
    attach(flags, key, "behavior_flags", F.col("flags"), ["processed_at"])
    attach(summaries, "id" if summaries is not None and "id" in summaries.columns else key,
           "generated_summary", F.coalesce(F.col("summary"), F.lit("")), ["processed_at"])
    keep = ["post_id", "title", "subreddit", "author", "created_utc", "score", "num_comments",
            "permalink", "url"]
    return out.select(*keep, F.struct(*parts).alias("nlp_results"))


def sort_summaries(ps: DataFrame) -> DataFrame:
    """L1: by community, then title, then id (a total order)."""
    return ps.orderBy("subreddit", "title", "post_id")


def dashboard_stats(ps: DataFrame, k: int = 5) -> DataFrame:
    """One row -- total posts, top-5 sentiment / emotion / topic labels
    (missing part -> 'Unknown'), spam and offensive counts."""
    def mapped(label, name):
        ranked = (ps.select(F.coalesce(label, F.lit(ST.UNKNOWN_LABEL)).alias("label"))
                    .groupBy("label").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("r", F.row_number().over(
                        Window.partitionBy(F.lit(1)).orderBy(F.col("n").desc(), F.col("label").asc())))
                    .where(F.col("r") <= k))
        return ranked.agg(F.map_from_entries(F.transform(
            F.array_sort(F.collect_list(F.struct("r", "label", "n"))),
            lambda x: F.struct(x["label"], x["n"]))).alias(name))

    tot = ps.agg(F.count(F.lit(1)).alias("total_posts"),
                 F.count_if(F.coalesce(F.col("nlp_results.behavior_flags.spam"), F.lit(False))).alias("spam_count"),
                 F.count_if(F.coalesce(F.col("nlp_results.behavior_flags.offensive"), F.lit(False))).alias("offensive_count"))
    s = mapped(F.col("nlp_results.sentiment_analysis.label"), "sentiment_distribution")
    e = mapped(F.col("nlp_results.emotion_detection.label"), "emotion_distribution")
    t = mapped(F.col("nlp_results.topic_classification.label"), "topic_distribution")
    # one-row frames: joined on a constant key (each side has exactly one row)
    one = F.lit(1)
    return (tot.withColumn("__k", one).join(s.withColumn("__k", one), "__k")
               .join(e.withColumn("__k", one), "__k").join(t.withColumn("__k", one), "__k").drop("__k"))
