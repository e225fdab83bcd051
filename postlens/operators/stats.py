"""Corpus and per-community statistics.

All of these are ``groupBy`` aggregations with map-side partial
aggregation.  Percentages need the group total; it is attached with a
window over the *already aggregated* rows (one row per label per group),
so the window never sees raw posts.  Top-k lists use a total order (count
desc, then term asc) and ``row_number() <= k``, which Spark plans with a
group limit before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

FLAG_NAMES = ("spam", "offensive", "promotional", "question", "discussion")
UNKNOWN_LABEL = "Unknown"


def _w(group):
    return Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))


def _with_absent(agg: DataFrame, group: list[str], labels: tuple[str, ...]) -> DataFrame:
    """Add rows with count 0 for the labels that a group does not have."""
    spread = agg.groupBy(*group).agg(F.first("total").alias("total"),
                                     F.collect_set("label").alias("__has"))
    absent = spread.select(*group, "total", F.explode(F.array_except(
        F.array(*[F.lit(x) for x in labels]), "__has")).alias("label"))
    return agg.unionByName(absent.select(*group, "label", F.lit(0).cast("bigint").alias("count"),
                                         F.lit(0.0).alias("__sum"), "total"))


def label_stats(df: DataFrame, label: Column, score: Column | None = None,
                group: list[str] = (), avg_labels: tuple[str, ...] | None = None,
                decimals: int = 3) -> DataFrame:
    """G1/G2/G3 (and G9/G11/G13 with ``group``): per label count, percent of
    the group's posts (2 decimals) and mean confidence (``decimals``).  With
    ``avg_labels`` the mean is only reported for those labels (0.0 when
    absent), as the sentiment summary does."""
    group = list(group)
    base = df.select(*group, F.coalesce(label, F.lit(UNKNOWN_LABEL)).alias("label"),
                     (score if score is not None else F.lit(None).cast("double")).alias("__s"))
    agg = base.groupBy(*group, "label").agg(F.count(F.lit(1)).alias("count"),
                                            F.sum(F.coalesce("__s", F.lit(0.0))).alias("__sum"))
    agg = agg.withColumn("total", F.sum("count").over(_w(group)))
    avg = F.round(F.col("__sum") / F.col("count"), decimals)
    if avg_labels is not None:
        avg = F.when(F.col("label").isin(*avg_labels), avg)
        agg = _with_absent(agg, group, avg_labels)
        avg = F.when(F.col("count") == 0, F.lit(0.0)).otherwise(avg)
    extra = [avg.alias("average_confidence")] if score is not None else []
    return agg.select(*group, "label", "count",
                      F.round(F.col("count") / F.col("total") * 100, 2).alias("percentage"),
                      "total", *extra)


def dominant(stats: DataFrame, group: list[str]) -> DataFrame:
    """Most frequent label per group (ties: label ascending)."""
    w = Window.partitionBy(*group).orderBy(F.col("count").desc(), F.col("label").asc())
    return stats.withColumn("__r", F.row_number().over(w)).where("__r = 1") \
        .select(*group, F.col("label").alias("dominant"))


def flag_stats(df: DataFrame, flags: str = "flags", group: list[str] = ()) -> DataFrame:
    """Count and percent of posts with each boolean flag."""
    group = list(group)
    agg = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total"),
                                 *[F.count_if(F.coalesce(F.col(f"{flags}.{f}"), F.lit(False))).alias(f)
                                   for f in FLAG_NAMES])
    stack = ", ".join(f"'{f}', `{f}`" for f in FLAG_NAMES)
    long = agg.select(*group, "total", F.expr(f"stack({len(FLAG_NAMES)}, {stack}) as (flag, count)"))
    return long.select(*group, "flag", F.col("count").cast("long").alias("count"),
                       F.round(F.col("count") / F.col("total") * 100, 2).alias("percentage"), "total")


def term_totals(df: DataFrame, keywords: str = "keywords", hashtags: str = "hashtags",
                group: list[str] = ()) -> DataFrame:
    """G6/G12 totals: posts, extracted keywords and hashtags, per-post means."""
    group = list(group)
    kc = F.coalesce(F.size(keywords), F.lit(0))
    hc = F.coalesce(F.size(hashtags), F.lit(0))
    agg = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total_posts"),
                                 F.sum(kc).cast("long").alias("total_keywords"),
                                 F.sum(hc).cast("long").alias("total_hashtags"))
    return agg.select(*group, "total_posts", "total_keywords", "total_hashtags",
                      F.round(F.col("total_keywords") / F.col("total_posts"), 2).alias("avg_keywords_per_post"),
                      F.round(F.col("total_hashtags") / F.col("total_posts"), 2).alias("avg_hashtags_per_post"))


def entity_stats(df: DataFrame, group: list[str] = ()) -> DataFrame:
    """G5/G10 totals: posts with entities, entities found and linked, link
    rate (2 decimals, 0 when none), mean entities per post (2 decimals)."""
    group = list(group)
    agg = df.groupBy(*group).agg(F.count(F.lit(1)).alias("total_posts_with_entities"),
                                 F.sum("entity_count").cast("long").alias("total_entities_found"),
                                 F.sum("linked_entity_count").cast("long").alias("total_entities_linked"))
    return agg.select(
        *group, "total_posts_with_entities", "total_entities_found", "total_entities_linked",
        F.when(F.col("total_entities_found") > 0,
               F.round(F.col("total_entities_linked") / F.col("total_entities_found") * 100, 2))
        .otherwise(F.lit(0.0)).alias("link_success_rate"),
        F.round(F.col("total_entities_found") / F.col("total_posts_with_entities"), 2)
        .alias("avg_entities_per_post"))


def entity_type_counts(df: DataFrame, group: list[str] = (), field: str = "type",
                       k: int = 10) -> DataFrame:
    """Top-k linked entity types (or texts with ``field='entity'``)."""
    from .keywords import top_terms
    ex = df.select(*group, F.transform("linked_entities", lambda e: e[field]).alias("__v"))
    return top_terms(ex, "__v", n=k, group=list(group) or None, term_name=field)


def summary_stats(df: DataFrame, text: str = "summary", group: list[str] = ()) -> DataFrame:
    """Number of summaries and mean length in words (2 decimals)."""
    group = list(group)
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("total_summaries"),
        F.round(F.avg(T.word_count(F.col(text))), 2).alias("avg_summary_length_words"))


def community_metadata(df: DataFrame, group: str = "subreddit") -> DataFrame:
    """Posts, distinct non-empty authors, score/comment totals and
    means (2 decimals) per community."""
    cols = df.columns
    score = F.coalesce(F.col("score"), F.lit(0)) if "score" in cols else F.lit(0)
    comments = F.coalesce(F.col("num_comments"), F.lit(0)) if "num_comments" in cols else F.lit(0)
    author = F.col("author") if "author" in cols else F.lit(None).cast("string")
    agg = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.count_distinct(F.when(author != "", author)).alias("unique_authors"),
        F.sum(score).alias("total_score"), F.sum(comments).cast("long").alias("total_comments"))
    return agg.select(group, F.concat(F.lit("r/"), F.col(group)).alias("subreddit_name"),
                      "total_posts", "unique_authors",
                      F.round(F.col("total_score") / F.col("total_posts"), 2).alias("avg_score"),
                      F.round(F.col("total_comments") / F.col("total_posts"), 2).alias("avg_comments"),
                      "total_score", "total_comments")


def daily_trend(df: DataFrame, ts: str, score: Column, group: list[str] = (), decimals: int = 4) -> DataFrame:
    """Per calendar date (UTC) mean of a score and number of posts."""
    group = list(group)
    return df.groupBy(*group, F.to_date(ts).alias("date")).agg(
        F.round(F.avg(score), decimals).alias("mean_score"), F.count(F.lit(1)).alias("count"))
