"""Post search and display rows.

A search is one ``where`` over the post-summary table (Catalyst prunes the
nested columns it does not read); the page is a top-k by a total order and
the total is a scalar count of the same filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

# Search kinds, result cap, log retention and page size.
SEARCH_KINDS = ("all", "keyword", "hashtag", "spam", "offensive", "sentiment", "emotion", "topic")
FLAG_KINDS = ("spam", "offensive")
RESULT_CAP = 100
LOG_KEEP, LOG_SHOW = 50, 20
N = "nlp_results"


def _any_contains(arr: Column, q: str) -> Column:
    return F.coalesce(F.exists(arr, lambda x: F.contains(F.lower(x), F.lit(q))), F.lit(False))


def search_predicate(q: str, kind: str = "all") -> Column:
    """the filter of one search kind; unknown kinds match nothing."""
    ql = q.lower()
    kw = F.col(f"{N}.keywords_hashtags.keywords")
    ht = F.col(f"{N}.keywords_hashtags.hashtags")
    if kind == "all":
        ents = F.transform(F.col(f"{N}.named_entities.entities"), lambda e: F.coalesce(e["entity"], F.lit("")))
        return (T.icontains(F.col("title"), ql) | _any_contains(kw, ql) | _any_contains(ht, ql)
                | _any_contains(ents, ql) | T.icontains(F.col(f"{N}.generated_summary"), ql))
    if kind == "keyword":
        return _any_contains(kw, ql)
    if kind == "hashtag":
        return _any_contains(ht, ql)
    if kind in FLAG_KINDS:
        return F.coalesce(F.col(f"{N}.behavior_flags.{kind}"), F.lit(False))
    part = {"sentiment": "sentiment_analysis", "emotion": "emotion_detection",
            "topic": "topic_classification"}.get(kind)
    if part is None:
        return F.lit(False)
    return T.icontains(F.col(f"{N}.{part}.label"), ql)


def labelled(df: DataFrame, part: str, label: str | None = None, least: float | None = None,
             community: str | None = None, group: str = "subreddit") -> DataFrame:
    """F8: rows of an enrichment whose struct ``part`` has this label, at
    least this score, in this community (each where given)."""
    if label is not None:
        df = df.where(F.col(f"{part}.label") == label)
    if least is not None:
        df = df.where(F.col(f"{part}.score") >= least)
    if community is not None:
        df = df.where(F.col(group) == community)
    return df


def mentioned(df: DataFrame, type_: str | None = None, pattern: str | None = None,
              ents: str = "linked_entities") -> DataFrame:
    """posts with an entity of this type and of a text that matches the
    regular expression, upper and lower case alike (each where given)."""
    def fits(e):
        ok = F.lit(True)
        if type_ is not None:
            ok = ok & (e["type"] == type_)
        if pattern is not None:
            ok = ok & e["entity"].rlike(f"(?i){pattern}")
        return ok

    return df.where(F.exists(F.col(ents), fits))


def check_query(q: str | None, kind: str) -> str:
    """trimmed query; empty is rejected except for flag searches."""
    q = (q or "").strip()
    if not q and kind not in FLAG_KINDS:
        raise ValueError("empty search query")
    return q


def search(ps: DataFrame, q: str, kind: str = "all") -> DataFrame:
    return ps.where(search_predicate(check_query(q, kind), kind))


def display_rows(df: DataFrame) -> DataFrame:
    """Display projection -- confidences x100 to 1 decimal, first 10
    keywords, first 5 hashtags and entities."""
    sent, emo = f"{N}.sentiment_analysis", f"{N}.emotion_detection"
    return df.select(
        "post_id", "title", "subreddit", "author", F.coalesce("score", F.lit(0)).alias("score"),
        F.coalesce("num_comments", F.lit(0)).alias("num_comments"), "permalink",
        F.coalesce(F.col(f"{sent}.label"), F.lit("N/A")).alias("sentiment_label"),
        F.round(F.coalesce(F.col(f"{sent}.confidence"), F.lit(0.0)) * 100, 1).alias("sentiment_confidence"),
        F.coalesce(F.col(f"{emo}.label"), F.lit("N/A")).alias("emotion_label"),
        F.round(F.coalesce(F.col(f"{emo}.confidence"), F.lit(0.0)) * 100, 1).alias("emotion_confidence"),
        F.coalesce(F.col(f"{N}.topic_classification.label"), F.lit("N/A")).alias("topic"),
        F.slice(F.coalesce(F.col(f"{N}.keywords_hashtags.keywords"), F.array().cast("array<string>")), 1, 10).alias("keywords"),
        F.slice(F.coalesce(F.col(f"{N}.keywords_hashtags.hashtags"), F.array().cast("array<string>")), 1, 5).alias("hashtags"),
        F.transform(F.slice(F.coalesce(F.col(f"{N}.named_entities.entities"),
                                       F.array().cast("array<struct<entity:string,type:string,wikipedia_title:string,wikipedia_url:string,snippet:string>>")), 1, 5),
                    lambda e: F.struct(e["entity"].alias("name"), e["type"].alias("type"),
                                       e["wikipedia_url"].alias("wiki_url"))).alias("entities"),
        F.col(f"{N}.behavior_flags").alias("flags"),
        F.coalesce(F.col(f"{N}.generated_summary"), F.lit("")).alias("summary"))


def search_page(ps: DataFrame, q: str, kind: str = "all", cap: int = RESULT_CAP) -> tuple[DataFrame, int]:
    """The first ``cap`` hits in (community, title, id) order and the
    total number of hits before the cap."""
    hits = search(ps, q, kind)
    total = hits.count()
    page = hits.orderBy("subreddit", "title", "post_id").limit(cap)
    return display_rows(page), total


def log_search(spark, path: str, q: str, kind: str, result_count: int, at=None) -> None:
    """K7: append one entry to the search log table."""
    row = spark.createDataFrame([(q, kind, int(result_count))], "query string, type string, result_count long")
    row = row.withColumn("timestamp", F.lit(at).cast("timestamp") if at is not None else F.current_timestamp())
    row.write.mode("append").parquet(path)


def recent_searches(log: DataFrame, keep: int = LOG_KEEP, show: int = LOG_SHOW) -> DataFrame:
    """Retention keeps the newest ``keep`` entries; the newest ``show``
    are returned, newest first."""
    w = Window.orderBy(F.col("timestamp").desc(), F.col("query"))
    kept = log.orderBy(F.col("timestamp").desc(), F.col("query")).limit(keep)
    return kept.orderBy(F.col("timestamp").desc(), F.col("query")).limit(show) \
        .withColumn("position", F.row_number().over(w))
