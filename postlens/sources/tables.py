"""Driver tables and their mapping onto the post data model.

The post model (see FIXTURES.md) has ``id, title, body, content,
subreddit, author, created_utc, score, num_comments``.  The driver tables
stand in for it:

* ``documents``: doc_id -> id, first line of text -> title, the rest ->
  body, whole text -> content, source -> subreddit, lang -> language.
* ``events``: event_id -> id, user_id -> author, ts -> created_utc,
  event_type -> subreddit, value -> score.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


# Tables whose per-row work is CPU-heavy text processing.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark")


def balance(df: DataFrame) -> DataFrame:
    """Spread rows over the cluster when the scan yields fewer partitions
    than there are task slots.  Only for local tests and the bench, whose
    tables have one row group (``spark.postlens.balanceScans``, which
    ``local_session`` sets); elsewhere a scan is left as it is."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if name in TEXT_TABLES and spark.conf.get("spark.postlens.balanceScans", "false") == "true":
        return balance(df)
    return df


def _first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def _after_first_line(text: Column) -> Column:
    # everything after the first newline, '' when there is none
    at = F.instr(text, "\n")
    return F.when(at > 0, F.substr(text, at + 1)).when(text.isNotNull(), F.lit(""))


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as posts.  Pure projection: pruning and pushdown reach
    the Parquet scan."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id"),
        _first_line(F.col("text")).alias("title"),
        _after_first_line(F.col("text")).alias("body"),
        F.col("text").alias("content"),
        F.col("source").alias("subreddit"),
        F.col("lang").alias("language"),
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as posts for time/author statistics."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("event_id"),
        F.col("user_id").cast("string").alias("author"),
        F.col("ts").alias("created_utc"),
        F.col("event_type").alias("subreddit"),
        F.col("value").alias("score"),
        F.col("props"),
    )


# DuckDB counterparts used by the oracle SQL (same mapping, same names).
SQL_DOCUMENT_POSTS = """
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id,
         split_part(text, chr(10), 1) AS title,
         regexp_replace(text, '^[^\n]*\n?', '') AS body,
         text AS content, source AS subreddit, lang AS language
  FROM documents
"""

SQL_EVENT_POSTS = """
  SELECT CAST(event_id AS VARCHAR) AS id, event_id,
         CAST(user_id AS VARCHAR) AS author, ts AS created_utc,
         event_type AS subreddit, value AS score, props
  FROM events
"""
