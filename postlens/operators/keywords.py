"""Keyword, hashtag and mention extraction.

Per-document work (top-k keywords of one post) is done *inside the row*: a
document is already one row, so no shuffle is needed to count its tokens.  Only corpus-level statistics
(term counts over many posts) shuffle, and they pre-aggregate map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrow as AR
from ..functions import text as T


def with_topk(df: DataFrame, values: Column, k: int, out: str) -> DataFrame:
    """Add ``out``: the ``k`` most frequent entries of the array ``values``,
    most frequent first, ties by first appearance (Python
    ``Counter.most_common`` on a list).

    Sort (value, position) pairs, find run starts, rank runs by
    (-length, first position): O(n log n) per row, all in the JVM, no
    shuffle.  The intermediate arrays are separate projected columns:
    lambdas re-evaluate any non-attribute expression they reference, so
    they must only see attributes (CollapseProject keeps these projections
    apart because the arrays are referenced more than once).
    """
    z, st, runs = f"__{out}_z", f"__{out}_starts", f"__{out}_runs"
    df = df.withColumn(z, F.array_sort(F.transform(
        values, lambda t, i: F.struct(t.alias("t"), i.alias("p")))))
    n = F.size(F.col(z))
    df = df.withColumn(st, F.when(
        n > 0,
        F.filter(F.sequence(F.lit(0), n - 1),
                 lambda i: F.coalesce(F.get(F.col(z), i)["t"] != F.get(F.col(z), i - 1)["t"],
                                      F.lit(True))),
    ).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(runs, F.transform(
        F.col(st),
        lambda s, j: F.struct(
            (s - F.coalesce(F.get(F.col(st), j + 1), n)).alias("neg_count"),
            F.get(F.col(z), s)["p"].alias("first_pos"),
            F.get(F.col(z), s)["t"].alias("term"),
        ),
    ))
    df = df.withColumn(out, F.transform(F.slice(F.array_sort(F.col(runs)), 1, k),
                                        lambda r: r["term"]))
    return df.drop(z, st, runs)


def null_if_empty(a: Column) -> Column:
    """An empty list is stored as null."""
    return F.when(F.size(a) > 0, a)


def _top_tokens(text: Column, k: int) -> Column:
    return AR.top_tokens(text, T.STOPWORDS, k)


def keywords_topk(df: DataFrame, text: str = "content", k: int = 10,
                  out: str = "keywords") -> DataFrame:
    """Top-``k`` non-stop-word tokens of ``text`` (null when none)."""
    return df.withColumn(out, _top_tokens(F.col(text), k)).withColumn(out, null_if_empty(F.col(out)))


def enrich_keywords(posts: DataFrame, title: str = "title", body: str = "body",
                    key: str = "id", k: int = 10) -> DataFrame:
    """Keyword job: hashtags (model A, title tags U body tags), mentions
    (model A) and top-10 keywords of the content; empty lists -> null."""
    tags = F.array_sort(F.array_union(T.hashtags_a(F.col(title)), T.hashtags_a(F.col(body))))
    base = posts.select(
        F.col(key).alias("post_id"),
        *[c for c in ("subreddit", "author", "created_utc", "permalink") if c in posts.columns],
        F.col(title).alias("title"),
        T.build_content(F.col(title), F.col(body)).alias("__content"),
        null_if_empty(tags).alias("hashtags"),
    )
    base = base.withColumn("keywords", _top_tokens(F.col("__content"), k))
    return (base.withColumn("mentions", null_if_empty(T.mentions_a(F.col("__content"))))
                .withColumn("keywords", null_if_empty(F.col("keywords")))
                .drop("__content"))


def extract_terms_b(posts: DataFrame, title: str = "title", body: str = "body",
                    key: str = "id") -> DataFrame:
    """Model-B extraction: text = title + ' ' + body (body when non-empty);
    hashtags without '#', duplicates kept; mentions without '@'.  Lists are
    never null."""
    t = F.concat(F.coalesce(F.col(title), F.lit("")),
                 F.when(F.coalesce(F.col(body), F.lit("")) != "",
                        F.concat(F.lit(" "), F.col(body))).otherwise(F.lit("")))
    return posts.select(
        F.col(key).alias("post_id"),
        *[c for c in ("subreddit", "author", "created_utc") if c in posts.columns],
        T.hashtags_b(t).alias("hashtags"),
        T.mentions_b(t).alias("mentions"),
    )


def top_terms(df: DataFrame, col: str, n: int = 100, group: list[str] | None = None,
              term_name: str = "term") -> DataFrame:
    """Corpus term counts of an array column, top ``n`` per group,
    ties by term ascending (a total order, reproducible on a cluster).

    explode -> partial/final count (map-side combine) -> ranked top-n.
    Spark plans the ``row_number() <= n`` filter with a group limit on both
    sides of the exchange, so a hot group never ships all its terms.
    """
    group = list(group or [])
    # explode_outer + filter above the generator: a plain explode makes the
    # optimizer infer ``size(col) > 0`` and push it below the projection
    # that computes ``col``, which would evaluate the array twice.
    terms = (df.select(*group, F.explode_outer(F.col(col)).alias(term_name))
               .where(F.col(term_name).isNotNull() & (F.col(term_name) != "")))
    counts = terms.groupBy(*group, term_name).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*group).orderBy(F.col("count").desc(), F.col(term_name).asc()) \
        if group else Window.orderBy(F.col("count").desc(), F.col(term_name).asc())
    if not group:
        # global top-n: TakeOrderedAndProject keeps n rows per partition, then merges
        ranked = counts.orderBy(F.col("count").desc(), F.col(term_name).asc()).limit(n)
        return ranked.withColumn("rank", F.row_number().over(w).cast("long"))
    return (counts.withColumn("rank", F.row_number().over(w).cast("long"))
                  .where(F.col("rank") <= n))
