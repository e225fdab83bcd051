"""Preprocessing job: P2 text -> language -> translation ->
cleaning.  A language model too large to be held by every task adds a join by
text digest, a translation memory another; everything else is one projection."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import language as L


def preprocess(posts: DataFrame, language_model: PipelineModel | L.TrigramModel | None = None,
               memory: DataFrame | None = None, lang_col: str | None = "language",
               stamp=None) -> DataFrame:
    """One output row per post: identity columns, ``language_detected``,
    ``translated_text``, ``cleaned_text``, ``preprocessed_at``.

    Language comes from ``language_model`` when given, else from an
    existing ``lang_col`` (driver tables carry a label), else ``unknown``.
    """
    cols = posts.columns
    df = posts.withColumn("__text", T.build_text(
        F.col("content") if "content" in cols else F.lit(None).cast("string"),
        F.col("title") if "title" in cols else F.lit(None).cast("string"),
        F.col("body") if "body" in cols else F.lit(None).cast("string")))
    blank = F.coalesce(T.strip_ws(F.col("__text")), F.lit("")) == ""
    if isinstance(language_model, L.TrigramModel):
        df = L.detect_trigrams(df, language_model, text="__text", out="language_detected")
    elif language_model is not None:
        df = L.detect_language(df, language_model, text="__text", out="language_detected")
    elif lang_col and lang_col in cols:
        df = df.withColumn("language_detected",
                           F.when(blank, F.lit(L.UNKNOWN)).otherwise(F.coalesce(F.col(lang_col),
                                                                                F.lit(L.UNKNOWN))))
    else:
        df = df.withColumn("language_detected", F.lit(L.UNKNOWN))
    df = L.apply_translations(df, memory, text="__text", lang="language_detected")
    keep = [c for c in ("_id", "subreddit", "author", "created_utc", "permalink", "title") if c in cols]
    return df.select(
        F.coalesce(F.col("_id"), F.col("id")).alias("_id") if "_id" in cols else F.col("id").alias("_id"),
        F.col("id").alias("post_id"),
        *[c for c in keep if c != "_id"],
        "language_detected", "translated_text",
        T.clean_text(F.col("translated_text")).alias("cleaned_text"),
        (F.lit(stamp).cast("timestamp") if stamp is not None else F.current_timestamp()).alias("preprocessed_at"),
    )
