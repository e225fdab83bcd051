"""Language identification and translation memory.

C9 is re-aimed from a per-row detector library to a distributed model:
character trigrams of each text are hashed into a fixed feature space
(``NGram`` + ``HashingTF``) and a multinomial ``NaiveBayes`` is fit on the
labelled texts.  Training is one distributed aggregation; scoring is a
per-row dot product against the broadcast model, so it never shuffles.
The model size is bounded by ``num_features x languages``, independent of
the data size.

``fit_trigrams`` is the same model without hashed features: a table of exact
trigrams with one Laplace log weight per language, and one weight per
language for trigrams that training never met.  Weights are whole millionths,
so a text's sums are exact in any order; scoring counts (text, trigram) pairs
of distinct texts, meets the table in one equi-join and sums.

C10 replaces a per-row web call with a translation-memory table.  Only the
distinct (language, text digest) pairs that need a translation are looked up;
what is found is joined back by digest.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, NGram, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow as AR
from ..functions import text as T
from ..session import stored

UNKNOWN = "unknown"
NON_TRANSLATED = ("en", UNKNOWN)


def char_trigrams(text: Column) -> Column:
    """Padded, lower-cased character trigrams as an array of strings
    (``' ab', 'abc', ...``), whole text, whitespace collapsed."""
    t = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "),
                 F.lit(" "))
    return F.split(t, "")


def fit_language_model(df: DataFrame, text: str = "text", lang: str = "lang",
                       num_features: int = 1 << 18, smoothing: float = 1.0) -> PipelineModel:
    """Fit a character-trigram Naive Bayes language identifier."""
    data = df.select(char_trigrams(F.col(text)).alias("__chars"), F.col(lang).alias("__lang")) \
        .where(F.col("__lang").isNotNull())
    indexer = StringIndexer(inputCol="__lang", outputCol="__label", handleInvalid="skip")
    stages = [
        indexer,
        NGram(n=3, inputCol="__chars", outputCol="__grams"),
        HashingTF(inputCol="__grams", outputCol="__features", numFeatures=num_features),
        NaiveBayes(featuresCol="__features", labelCol="__label", predictionCol="__pred",
                   probabilityCol="__prob", rawPredictionCol="__raw",
                   smoothing=smoothing, modelType="multinomial"),
    ]
    model = Pipeline(stages=stages).fit(data)
    labels = model.stages[0].labels
    return PipelineModel(stages=model.stages + [
        IndexToString(inputCol="__pred", outputCol="__lang_pred", labels=labels)])


def detect_language(df: DataFrame, model: PipelineModel, text: str = "text",
                    out: str = "language_detected") -> DataFrame:
    """Predicted language code; blank text -> ``unknown``."""
    # the first stage indexes training labels; scoring starts after it
    scorer = PipelineModel(stages=model.stages[1:])
    scored = scorer.transform(df.withColumn("__chars", char_trigrams(F.col(text))))
    blank = F.coalesce(T.strip_ws(F.col(text)), F.lit("")) == ""
    res = scored.withColumn(out, F.when(blank, F.lit(UNKNOWN)).otherwise(F.col("__lang_pred")))
    return res.drop("__chars", "__grams", "__features", "__raw", "__prob", "__pred",
                    "__lang_pred", "__label")


def trigram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The model's sufficient statistics, exactly: occurrences of each
    (language, trigram).  Partial aggregation happens map-side."""
    grams = df.select(F.col(lang).alias("lang"), char_trigrams(F.col(text)).alias("c"))
    grams = grams.select("lang", F.explode_outer(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size("c") - 3, F.lit(0))),
                    lambda i: F.concat(F.get(F.col("c"), i), F.get(F.col("c"), i + 1),
                                       F.get(F.col("c"), i + 2)))).alias("gram"))
    return (grams.where(F.col("gram").isNotNull())
                 .groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("count")))


# Trigrams that every task holds; with more of them texts' trigrams meet them in a join.
GRAMS = 1 << 18
WEIGHT_UNIT = 1_000_000      # a weight of 1 is a millionth of a natural log


class TrigramModel(NamedTuple):
    """``weights(gram, w0, w1, ...)`` in the order of ``languages``, which is
    alphabetical; ``unseen`` and ``prior`` hold a whole number per language."""
    weights: DataFrame
    languages: list[str]
    unseen: list[int]
    prior: list[int]


def text_digest(text: Column) -> Column:
    """SHA-256 of a text, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _is_blank(text: Column) -> Column:
    return T.strip_ws(F.coalesce(text, F.lit(""))) == ""


def fit_trigrams(df: DataFrame, text: str = "text", lang: str = "lang") -> TrigramModel:
    """Trigram weights ``ln((n(gram, lang) + 1) / (n(lang) + V + 1))`` and
    priors ``ln(texts(lang) / texts)`` of the labelled texts; rows without a
    label or with a blank text don't count.  The counts are aggregated on the
    executors and written once; the driver gets one row of totals and one row
    per language."""
    known = df.where(F.col(lang).isNotNull() & ~_is_blank(F.col(text)))
    docs = {r[0]: r[1] for r in known.groupBy(lang).agg(F.count(F.lit(1))).collect()}
    languages = sorted(docs)
    if not languages:
        return TrigramModel(df.sparkSession.createDataFrame([], "gram string"), [], [], [])
    at = range(len(languages))
    counts = stored(trigram_counts(known, text, lang).groupBy("gram").agg(*[
        F.coalesce(F.sum(F.when(F.col("lang") == name, F.col("count"))), F.lit(0)).alias(f"c{i}")
        for i, name in enumerate(languages)]), "trigrams")
    totals = counts.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"t{i}")
                                                        for i in at]).first()
    below = [float(totals[f"t{i}"] + totals["v"] + 1) for i in at]
    weights = counts.select("gram", *[
        F.round(F.log((F.col(f"c{i}") + 1) / F.lit(below[i])) * WEIGHT_UNIT).cast("long").alias(f"w{i}") for i in at])
    n = sum(docs.values())
    return TrigramModel(weights, languages, [round(math.log(1 / b) * WEIGHT_UNIT) for b in below],
                        [round(math.log(docs[name] / n) * WEIGHT_UNIT) for name in languages])


def detect_trigrams(df: DataFrame, model: TrigramModel, text: str = "text",
                    out: str = "language_detected") -> DataFrame:
    """The language with the largest sum of its prior and the weights of
    the whole text's trigrams (ties: first in the alphabet); a blank or null
    text, and any text if the model knows no language, is ``unknown``.

    A model of up to ``GRAMS`` trigrams is held by every task: a text is scored
    where it is.  With a larger one each distinct text is scored once and rows meet
    their label by the text's digest, so keys may repeat or be null.
    Blank texts, which can be many, are spread by row number."""
    if not model.languages:
        return df.withColumn(out, F.lit(UNKNOWN))
    at = range(len(model.languages))
    names = F.array(*[F.lit(x) for x in model.languages])
    held = model.weights.limit(GRAMS + 1).toArrow() if GRAMS else None
    if held is not None and len(held) <= GRAMS:
        places = {g: i for i, g in enumerate(held["gram"].to_pylist())}
        rows = [np.append(held[f"w{i}"].to_numpy(), model.unseen[i]) for i in at]
        table = df.sparkSession.sparkContext.broadcast((places, np.stack(rows, axis=1).astype(np.int64)))
        df = df.withColumn("__sums", AR.trigram_sums(F.lower(F.coalesce(F.col(text), F.lit(""))), table))
        df = df.withColumn("__t", F.array(*[F.get("__sums", i) + F.lit(model.prior[i]) for i in at]))
        best = F.element_at(names, F.array_position("__t", F.array_max("__t")).cast("int"))
        return df.withColumn(out, F.when(_is_blank(F.col(text)), F.lit(UNKNOWN)).otherwise(best)).drop("__sums", "__t")
    digest = text_digest(F.col(text))
    once = (df.where(~_is_blank(F.col(text))).select(digest.alias("__digest"), F.col(text).alias("text"))
              .dropDuplicates(["__digest"]))
    counts = (trigram_counts(once, "text", "__digest").withColumnRenamed("lang", "__digest"))
    sums = counts.join(model.weights, "gram", "left").groupBy("__digest").agg(*[
        F.sum(F.col("count") * F.coalesce(F.col(f"w{i}"), F.lit(model.unseen[i]))).alias(f"s{i}") for i in at])
    total = F.array(*[F.col(f"s{i}") + F.lit(model.prior[i]) for i in at])
    labels = sums.select("__digest", total.alias("t")).select(
        "__digest", F.element_at(names, F.array_position("t", F.array_max("t")).cast("int")).alias(out))
    keyed = df.drop(out).withColumn("__digest", F.when(_is_blank(F.col(text)), _row_key()).otherwise(digest))
    return keyed.join(labels, "__digest", "left").withColumn(
        out, F.coalesce(F.col(out), F.lit(UNKNOWN))).drop("__digest")


def _row_key() -> Column:
    """A key that no digest equals (8 bytes) and that spreads rows."""
    return F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))


def apply_translations(df: DataFrame, memory: DataFrame | None, text: str = "text",
                       lang: str = "language_detected", out: str = "translated_text") -> DataFrame:
    """English text from a translation-memory table
    ``memory(lang, text, translation)``; blank -> ''; English, unknown, null
    language or no entry -> the original text.  Of several entries for one text the
    smallest translation counts; null translations are no entries.

    The memory meets only the distinct (language, digest) pairs that need a
    translation.  Rows that need none get a key of their own, so that blank
    texts and English ones don't gather in one task."""
    t = F.coalesce(F.col(text), F.lit(""))
    plain = F.when(_is_blank(F.col(text)), F.lit("")).otherwise(t)
    if memory is None:
        return df.withColumn(out, plain)
    wanted = F.coalesce(~F.col(lang).isin(*NON_TRANSLATED), F.lit(False)) & ~_is_blank(F.col(text))
    keyed = df.withColumn("__tm_key", F.when(wanted, text_digest(F.col(text))).otherwise(_row_key()))
    pairs = df.where(wanted).select(F.col(lang).alias("__tm_lang"), text_digest(F.col(text)).alias("__tm_key")).distinct()
    entries = (memory.where(F.col("translation").isNotNull() & F.col("text").isNotNull())
                     .groupBy(F.col("lang").alias("__tm_lang"), text_digest(F.col("text")).alias("__tm_key"))
                     .agg(F.min("translation").alias("__tm_translation")))
    found = pairs.join(entries, ["__tm_lang", "__tm_key"]).withColumnRenamed("__tm_key", "__tm_digest")
    met = keyed.join(found, (keyed[lang] == found["__tm_lang"]) & (keyed["__tm_key"] == found["__tm_digest"]), "left")
    return met.withColumn(out, F.coalesce(F.col("__tm_translation"), plain)).drop(
        "__tm_lang", "__tm_key", "__tm_digest", "__tm_translation")
