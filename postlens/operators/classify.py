"""Text classifiers as term-weight tables.

The reference calls a pretrained transformer once per post.  Here a model
is a *table* ``weights(term, w0, w1, ...)`` aligned to a label list, and the
class priors.  Scoring is: terms of each post -> sums of the frequent terms'
weights, which every task holds, and of the others' by equi-join on term ->
priors added -> softmax -> arg-max.

``fit_naive_bayes`` builds such a table from labelled posts with Spark
aggregations (multinomial Naive Bayes, Laplace smoothing).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow as AR
from ..functions import text as T
from ..session import stored

# Fixed label sets of the reference: sentiment classes in index order, and
# the seven emotion classes.
SENTIMENT_LABELS = ("Negative", "Neutral", "Positive")
EMOTION_LABELS = ("joy", "sadness", "anger", "fear", "surprise", "disgust", "neutral")
SHORT_TEXT_CHARS = 3
MIN_EMOTION_WORDS = 3
# Terms whose weights every task holds, and their length at most; all other
# terms meet their weights in a join.
FREQUENT, FREQUENT_CHARS = 1 << 18, 32


# term weights (term, w0, w1, ...) and the class priors
Model = tuple[DataFrame, list[float]]


def fit_naive_bayes(train: DataFrame, toks: str, label: str, labels: tuple[str, ...],
                    smoothing: float = 1.0) -> Model:
    """Multinomial Naive Bayes model from ``train(toks array<string>,
    label string)``: ``w[i] = log((n(term, i) + a) / (N_i + a * V))`` and the
    priors ``log(docs_i / docs)``.  The per-term counts are one grouped
    aggregation; the per-class totals are k+2 scalars."""
    k = len(labels)
    idx = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label)) - 1
    t = train.select(idx.alias("y"), F.col(toks).alias("toks")).where(F.col("y") >= 0)
    counts = stored(AR.term_counts(t, "y", "toks").groupBy("term").agg(
        *[F.coalesce(F.sum(F.when(F.col("y") == i, F.col("n"))), F.lit(0)).alias(f"c{i}") for i in range(k)]), "terms")
    tot = counts.agg(F.count(F.lit(1)).alias("v"),
                     *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"t{i}") for i in range(k)]).first()
    docs = t.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(F.col("y") == i).alias(f"n{i}") for i in range(k)]).first()
    v = tot["v"]
    w = counts.select("term", *[
        F.log((F.col(f"c{i}") + F.lit(smoothing)) / F.lit(float(tot[f"t{i}"] + smoothing * v))).alias(f"w{i}")
        for i in range(k)])
    prior = [math.log(docs[f"n{i}"] / docs["n"]) if docs[f"n{i}"] else -1e9 for i in range(k)]
    return w, prior


def score_terms(df: DataFrame, toks: str, model: Model, out: str = "logits") -> DataFrame:
    """Per-post logit vector: sum of the weights of the post's tokens (with
    multiplicity) plus the class priors; unknown terms are skipped.

    The weights of the most frequent terms are held by every task and summed
    where the post is.  With more terms the rows are numbered and written once
    with these sums, so repeated or null post keys cannot mix posts, and only the
    other tokens move to meet their weights, whose sums are joined back on the
    row's number.  A post without known terms has the priors.
    """
    weights, prior = model
    k = len(prior)
    often, others = _by_frequency(weights, k)
    rows = df.withColumn("__met", AR.weight_sums(F.col(toks), _held(often, k), k, others is not None)).drop(toks)
    if others is not None:
        rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "scored")
        rest = rows.select("__row", F.explode("__met.rest").alias("term")).join(others, "term")
        sums = rest.groupBy("__row").agg(*[F.sum(f"w{i}").alias(f"__l{i}") for i in range(k)])
        rows = rows.join(sums, "__row", "left")
    return rows.withColumn(out, F.array(*[
        F.get("__met.sums", F.lit(i)) + (F.coalesce(F.col(f"__l{i}"), F.lit(0.0)) if others is not None else F.lit(0.0))
        + F.lit(float(prior[i])) for i in range(k)])).drop("__met", "__row", *[f"__l{i}" for i in range(k)])


def _held(weights: DataFrame, k: int):
    """The broadcast terms and weights, of bounded number; a term's rows add up."""
    held = weights.where(F.col("term").isNotNull()).groupBy("term").agg(
        *[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"w{i}") for i in range(k)]).toArrow().combine_chunks()
    rows = np.stack([held.column(f"w{i}").to_numpy() for i in range(k)], axis=1)
    terms = pa.array(held.column("term").to_pylist(), pa.string())
    return weights.sparkSession.sparkContext.broadcast((terms, np.concatenate([rows, np.zeros((1, k))])))


def _by_frequency(weights: DataFrame, k: int) -> tuple[DataFrame, DataFrame | None]:
    """The about ``FREQUENT`` terms with the largest weight in any class (it
    grows with the term's count) of bounded length, and all others, if any."""
    short = F.length("term") <= FREQUENT_CHARS
    n, longest = weights.agg(F.count(F.lit(1)), F.max(F.length("term"))).first()
    if n <= FREQUENT and (longest or 0) <= FREQUENT_CHARS:
        return weights, None
    weight = F.greatest(*[F.col(f"w{i}") for i in range(k)])
    often = short
    if n > FREQUENT:
        cut = weights.agg(F.percentile_approx(weight, 1 - FREQUENT / n, 10_000)).first()[0]
        often = short & F.coalesce(weight > F.lit(cut), F.lit(False))
    return weights.where(often), weights.where(~often)


def with_softmax(df: DataFrame, logits: str, labels: tuple[str, ...], out: str,
                 decimals: int | None = None) -> DataFrame:
    """M1: ``struct<label, score, scores map>`` from a logit array:
    probabilities ``exp(l - max) / sum``, arg-max label, its probability."""
    e, p = f"__{out}_e", f"__{out}_p"
    df = df.withColumn(e, F.transform(F.col(logits), lambda x: F.exp(x - F.array_max(F.col(logits)))))
    df = df.withColumn(p, F.transform(F.col(e), lambda x: x / F.aggregate(F.col(e), F.lit(0.0),
                                                                          lambda a, b: a + b)))
    probs = F.col(p) if decimals is None else F.transform(F.col(p), lambda x: F.round(x, decimals))
    lab = F.array(*[F.lit(x) for x in labels])
    best = F.array_position(F.col(p), F.array_max(F.col(p)))
    res = F.struct(F.get(lab, (best - 1).cast("int")).alias("label"),
                   (F.round(F.array_max(F.col(p)), decimals) if decimals is not None
                    else F.array_max(F.col(p))).alias("score"),
                   F.map_from_arrays(lab, probs).alias("scores"))
    return df.withColumn(out, res).drop(e, p)


def sentiment_text(df: DataFrame) -> Column:
    """``cleaned_text``, else title + (body, else content), stripped."""
    cols = df.columns

    def c(name):
        return F.col(name) if name in cols else F.lit(None).cast("string")
    return T.pick_text([c("cleaned_text")], c("title"), c("body"), c("content"))


def sentiment(df: DataFrame, model: Model, key: str = "post_id",
              labels: tuple[str, ...] = SENTIMENT_LABELS) -> DataFrame:
    """Sentiment struct per post.  Posts whose text is shorter than 3
    characters are dropped; the whole text is scored (no prefix cap)."""
    keep = [c for c in ("_id", key, "subreddit", "author", "created_utc", "permalink", "title")
            if c in df.columns]
    base = df.select(*keep, sentiment_text(df).alias("__t")) \
        .where(F.length(F.col("__t")) >= SHORT_TEXT_CHARS) \
        .select(*keep, T.snippet(F.col("__t")).alias("text_analyzed"),
                T.tokens(F.col("__t")).alias("__toks"))
    out = score_terms(base, "__toks", model)
    out = with_softmax(out, "logits", labels, "sentiment")
    return out.select(*keep, "text_analyzed", "sentiment")


def fit_sentiment_pipeline(train: DataFrame, text: str = "text", label: str = "label",
                           labels: tuple[str, ...] = SENTIMENT_LABELS, features: int = 1 << 16,
                           rounds: int = 50, penalty: float = 0.01) -> PipelineModel:
    """C7 (b): words -> hashed counts -> inverse document frequencies ->
    multinomial logistic regression (L-BFGS), over whole texts.  Rows with
    another label don't count, a null text has no words.  The optimiser's passes
    read the featurised rows, which are written once; the model has
    ``features x labels`` weights at every corpus size."""
    rows = train.select(F.coalesce(F.col(text), F.lit("")).alias("__t"), F.col(label).alias("__label")) \
        .where(F.col("__label").isin(*labels))
    features_of = Pipeline(stages=[
        RegexTokenizer(inputCol="__t", outputCol="__words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="__words", outputCol="__counts", numFeatures=features),
        IDF(inputCol="__counts", outputCol="__weighted")]).fit(rows)
    index = StringIndexerModel.from_labels(list(labels), inputCol="__label", outputCol="__y")
    ready = stored(index.transform(features_of.transform(rows)).select("__weighted", "__y"), "featurised")
    fitted = LogisticRegression(featuresCol="__weighted", labelCol="__y", probabilityCol="__p", rawPredictionCol="__raw",
                                predictionCol="__best", family="multinomial", maxIter=rounds,
                                regParam=penalty).fit(ready)
    return PipelineModel(stages=[*features_of.stages, fitted])


def load_pipeline(path: str) -> PipelineModel:
    """A model that ``fit_sentiment_pipeline(...).write().save(path)`` saved."""
    return PipelineModel.load(path)


def sentiment_by_pipeline(df: DataFrame, model: PipelineModel, key: str = "post_id",
                          labels: tuple[str, ...] = SENTIMENT_LABELS) -> DataFrame:
    """C7 (b): ``sentiment`` with a fitted pipeline, same rules for short texts;
    a class that training never met has probability zero.  No shuffle."""
    keep = [c for c in ("_id", key, "subreddit", "author", "created_utc", "permalink", "title") if c in df.columns]
    base = df.select(*keep, sentiment_text(df).alias("__t")).where(F.length("__t") >= SHORT_TEXT_CHARS)
    p = model.transform(base).withColumn("__p", vector_to_array("__p"))
    known = F.size("__p")
    probs = F.transform(F.sequence(F.lit(0), F.lit(len(labels) - 1)),
                        lambda i: F.when(i < known, F.get("__p", i)).otherwise(F.lit(0.0)))
    p = p.withColumn("__probs", probs)
    names = F.array(*[F.lit(x) for x in labels])
    best = F.array_max("__probs")
    return p.select(*keep, T.snippet(F.col("__t")).alias("text_analyzed"), F.struct(
        F.element_at(names, F.array_position("__probs", best).cast("int")).alias("label"),
        best.alias("score"), F.map_from_arrays(names, "__probs").alias("scores")).alias("sentiment"))


def emotion(df: DataFrame, model: Model, labels: tuple[str, ...], title: str = "title",
            body: str = "body", passed: list[str] | None = None) -> DataFrame:
    """Emotion struct (4 decimals) per post; text = title + ' ' + body;
    posts with fewer than 3 words are dropped (P13 passthrough, of the columns
    ``passed`` where given)."""
    base = df.withColumn("__t", T.strip_ws(T.join_parts(F.coalesce(F.col(title), F.lit("")),
                                                        F.coalesce(F.col(body), F.lit("")))))
    base = base.where(T.has_words(F.col("__t"), MIN_EMOTION_WORDS)).select(
        *(df.columns if passed is None else passed), T.tokens(F.col("__t")).alias("__toks"))
    out = score_terms(base, "__toks", model)
    return with_softmax(out, "logits", labels, "emotion", decimals=4).drop("logits")
