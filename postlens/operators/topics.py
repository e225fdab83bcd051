"""Topic by keyword hits and lemmatisation.

The topic lexicon is a bounded configuration (tens to a few thousand
keywords), so it is one projection: per topic the keywords that the text
contains, counted a batch at a time, and an ``array_max`` over
``(hits, -ordinal, label)`` structs.  Map-only, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow as AR
from ..functions import text as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results: topics in
# declared order (ties go to the earlier one) and their keywords.
# ---------------------------------------------------------------------------
TOPIC_LEXICON: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("technology", ("tech", "computer", "software", "app", "phone", "ai", "artificial intelligence",
                    "coding", "program", "developer", "internet", "data", "code", "algorithm", "system")),
    ("gaming", ("game", "play", "player", "xbox", "playstation", "nintendo", "steam", "level",
                "character", "quest", "rpg", "fps", "multiplayer", "console", "indie")),
    ("movies_tv", ("movie", "film", "show", "episode", "season", "netflix", "hbo", "disney",
                   "marvel", "star wars", "actor", "actress", "director", "cinema", "streaming")),
    ("science", ("science", "research", "study", "scientist", "space", "nasa", "discovery",
                 "experiment", "physics", "chemistry", "biology", "universe", "theory", "quantum")),
    ("programming", ("python", "javascript", "java", "c++", "html", "css", "react", "node",
                     "api", "framework", "library", "function", "variable", "loop", "debug")),
    ("politics", ("politics", "government", "election", "president", "minister", "congress",
                  "senate", "vote", "democrat", "republican", "policy", "law", "bill", "senator")),
    ("sports", ("sport", "football", "basketball", "soccer", "game", "match", "player",
                "team", "win", "championship", "tournament", "olympic", "nba", "nfl", "fifa")),
    ("music", ("music", "song", "album", "band", "artist", "listen", "spotify", "youtube",
               "concert", "guitar", "piano", "rap", "pop", "rock", "jazz")),
    ("books", ("book", "read", "author", "novel", "story", "chapter", "page", "publish",
               "fiction", "fantasy", "sci-fi", "mystery", "thriller", "biography")),
    ("health", ("health", "medical", "doctor", "hospital", "disease", "covid", "medicine",
                "patient", "treatment", "vaccine", "mental", "fitness", "exercise", "diet")),
)
NO_TOPIC = "other"
SCORE_DECIMALS = 3
# Lemmas that every task holds; with more of them the words meet them in a join.
LEMMAS = 1 << 18
# ---------------------------------------------------------------------------


def with_topic(df: DataFrame, text: str, lexicon=TOPIC_LEXICON, out: str = "topic") -> DataFrame:
    """Add ``out`` = ``struct<label string, score double>`` for the
    (lemmatised) text column ``text``.  Keywords count once each, by
    substring presence in the lower-cased text; score =
    round(min(1, best / longest keyword list), 3); ties go to the earlier
    topic; no hit or blank text -> ('other', 0.0).

    The lower-cased text and the winning candidate are projected columns,
    so the CASE branches only reference attributes.
    """
    lc, found, best = f"__{out}_lc", f"__{out}_found", f"__{out}_best"
    df = df.withColumn(lc, F.lower(F.coalesce(F.col(text), F.lit(""))))
    df = df.withColumn(found, AR.keyword_hits(F.col(lc), [kws for _, kws in lexicon]))
    max_len = max(len(k) for _, k in lexicon)
    cands = []
    for ordinal, (label, _) in enumerate(lexicon):
        cands.append(F.struct(F.get(found, ordinal).alias("hits"), F.lit(-ordinal).alias("neg_ord"),
                              F.lit(label).alias("label")))
    df = df.withColumn(best, F.array_max(F.array(*cands)))
    b = F.col(best)
    blank = T.strip_ws(F.col(lc)) == ""
    topic = F.when(blank | (b["hits"] == 0),
                   F.struct(F.lit(NO_TOPIC).alias("label"), F.lit(0.0).alias("score"))) \
        .otherwise(F.struct(b["label"].alias("label"),
                            F.round(F.least(F.lit(1.0), b["hits"] / F.lit(float(max_len))),
                                    SCORE_DECIMALS).alias("score")))
    return df.withColumn(out, topic).drop(lc, found, best)


def topic_detect(posts: DataFrame, title: str = "title", body: str = "body",
                 lexicon=TOPIC_LEXICON, lemmas: DataFrame | None = None) -> DataFrame:
    """Topic job: text = title + ' ' + body (non-empty parts); posts with
    empty text are dropped; the post is passed through with a ``topic``
    struct (P13).  With a lemma table the text is lemmatised first (C6)."""
    text = T.strip_ws(T.join_parts(F.coalesce(F.col(title), F.lit("")),
                                   F.coalesce(F.col(body), F.lit(""))))
    df = posts.withColumn("__text", text).where(F.col("__text") != "")
    if lemmas is not None:
        df = lemmatize(df, "__text", lemmas, out="__text")
    return with_topic(df, "__text", lexicon).drop("__text")


def lemmatize(df: DataFrame, text: str, lemmas: DataFrame, out: str = "lemmatized") -> DataFrame:
    """Lower-case, split on whitespace, replace each token by its lemma
    (``lemmas(token, lemma)``, the smallest lemma of a repeated token),
    re-join with single spaces.

    A table of up to ``LEMMAS`` tokens is held by every task, and no word moves.
    With a larger one, distinct texts are looked up, by a digest of the text:
    repeated or null post keys cannot mix posts, and copies of one text are
    exploded once.
    """
    lem = lemmas.groupBy(F.col("token").alias("__tok")).agg(F.min("lemma").alias("__lem"))
    known = lem.where(F.col("__lem").isNotNull()).limit(LEMMAS + 1).collect()
    if len(known) <= LEMMAS:
        held = df.sparkSession.sparkContext.broadcast({r["__tok"]: r["__lem"] for r in known})
        return df.withColumn(out, AR.replaced_words(T.strip_ws(F.lower(F.col(text))), held))
    df = df.withColumn("__digest", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    words = F.split(T.strip_ws(F.lower(F.coalesce(F.col("__text"), F.lit("")))), r"\s+")
    toks = (df.select("__digest", F.col(text).alias("__text")).dropDuplicates(["__digest"])
              .select("__digest", F.posexplode(words).alias("__pos", "__tok"))
              .where(F.col("__tok") != ""))
    rebuilt = toks.join(lem, "__tok", "left").groupBy("__digest").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("__pos", F.coalesce("__lem", "__tok").alias("w")))),
        lambda s: s["w"]), " ").alias("__out"))
    return df.join(rebuilt, "__digest", "left").withColumn(
        out, F.coalesce("__out", F.lit(""))).drop("__digest", "__out")
