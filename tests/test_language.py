"""Language id by exact trigrams and the translation memory, against plain
Python; the trained sentiment pipeline; emoji aliases; bucketed joins."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from postlens.functions import emoji as EM
from postlens.operators import classify as CL
from postlens.operators import language as LG
from postlens.plans import catalog as C
from postlens.plans import reporting as RP
from postlens.plans.preprocess import preprocess

WORDS = {"en": "the water and house of the street".split(), "de": "das wasser und haus der strasse".split(),
         "fr": "le eau et maison de la rue".split()}


def _grams(text):
    t = " " + re.sub(r"\s+", " ", text.lower()) + " "
    return [t[i:i + 3] for i in range(len(t) - 2)]


def _plain_model(rows):
    rows = [(t, lang) for t, lang in rows if lang is not None and (t or "").strip()]
    names = sorted({lang for _, lang in rows})
    counts = {n: Counter(g for t, lang in rows if lang == n for g in _grams(t)) for n in names}
    v = len(set().union(*counts.values()))
    below = {n: sum(counts[n].values()) + v + 1 for n in names}

    def detect(text):
        if not (text or "").strip():
            return "unknown"
        best = {n: round(math.log(sum(x == n for _, x in rows) / len(rows)) * 1e6)
                + sum(round(math.log((counts[n][g] + 1) / below[n]) * 1e6) for g in _grams(text)) for n in names}
        return max(names, key=lambda n: (best[n], -names.index(n)))
    return detect


def _texts():
    r = random.Random(3)
    rows = [(" ".join(r.choices(WORDS[lang], k=r.randint(1, 12))), lang) for lang in WORDS for _ in range(20)]
    return rows + [(None, "en"), ("  \n", "de"), ("no label", None), ("das das", "de"), ("das das", "de")]


def test_detection_is_the_plain_one(spark):
    rows = _texts()
    d = spark.createDataFrame(rows, "text string, lang string")
    detect = _plain_model(rows)
    # keys repeat and are null; texts repeat, are blank, null or unlike all others
    asked = [(1, "das water"), (1, "la rue"), (None, "der of"), (None, None), (2, ""), (3, "\u4e2d"), (4, "das water"), (5, "x" * 9)]
    out = LG.detect_trigrams(spark.createDataFrame(asked, "id long, text string"), LG.fit_trigrams(d))
    got = sorted((r["id"] or 0, r["text"] or "", r["language_detected"]) for r in out.collect())
    assert got == sorted((i or 0, t or "", detect(t)) for i, t in asked)


def test_detection_without_training_texts(spark):
    none = spark.createDataFrame([], "text string, lang string")
    asked = spark.createDataFrame([("a text",), (None,)], "text string")
    got = LG.detect_trigrams(asked, LG.fit_trigrams(none)).collect()
    assert [r["language_detected"] for r in got] == ["unknown", "unknown"]


def test_held_out_texts_of_documents(spark):
    rows = C.q_language_detect(spark, SF_SMALL).where("held_out and lang is not null and language_detected <> 'unknown'").collect()
    assert len(rows) > 20 and sum(r["correct"] for r in rows) / len(rows) > 0.9


def test_translations(spark):
    memory = spark.createDataFrame([
        ("de", "das haus", "the house"), ("de", "das haus", "a house"), ("fr", "das haus", "wrong"), ("en", "the end", "wrong"),
        ("de", "ohne", None), ("unknown", "x", "wrong"), ("de", "", "wrong"), (None, "y", "wrong")],
        "lang string, text string, translation string")
    rows = [(1, "de", "das haus", "a house"), (1, "de", "das haus", "a house"), (None, "fr", "das haus", "wrong"),
            (2, "en", "the end", "the end"), (3, "de", "ohne", "ohne"), (4, "unknown", "x", "x"), (5, "de", "  ", ""),
            (6, None, "y", "y"), (7, "de", None, ""), (8, "de", "not there", "not there")]
    d = spark.createDataFrame(rows, "id long, language_detected string, text string, want string")
    out = LG.apply_translations(d, memory).collect()
    assert len(out) == len(rows)
    assert all(r["translated_text"] == r["want"] for r in out), out
    assert all(r["translated_text"] == (r["text"] or "").strip() for r in LG.apply_translations(d, None).collect())


def test_preprocessing_with_model_and_memory(spark):
    model = LG.fit_trigrams(spark.createDataFrame(_texts(), "text string, lang string"))
    posts = spark.createDataFrame([("1", "das haus der strasse"), ("1", "the house"), (None, None)], "id string, content string")
    memory = spark.createDataFrame([("de", "das haus der strasse", "The house, of the street!")],
                                   "lang string, text string, translation string")
    got = {(r["post_id"], r["language_detected"], r["cleaned_text"]) for r in preprocess(posts, model, memory).collect()}
    assert got == {("1", "de", "The house of the street"), ("1", "en", "the house"), (None, "unknown", "")}


def test_trained_sentiment(spark, tmp_path):
    r = random.Random(5)
    good, bad, other = "fine great happy nice".split(), "awful bad sad poor".split(), "table chair door wall".split()

    def rows(n):
        return [(str(i), " ".join(r.choices(words, k=4) + r.choices(other, k=6)), label)
                for label, words in (("Positive", good), ("Negative", bad), ("Neutral", other)) for i in range(n)]
    train = spark.createDataFrame(rows(30) + [("x", None, "Positive"), ("y", "text", "no label")],
                                  "post_id string, text string, label string")
    path = str(tmp_path / "model")
    CL.fit_sentiment_pipeline(train, features=1 << 10).write().save(path)
    asked = spark.createDataFrame([*rows(10), ("k", "ab", "short"), (None, "great nice happy", "Positive")],
                                  "post_id string, cleaned_text string, want string")
    out = CL.sentiment_by_pipeline(asked.withColumn("title", F.col("want")), CL.load_pipeline(path)).collect()
    assert len(out) == 31
    assert sum(r["sentiment"]["label"] == r["title"] for r in out) / len(out) > 0.9
    assert all(abs(sum(r["sentiment"]["scores"].values()) - 1) < 1e-9 for r in out)
    one = CL.fit_sentiment_pipeline(train.where("label = 'Positive'"), features=1 << 10)
    assert {r["sentiment"]["label"] for r in CL.sentiment_by_pipeline(asked, one).collect()} <= set(CL.SENTIMENT_LABELS)


def test_emoji_aliases(spark):
    family = "\U0001F468\u200D\U0001F469\u200D\U0001F467"
    rows = [("a \U0001F600 b", "a :grinning_face: b"), (family + "!", ":man_woman_girl:!"),
            ("\U0001F44D\U0001F3FD\U0001F44D", ":thumbs_up_medium_skin_tone::thumbs_up:"), ("\u2764\uFE0Fx", ":red_heart:x"),
            ("\U0001F1EB\U0001F1F7\U0001F1E9\U0001F1EA", ":flag_fr::flag_de:"), ("1\uFE0F\u20E3 1 #", ":keycap_1: 1 #"),
            ("plain", "plain"), ("", ""), (None, None), ("x\u200Dy", "x\u200Dy"),
            ("z\U0001F600" * 3000, "z:grinning_face:" * 3000)]
    d = spark.createDataFrame(rows, "t string, want string").select(EM.to_aliases(F.col("t")).alias("got"), "want")
    for r in d.collect():
        assert r["got"] == r["want"]
    single = spark.createDataFrame([(s, EM.alias(s)) for s in EM.symbols()], "t string, want string")
    assert single.where(EM.to_aliases(F.col("t")) != F.col("want")).count() == 0


def test_bucketed_parts_meet_without_exchange(spark, capsys):
    base = spark.createDataFrame([(str(i), f"t{i}", f"c{i % 2}", "2024-01-01") for i in range(50)] * 2,
                                 "post_id string, title string, subreddit string, preprocessed_at string")
    topics = spark.createDataFrame([(str(i), ("old" if s else "new", 1.0), 2 - s) for i in range(50) for s in (0, 1)],
                                   "post_id string, topic struct<label: string, score: double>, processed_at long")
    flags = spark.createDataFrame([(str(i), (True, False, False, False, False), 1) for i in range(0, 50, 2)],
                                  "post_id string, flags struct<spam: boolean, offensive: boolean, promotional: boolean, "
                                  "question: boolean, discussion: boolean>, processed_at long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ps = RP.post_summaries(RP.bucketed(base, "base"), topics=RP.bucketed(topics, "topics"), flags=RP.bucketed(flags, "flags"))
        rows = ps.collect()
        ps.explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert len(rows) == 50 and all(r["nlp_results"]["topic_classification"]["label"] == "new" for r in rows)
    assert sum(r["nlp_results"]["behavior_flags"] is not None for r in rows) == 25
