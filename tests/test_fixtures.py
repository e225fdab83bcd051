"""Golden rows of FIXTURES.md §4 (reference rules, inline inputs)."""

from pyspark.sql import functions as F

from postlens.functions import text as T
from postlens.operators import flags as FL
from postlens.operators import topics as TP

TEXTS = {
    "p1": "Just got my first job as a Python developer!\n\nSo happy #Python # Career-Change thanks @mentor_1 https://example.com/x",
    "p2": "You are an idiot",
    "p3": "Free prize: click link, claim reward now?",
    "p4": "???",
    "p5": "",
    "p6": "x#no #a-#b ##two",
    "p7": "He said the game was fun",
    "p8": "Straße déjà vu: the new album by the band and the concert, a song you like, read the chapter of this book tonight with us",
}
CLEANED = {
    "p1": "Just got my first job as a Python developer So happy CareerChange thanks",
    "p2": "You are an idiot", "p3": "Free prize click link claim reward now", "p4": "", "p5": "",
    "p6": "x", "p7": "He said the game was fun",
    "p8": "Strasse deja vu the new album by the band and the concert a song you like read the chapter of this book tonight with us",
}
TAGS_A = {"p1": ["#career-change", "#python"], "p6": ["#a-", "#b", "#two"]}
TAGS_B = {"p1": ["python"], "p6": ["no", "a", "b", "two"]}
MENTIONS_A = {"p1": ["@mentor_1"]}
DETECTED = {"p2": {"toxicity": 0.7, "harassment": 0.7}, "p3": {"spam": 1.0},
            "p8": {"spam": 0.5, "bot_like": 0.5}}
TOPICS = {"p1": ("technology", 0.133), "p3": ("technology", 0.067), "p7": ("technology", 0.067),
          "p8": ("music", 0.267)}


def _df(spark):
    return spark.createDataFrame(list(TEXTS.items()), "post_id string, text string")


def test_text_functions(spark):
    rows = {r["post_id"]: r for r in _df(spark).select(
        "post_id", T.clean_text(F.col("text")).alias("c"), T.hashtags_a(F.col("text")).alias("a"),
        T.hashtags_b(F.col("text")).alias("b"), T.mentions_a(F.col("text")).alias("m")).collect()}
    for k in TEXTS:
        assert rows[k]["c"] == CLEANED[k], k
        assert rows[k]["a"] == TAGS_A.get(k, []), k
        assert rows[k]["b"] == TAGS_B.get(k, []), k
        assert rows[k]["m"] == MENTIONS_A.get(k, []), k


def test_flags_on_cleaned(spark):
    pre = _df(spark).select("post_id", T.clean_text(F.col("text")).alias("cleaned_text"),
                            F.col("text").alias("translated_text"))
    out = {r["post_id"]: r for r in FL.behaviour_flags(pre).collect()}
    for k in TEXTS:
        det = out[k]["detected_flags"]
        if k == "p5":
            assert det is None
        else:
            assert dict(det) == DETECTED.get(k, {}), k
    f = {k: out[k]["flags"].asDict() for k in TEXTS}
    assert f["p2"]["offensive"] and not f["p2"]["spam"]
    assert f["p3"]["spam"] and f["p3"]["promotional"] and not f["p3"]["question"]
    assert f["p4"]["question"]
    assert f["p8"]["spam"] and f["p8"]["promotional"]
    assert not any(v["discussion"] for v in f.values())
    assert not any(f["p5"].values())


def test_topics_raw(spark):
    out = {r["post_id"]: r["topic"] for r in TP.with_topic(_df(spark), "text").collect()}
    for k in TEXTS:
        lab, sc = TOPICS.get(k, ("other", 0.0))
        assert (out[k]["label"], out[k]["score"]) == (lab, sc), k


def test_score_values_are_the_documented_steps(spark):
    texts = [("a", "idiot"), ("b", "idiot idiot"), ("c", "idiot idiot idiot idiot"),
             ("d", "idiot " + "word " * 12), ("e", "idiot idiot " + "word " * 12),
             ("f", "idiot idiot idiot " + "word " * 12)]
    df = spark.createDataFrame(texts, "post_id string, cleaned_text string") \
        .withColumn("translated_text", F.col("cleaned_text"))
    got = {r["post_id"]: r["detected_flags"]["toxicity"] for r in FL.behaviour_flags(df).collect()}
    assert got == {"a": 0.7, "b": 0.9, "c": 1.0, "d": 0.5, "e": 0.7, "f": 0.9}
