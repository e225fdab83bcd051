"""Operators against brute-force Python on small inputs, and pinned rules."""

import random
from collections import Counter

from pyspark.sql import functions as F

from postlens.functions import arrow as AR
from postlens.functions import text as T
from postlens.operators import classify as CL
from postlens.operators import eda as EDA
from postlens.operators import entities as EN
from postlens.operators import keywords as K
from postlens.operators import language as LG
from postlens.operators import topics as TP
from postlens.sources import sinks as SK


def test_topk_matches_counter_most_common(spark):
    rnd = random.Random(7)
    vocab = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]
    texts = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 40)))) for i in range(60)]
    df = spark.createDataFrame(texts, "id long, content string")
    got = {r["id"]: r["keywords"] for r in K.keywords_topk(df, "content", k=3).collect()}
    for i, t in texts:
        want = [w for w, _ in Counter(t.split()).most_common(3)]
        assert (got[i] or []) == want, (i, t)


def test_word_count_and_strip(spark):
    r = spark.createDataFrame([("  a  b\tc\n",), ("",), ("   ",)], "t string").select(
        T.word_count(F.col("t")).alias("n"), T.strip_ws(F.col("t")).alias("s")).collect()
    assert [x["n"] for x in r] == [3, 0, 0]
    assert r[0]["s"] == "a  b\tc"


def test_time_parsing_and_parts(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:07Z", "1704067207")], "iso string, epoch string")
    r = df.select(EDA.parse_time(F.col("iso")).alias("a"), EDA.parse_time(F.col("epoch")).alias("b")).first()
    assert r["a"] == r["b"]
    p = EDA.time_parts(df.select(EDA.parse_time(F.col("iso")).alias("created_utc"))).first()
    assert (p["hour"], p["day_of_week"]) == (0, "Monday")


def test_rounding_and_quantile(spark):
    r = spark.range(1).select(F.round(F.lit(2.675), 2).alias("a"), F.round(F.lit(0.125), 2).alias("b")).first()
    assert (r["a"], r["b"]) == (2.68, 0.13)
    q = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double").agg(
        F.percentile("x", F.lit(0.95))).first()[0]
    assert abs(q - 3.85) < 1e-12


def test_upsert_sets_named_fields_only(spark):
    t = spark.createDataFrame([("a", 1, 2)], "_id string, x int, y int")
    u = spark.createDataFrame([("a", None), ("b", 5)], "_id string, x int")
    got = {r["_id"]: (r["x"], r["y"]) for r in SK.upsert(t, u, "_id", ["x"]).collect()}
    assert got == {"a": (None, 2), "b": (5, None)}
    twice = SK.upsert(SK.upsert(t, u, "_id", ["x"]), u, "_id", ["x"])
    assert {r["_id"]: (r["x"], r["y"]) for r in twice.collect()} == got


def _brute_entities(text, gaz):
    import re
    words = [(m.start(), m.group(0)) for m in re.finditer(r"\S+", text)]
    norm = [re.sub(r"^[^\w]+|[^\w]+$", "", w).lower() for _, w in words]
    maxn = max(len(a.split()) for a in gaz)
    out, i = [], 0
    while i < len(words):
        hit = None
        for n in range(min(maxn, len(words) - i), 0, -1):
            g = norm[i:i + n]
            if "" in g:
                continue
            if " ".join(g) in gaz:
                hit = n
                break
        if hit:
            s0, w0 = words[i]
            s1, w1 = words[i + hit - 1]
            lead = len(w0) - len(re.sub(r"^[^\w]+", "", w0))
            trail = len(w1) - len(re.sub(r"[^\w]+$", "", w1))
            out.append((text[s0 + lead:s1 + len(w1) - trail], gaz[" ".join(norm[i:i + hit])], s0 + lead,
                        s1 + len(w1) - trail))
            i += hit
        else:
            i += 1
    return [e for e in out if len(e[0].strip()) >= 2]


def test_entities_match_brute_force(spark):
    gaz = {"new york": "GPE", "york": "GPE", "acme corp": "ORG", "acme": "ORG", "red widget": "PRODUCT"}
    texts = [(1, "I moved to New York, then joined ACME Corp."), (2, "york (york) and acme"),
             (3, "a red  widget from Acme corp in new york city"), (4, "no"), (5, "nothing here at all")]
    df = spark.createDataFrame(texts, "id long, t string")
    g = spark.createDataFrame([(a, ty, a.upper()) for a, ty in gaz.items()], "alias string, type string, kb_id string")
    got = {r["id"]: [(e["entity"], e["type"], e["start"], e["end"]) for e in r["entities"]]
           for r in EN.extract_entities(df, "t", g).collect()}
    for i, t in texts:
        want = _brute_entities(t, gaz) if len(t.strip()) >= 3 else []
        assert got[i] == want, (i, got[i], want)


def test_lemmatize_small_table(spark):
    df = spark.createDataFrame([(1, "Games  played")], "id long, t string")
    lem = spark.createDataFrame([("games", "game"), ("played", "play")], "token string, lemma string")
    assert TP.lemmatize(df, "t", lem).first()["lemmatized"] == "game play"


def test_daily_trend_and_label_stats(spark):
    from postlens.operators import stats as ST
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", "Positive", 0.9), ("2024-01-01 23:00:00", "Negative", 0.5),
         ("2024-01-02 01:00:00", "Positive", 0.7)], "ts string, label string, score double") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    got = {str(r["date"]): (r["mean_score"], r["count"]) for r in ST.daily_trend(df, "ts", F.col("score")).collect()}
    assert got == {"2024-01-01": (0.7, 2), "2024-01-02": (0.7, 1)}
    st = {r["label"]: r for r in ST.label_stats(df, F.col("label"), F.col("score"),
                                                  avg_labels=("Positive", "Neutral", "Negative")).collect()}
    assert st["Positive"]["count"] == 2 and st["Positive"]["percentage"] == 66.67
    assert st["Positive"]["average_confidence"] == 0.8 and st["Negative"]["percentage"] == 33.33


def test_entities_with_many_aliases_and_repeated_or_null_keys(spark):
    gaz = {f"word{i} city": "GPE" for i in range(90)} | {"acme": "ORG"}
    rows = [(1, "In Word7 city and word80 City"), (1, "acme, word3"), (None, "ACME acme"), (None, "word5 city"),
            (2, None), (3, "acme")]
    df = spark.createDataFrame(rows, "id long, t string")
    g = spark.createDataFrame([(a, ty, a.upper()) for a, ty in gaz.items()], "alias string, type string, kb_id string")
    got = [(r["id"], r["t"], [(e["entity"], e["type"], e["start"], e["end"]) for e in r["entities"]])
           for r in EN.extract_entities(df, "t", g).collect()]
    want = [(i, t, _brute_entities(t, gaz) if t and len(t.strip()) >= 3 else []) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    none = EN.extract_entities(df, "t", g.where("false")).collect()
    assert len(none) == len(rows) and all(r["entities"] == [] for r in none)


def test_lemmatize_repeated_and_null_keys(spark):
    rows = [(1, "Games  Played"), (1, "cats run"), (None, "dogs RAN"), (None, None), (2, " ")]
    df = spark.createDataFrame(rows, "id long, t string")
    lem = spark.createDataFrame([("games", "game"), ("cats", "cat"), ("ran", "run"), ("dogs", "dog"),
                                 *((f"w{i}", f"v{i}") for i in range(12000))], "token string, lemma string")
    got = sorted((str(r["id"]), r["lemmatized"]) for r in TP.lemmatize(df, "t", lem).collect())
    assert got == sorted([("1", "game played"), ("1", "cat run"), ("None", "dog run"), ("None", ""), ("2", "")])


def test_replace_takes_the_latest_of_repeated_updates(spark):
    t = spark.createDataFrame([("a", 1), ("c", 9)], "k string, x int")
    u = spark.createDataFrame([("a", 2), ("a", 3), ("b", 4)], "k string, x int")
    got = sorted((r["k"], r["x"]) for r in SK.replace_by_key(t, u, "k", order=["x"]).collect())
    assert got == [("a", 3), ("b", 4), ("c", 9)]


def test_ingest_inserts_an_id_once(spark):
    from pyspark.sql import functions as F

    from postlens.operators import ingest as IN

    new = spark.createDataFrame([("p", 5, "x"), ("p", 7, "x"), ("q", 6, "x"), ("r", 1, "x")],
                                "id string, created_utc int, subreddit string")
    old = spark.createDataFrame([("q", 6)], "id string, created_utc int")
    rows, counters = IN.incremental_ingest(new, old, F.lit(3))
    assert [(r["id"], r["created_utc"]) for r in rows.collect()] == [("p", 7)]
    c = counters.first()
    assert (c["scanned"], c["kept"], c["skipped"]) == (2, 1, 1)


def test_a_stored_id_with_a_later_time_is_skipped(spark):
    from pyspark.sql import functions as F

    from postlens.operators import ingest as IN

    new = spark.createDataFrame([("p", 5, "x"), ("q", 6, "x")], "id string, created_utc int, subreddit string")
    old = spark.createDataFrame([("q", 1)], "id string, created_utc int")
    rows, counters = IN.incremental_ingest(new, old, F.lit(3))
    assert [r["id"] for r in rows.collect()] == ["p"] and counters.first()["skipped"] == 1


def test_absent_labels_report_zero(spark):
    from pyspark.sql import functions as F

    from postlens.operators import stats as ST

    df = spark.createDataFrame([("Positive", 0.5), ("Positive", 0.7)], "label string, score double")
    got = {r["label"]: (r["count"], r["average_confidence"]) for r in ST.label_stats(
        df, F.col("label"), F.col("score"), avg_labels=("Positive", "Neutral", "Negative")).collect()}
    assert got == {"Positive": (2, 0.6), "Neutral": (0, 0.0), "Negative": (0, 0.0)}


def test_clean_text_takes_unicode_spaces_for_spaces(spark):
    from pyspark.sql import functions as F

    from postlens.functions import text as TX

    df = spark.createDataFrame([("a\u00a0b http://x.y\u00a0next \u3000word",)], "t string")
    assert df.select(TX.clean_text(F.col("t"))).first()[0] == "a b next word"


def test_entity_filter(spark):
    from postlens.operators import search as SR

    df = spark.sql("""SELECT 1 AS id, array(named_struct('entity', 'New York', 'type', 'GPE')) AS linked_entities
        UNION ALL SELECT 2, array(named_struct('entity', 'Acme', 'type', 'ORG'))""")
    assert [r["id"] for r in SR.mentioned(df, type_="GPE").collect()] == [1]
    assert [r["id"] for r in SR.mentioned(df, pattern="^acm").collect()] == [2]


def test_stream_merge_is_idempotent_and_raises_real_errors(spark, tmp_path):
    from postlens.streaming import ingest as ST

    path = str(tmp_path / "table")
    batch = spark.createDataFrame([(1, 10), (2, 20)], "k int, ts int")
    for _ in range(2):
        ST.merge_batch(batch, path, "k", "ts")
    ST.merge_batch(spark.createDataFrame([(2, 20), (3, 30)], "k int, ts int"), path, "k", "ts")
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_latest_snapshot(spark):
    s = spark.sql("SELECT 'a_1' AS _id, timestamp'2024-01-01' AS saved_at, 1 AS x "
                  "UNION ALL SELECT 'a_2', timestamp'2024-01-02', 2")
    r = SK.latest_snapshot(s).collect()
    assert [(x["_id"], x["x"], x["error"]) for x in r] == [("a_2", 2, None)]
    r = SK.latest_snapshot(s.where("false")).collect()
    assert len(r) == 1 and r[0]["x"] is None and r[0]["error"]


def test_stream_enrichment_is_the_batch_one(spark, tmp_path):
    from postlens.streaming import ingest as ST

    posts = spark.sql("""SELECT '1' AS id, 'Is this #fun?' AS title, 'why not, buy now' AS body,
        'Is this #fun? why not, buy now' AS content, 'c' AS subreddit""")
    path = str(tmp_path / "posts")
    posts.write.parquet(path)
    stream = ST.enriched(spark.readStream.schema(posts.schema).parquet(path))
    out = str(tmp_path / "out")
    stream.select("post_id", "flags").writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).collect() == ST.enriched(posts).select("post_id", "flags").collect()


def test_entities_of_repeated_and_null_keys(spark):
    """Posts that share a key, or have none, stay apart."""
    g = spark.createDataFrame([("new york", "GPE", "1"), ("acme", "ORG", "2"), ("nowhere", "LOC", "3")],
                              "alias string, type string, kb_id string")
    kb = spark.createDataFrame([("New  York", 2, "NY b", 8, "x"), ("new york", 1, "NY a", 9, "<b>y</b>"),
                                ("ACME", 1, "Acme", 7, "z")],
                               "name string, rank int, title string, page_id long, snippet string")
    texts = [("a", "New York and ACME, then acme again"), ("a", "only (New York) here"), (None, "to Nowhere and acme"),
             (None, "acme acme acme!"), ("b", "Nowhere is not linked"), ("c", None), ("d", "acme")]
    posts = spark.createDataFrame(texts, "post_id string, cleaned_text string")
    got = sorted((str(r["post_id"]), r["entity_count"], r["linked_entity_count"],
                  [(e["entity"], e["start"], e["end"], e["wikipedia"]["title"]) for e in r["linked_entities"]])
                 for r in EN.entity_table(posts, g, kb).collect())
    assert got == [("None", 2, 1, [("acme", 15, 19, "Acme")]), ("None", 3, 1, [("acme", 0, 4, "Acme")]),
                   ("a", 1, 1, [("New York", 6, 14, "NY a")]),
                   ("a", 3, 2, [("New York", 0, 8, "NY a"), ("ACME", 13, 17, "Acme")])]


def test_entities_of_documents_match_brute_force(spark):
    """The registered gazetteer over a whole table."""
    from postlens.plans import catalog
    from postlens.sources.tables import document_posts
    small = "/root/testdata/sf0.001"
    gaz, _ = catalog.gazetteer_and_kb(spark, small)
    plain = {r["gram"]: r["type"] for r in EN.prepare_gazetteer(gaz).collect()}
    posts = document_posts(spark, small).select("id", "content")
    rows = EN.extract_entities(posts, "content", gaz).collect()
    assert len(rows) == posts.count() and sum(len(r["entities"]) for r in rows) > 3
    for r in rows:
        t = r["content"] or ""
        want = _brute_entities(t, plain) if len(t.strip()) >= 3 else []
        assert [(e["entity"], e["type"], e["start"], e["end"]) for e in r["entities"]] == want


def test_scores_of_repeated_and_null_keys(spark):
    """Classifiers score each row by its own text."""
    from postlens.operators import classify as CL
    w = spark.createDataFrame([("good", -2.0, -1.0, 0.0), ("bad", 0.0, -1.0, -2.0)], "term string, w0 double, w1 double, w2 double")
    model = (w, [0.0, 0.0, 0.0])
    posts = spark.createDataFrame([("a", "good good"), ("a", "bad bad bad"), (None, "good"), (None, "bad"), ("b", "zzz yyy"),
                                   ("c", "  "), ("a", "good good")], "post_id string, cleaned_text string")
    got = sorted((str(r["post_id"]), r["text_analyzed"], r["sentiment"]["label"]) for r in CL.sentiment(posts, model).collect())
    assert got == [("None", "bad", "Negative"), ("None", "good", "Positive"), ("a", "bad bad bad", "Negative"),
                   ("a", "good good", "Positive"), ("a", "good good", "Positive"), ("b", "zzz yyy", "Negative")]
    same = spark.createDataFrame([("k", "good good good", ""), ("k", "bad bad", "bad"), (None, "good good", "good")],
                                 "id string, title string, body string")
    got = sorted((r["title"], r["emotion"]["label"]) for r in CL.emotion(same, model, ("x", "y", "z")).collect())
    assert got == [("bad bad", "x"), ("good good", "z"), ("good good good", "z")]


def test_histogram_of_values_that_are_not_finite(spark):
    values = [float(i) for i in range(20)] + [float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = EDA.trimmed_histogram(df, "x").collect()
    assert sum(r["count"] for r in rows) == 19 and rows[0]["mean"] == 9.0
    assert EDA.trimmed_histogram(df.where("isnan(x)"), "x").count() == 0
    wide = spark.createDataFrame([(-1.7e308,), (0.0,), (1.0,), (1.7e308,)], "x double")
    assert [EDA.order_statistic(wide, "x", k) for k in range(4)] == [-1.7e308, 0.0, 1.0, 1.7e308]


def test_the_latest_record_of_each_part_wins(spark):
    """JN1: duplicates of a part with different stamps."""
    from postlens.plans import reporting as RP
    base = spark.createDataFrame([("a", "t"), ("b", "u")], "post_id string, title string")
    emotion = spark.sql("""SELECT * FROM VALUES
        ('a', named_struct('label', 'old', 'score', 0.1D, 'scores', map('x', 0.1D)), TIMESTAMP '2024-01-01'),
        ('a', named_struct('label', 'new', 'score', 0.9D, 'scores', map('x', 0.9D)), TIMESTAMP '2024-01-03'),
        ('a', named_struct('label', 'none', 'score', 0.5D, 'scores', map('x', 0.5D)), NULL) t(id, emotion, processed_at)""")
    topics = spark.sql("""SELECT * FROM VALUES ('a', named_struct('label', 'late', 'score', 0.2D), TIMESTAMP '2024-02-01'),
        ('a', named_struct('label', 'early', 'score', 0.3D), TIMESTAMP '2024-01-01') t(id, topic, processed_at)""")
    said = spark.sql("""SELECT * FROM VALUES ('b', 'first', TIMESTAMP '2024-01-01'), ('b', 'second', TIMESTAMP '2024-01-02')
        t(id, summary, processed_at)""")
    rows = {r["post_id"]: r["nlp_results"] for r in RP.post_summaries(
        base, emotion=emotion, topics=topics, summaries=said).collect()}
    assert rows["a"]["emotion_detection"]["label"] == "new" and rows["a"]["topic_classification"]["label"] == "late"
    assert rows["b"]["generated_summary"] == "second" and rows["b"]["emotion_detection"] is None


def _gazetteer_case(spark):
    posts = spark.createDataFrame(
        [(1, "p", 'He saw «New  York» and New Jersey, then "York".'), (2, "p", "É new york! Škoda works"), (3, None, "nothing"),
         (4, None, None), (4, None, "york  new - york new york city")], "n int, post_id string, t string")
    gaz = spark.createDataFrame([("New York", "GPE", "1"), ("york", "GPE", "2"), ("škoda", "ORG", "3"), ("new york city", "GPE", "4")],
                                "alias string, type string, kb_id string")
    return posts, gaz


def test_entities_alike_by_broadcast_and_by_joins(spark, monkeypatch):
    posts, gaz = _gazetteer_case(spark)

    def run():
        rows = EN.extract_entities(posts, "t", gaz).collect()
        return sorted((r["n"], r["t"] or "", [tuple(e) for e in r["entities"]]) for r in rows)
    held = run()
    assert [e[0] for e in held[0][2]] == ["New  York", "York"]
    assert [e[:1] + e[2:4] for r in held if r[0] == 2 for e in r[2]] == [("new york", 2, 10), ("Škoda", 12, 17)]
    monkeypatch.setattr(EN, "ALIASES", 1)
    assert run() == held
    monkeypatch.setattr(EN, "FIRST_WORDS", 1)
    assert run() == held


def test_scores_alike_by_broadcast_and_by_join(spark, monkeypatch):
    weights = spark.createDataFrame([("aaa", 1.0, -1.0), ("bbb", -2.0, 0.5), ("c" * 40, 4.0, 0.0), ("ddd", 0.5, 0.25)],
                                    "term string, w0 double, w1 double")
    docs = spark.createDataFrame([(1, ["aaa", "aaa", "bbb"]), (1, ["c" * 40, "zzz"]), (None, []), (2, ["ddd", "bbb"])],
                                 "post_id int, toks array<string>")

    def run():
        rows = CL.score_terms(docs, "toks", (weights, [0.0, 0.25])).collect()
        return sorted((r["post_id"] or 0, list(r["logits"])) for r in rows)
    want = [(0, [0.0, 0.25]), (1, [0.0, -1.25]), (1, [4.0, 0.25]), (2, [-1.5, 1.0])]
    assert run() == want
    monkeypatch.setattr(CL, "FREQUENT", 2)
    assert run() == want


def test_batch_functions_read_texts_as_java_does(spark):
    """Vertical tabs, Unicode spaces and letters, and patterns that RE2 lacks."""
    texts = ["a http://x\u000by @me #té ❤ßœ! b-c", "fi\u0001x\u001cy　z", "kill ékill you\u000bkill u", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    pats = [r"\bkill\b", r"\bkill\s+u\b", r"ki(?=ll)"]
    t = F.coalesce("t", F.lit(""))
    old = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        T.transliterate(T.remove_emoji(t)), r"http\S+", ""), r"@\w+", ""), r"#\w+", ""), r"[^A-Za-z0-9\s]+", ""), r"\s+", " "))
    got = df.select("i", T.clean_text(F.col("t")).alias("c"), old.alias("c0"), T.word_count(F.col("t")).alias("n"),
                    F.regexp_count(t, F.lit(r"(?U)\S+")).alias("n0"), T.strip_ws(t).alias("s"),
                    F.regexp_replace(t, r"(?U)^\s+|\s+$", "").alias("s0"), F.array(*AR.pattern_counts(t, pats)).alias("p"),
                    F.array(*[F.regexp_count(t, F.lit("(?i)" + p)) for p in pats]).alias("p0")).collect()
    for r in got:
        assert (r["c"], r["n"], r["s"], r["p"]) == (r["c0"], r["n0"], r["s0"], r["p0"])


def test_lemmas_and_languages_alike_held_and_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(1, " The Cats\u000bran  home "), (1, None), (2, ""), (None, "Dogs ran"), (3, "Dogs ran")], "n int, t string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("cats", "cats"), ("ran", "run")], "token string, lemma string")
    train = spark.createDataFrame([("the cats ran", "en"), ("die katzen  liefen", "de"), ("les chats \u00e9t\u00e9", "fr")], "text string, lang string")
    more = spark.createDataFrame([(1, "the Cats"), (2, "DIE katzen"), (3, "xyz\u00e9t\u00e9"), (4, None), (5, " \n"), (6, "a")], "n int, text string")

    def run():
        a = TP.lemmatize(docs, "t", lemmas).collect()
        b = LG.detect_trigrams(more, LG.fit_trigrams(train)).collect()
        return sorted((r["n"] or 0, r["t"] or "", r["lemmatized"]) for r in a), sorted((r["n"], r["language_detected"]) for r in b)
    held = run()
    assert [x[2] for x in held[0]] == ["dog run", "", "the cat run home", "", "dog run"]
    assert [x[1] for x in held[1]][:5] == ["en", "de", "fr", "unknown", "unknown"]
    monkeypatch.setattr(TP, "LEMMAS", 0)
    monkeypatch.setattr(LG, "GRAMS", 0)
    assert run() == held


def test_held_tables_need_no_exchange_of_words(spark):
    docs = spark.createDataFrame([(1, "the cats")], "n int, text string")
    lemmas = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    model = LG.fit_trigrams(spark.createDataFrame([("the cats", "en")], "text string, lang string"))
    for df in (TP.lemmatize(docs, "text", lemmas), LG.detect_trigrams(docs, model)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_held_weights_need_no_rows_of_words(spark):
    """Scores are summed where the post is."""
    weights = spark.createDataFrame([("aaa", 1.0, -1.0), ("bbb", -2.0, 0.5)], "term string, w0 double, w1 double")
    docs = spark.createDataFrame([(1, ["aaa", "aaa", "zzz"]), (2, None), (3, []), (4, [None, "bbb"])], "n int, toks array<string>")
    df = CL.score_terms(docs, "toks", (weights, [0.0, 0.25]))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "Aggregate" not in plan
    assert {r["n"]: list(r["logits"]) for r in df.collect()} == {1: [2.0, -1.75], 2: [0.0, 0.25], 3: [0.0, 0.25], 4: [-2.0, 0.75]}


def test_training_counts_words_inside_the_tasks(spark):
    """No row per word is made."""
    docs = spark.createDataFrame([(0, ["aa", "bb", "aa", None]), (1, ["aa"]), (1, None), (0, [])], "y int, toks array<string>")
    df = AR.term_counts(docs, "y", "toks")
    assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
    counts = df.groupBy("y", "term").agg(F.sum("n").alias("n")).collect()
    assert {tuple(r) for r in counts} == {(0, "aa", 2), (0, "bb", 1), (1, "aa", 1)}


def test_words_and_keywords_of_odd_texts(spark):
    import re
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(" \t\n-AbCzxéß#@") for _ in range(rnd.randint(0, 30))) for _ in range(700)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    lists = [["a", "bc", "abcz", "-"], ["éßxx", "czé", "x#"]]
    for r in df.select("t", T.tokens(F.col("t")).alias("w"), AR.keyword_hits(F.lower("t"), lists).alias("h")).collect():
        low = (r["t"] or "").lower()
        assert r["w"] == [w.lower() for w in re.findall(T.TOKEN_PATTERN, r["t"] or "") if w.lower() not in T.STOPWORDS]
        assert r["h"] == [sum(w in low for w in ws) for ws in lists]
