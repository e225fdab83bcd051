"""Overview and community summaries against a plain Python version, on parts
with missing labels, ties, empty lists, odd communities and no rows at all."""

import random
from collections import Counter

import pytest

from postlens.operators.stats import FLAG_NAMES
from postlens.plans import summaries as SM

ENTITY = "array<struct<entity:string,type:string>>"
SCHEMAS = {
    "pre": "post_id string, subreddit string, author string, score long, num_comments long",
    "sentiment": "subreddit string, sentiment struct<label:string,score:double>",
    "emotion": "subreddit string, emotion struct<label:string,score:double>",
    "topics": "subreddit string, topic struct<label:string,score:double>",
    "flags": "subreddit string, flags struct<" + ",".join(f"{f}:boolean" for f in FLAG_NAMES) + ">",
    "keywords": "subreddit string, keywords array<string>, hashtags array<string>",
    "entities": f"subreddit string, entity_count int, linked_entity_count int, linked_entities {ENTITY}",
    "summaries": "subreddit string, summary string"}


def rows():
    r = random.Random(5)
    names = ["a", "a", "a", "b", "c", "unknown", "", None]
    out = {k: [] for k in SCHEMAS}
    words = [f"w{i}" for i in range(60)] + ["", None]
    for i in range(300):
        g = r.choice(names)
        out["pre"].append((str(i), g, r.choice(["x", "y", "", None]), r.randrange(9), r.choice([1, 2, None])))
        out["sentiment"].append((g, (r.choice(["Positive", "Negative", None]), r.choice([0.5, 0.25, None]))))
        out["topics"].append((g, (r.choice(["news", "tech", None]), 1.0)))
        out["flags"].append((g, tuple(r.choice([True, False, None]) for _ in FLAG_NAMES)))
        out["keywords"].append((g, r.choice([None, [], r.choices(words, k=9)]),
                                r.choice([None, [], r.choices(["#a", "#b", "#ü"], k=2)]) if g != "b" else None))
        found = [(r.choice(["N", "M", "", None]), r.choice(["LOC", None])) for _ in range(r.randrange(4))]
        out["entities"].append((g, len(found) + 1, len(found), r.choice([found, found, None])))
        out["summaries"].append((g, r.choice(["", None, "one two", " three\tfour  five "])))
    out["emotion"] = [("a", ("joy", 0.5)), ("d", ("anger", 1.0)), ("d", ("joy", 0.5))]
    return out


def most(values, k):
    return dict(sorted(Counter(v for v in values if v).items(), key=lambda x: (-x[1], x[0]))[:k])


def by_hand(data, keep, listed):
    part = {k: [x for x in v if keep(x[1] if k == "pre" else x[0])] for k, v in data.items()}
    out = {}
    for name, key in (("sentiment", "sentiment"), ("emotion", "emotion"), ("topic", "topics")):
        got = [(x[1][0] or "Unknown", x[1][1] or 0.0) for x in part[key]]
        counts = most([x[0] for x in got], None)
        if got:
            means = {k: round(sum(s for x, s in got if x == k) / n, 3) for k, n in counts.items()}
            out[name] = {"total_posts": len(got), "distribution": counts, "dominant": next(iter(counts)),
                         "percentages": {k: round(n / len(got) * 100, 2) for k, n in counts.items()}}
            if name == "sentiment":
                means = {k: means.get(k, 0.0) for k in SM.AVERAGED_SENTIMENTS}
            if name != "topic":
                out[name]["average_confidence"] = means
    n = len(part["flags"])
    if n:
        hits = {f: sum(bool(x[1][i]) for x in part["flags"]) for i, f in enumerate(FLAG_NAMES)}
        out["behavior_flag"] = {"total_posts": n, "counts": hits,
                                "percentages": {f: round(c / n * 100, 2) for f, c in hits.items()}}
        kw, ht = ([w for x in part["keywords"] for w in x[i] or []] for i in (1, 2))
        out["keywords"] = {"total_posts": n, "total_keywords": len(kw), "total_hashtags": len(ht),
                           "avg_keywords_per_post": round(len(kw) / n, 2), "avg_hashtags_per_post": round(len(ht) / n, 2),
                           "top_keywords": most(kw, listed), "top_hashtags": most(ht, 20)}
        found, linked = (sum(x[i] for x in part["entities"]) for i in (1, 2))
        each = [e for x in part["entities"] for e in x[3] or []]
        out["entities"] = {"total_posts_with_entities": n, "total_entities_found": found,
                           "total_entities_linked": linked, "link_success_rate": round(linked / found * 100, 2),
                           "avg_entities_per_post": round(found / n, 2),
                           "entity_types": most([e[1] or "UNKNOWN" for e in each], 10),
                           "top_entities": most([e[0] for e in each], 15)}
        words = sum(len((x[1] or "").split()) for x in part["summaries"])
        out["summaries"] = {"total_summaries": n, "avg_summary_length_words": round(words / n, 2)}
    return out


def close(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        if isinstance(v, dict):
            assert list(got[k].items()) == pytest.approx(list(v.items())) if not v else set(got[k]) == set(v)
            assert got[k] == pytest.approx(v, abs=0.0101), k
        elif isinstance(v, float):
            assert got[k] == pytest.approx(v, abs=0.0101), k
        else:
            assert got[k] == v, k


STRUCTS = {"sentiment": "sentiment_analysis", "emotion": "emotion_detection", "topic": "topic_detection",
           "behavior_flag": "behavior_flags", "keywords": "keywords_hashtags", "entities": "named_entity_linking",
           "summaries": "summary_generation"}


def frames(spark, data):
    return {k: spark.createDataFrame(data[k], s) for k, s in SCHEMAS.items()}


def test_overview(spark):
    data = rows()
    got = SM.overview(**frames(spark, data), generated_at="2024-01-01 00:00:00").collect()
    assert len(got) == 1
    row = got[0].asDict()
    want = by_hand(data, lambda g: True, 20)
    del want["entities"]["top_entities"]
    assert row["total_posts_in_dataset"] == 300 and len(row["data_sources"]) == 7
    for part, measures in want.items():
        close({k.removeprefix(part + "_"): v for k, v in row.items() if k.startswith(part + "_")}, measures)


def test_community_summaries(spark):
    data = rows()
    got = {r["subreddit"]: r.asDict(True) for r in SM.community_summaries(**frames(spark, data)).collect()}
    assert set(got) == {"a", "b", "c", "d"}          # d is in one part alone
    for g, row in got.items():
        want = by_hand(data, lambda x, g=g: x == g, 30)
        for part, name in STRUCTS.items():
            if part in want:
                close(row[name], want[part])
            else:
                assert row[name] is None
        assert (row["metadata"] is None) == (g == "d")
        if g != "d":
            assert row["metadata"]["total_comments"] == sum(x[4] or 0 for x in data["pre"] if x[1] == g)
    assert got["b"]["keywords_hashtags"]["top_hashtags"] == {}


def test_reports_of_nothing(spark):
    empty = frames(spark, {k: [] for k in SCHEMAS})
    row = SM.overview(**empty).collect()
    assert len(row) == 1 and row[0]["total_posts_in_dataset"] == 0 and row[0]["sentiment_distribution"] is None
    assert SM.community_summaries(**empty).count() == 0


def test_both_levels_from_one_exchange_of_a_part(spark):
    """Totals and lists of the keywords come from one exchange of the posts."""
    data = rows()
    f = frames(spark, data)
    both = {(r["_overall"], r["_group"]): r["keywords_total_posts"] for r in SM.report(**f).collect()}
    assert both[1, None] == 300 and both[0, "a"] == sum(x[0] == "a" for x in data["keywords"])
    totals, lists = SM._terms(f["keywords"], "keywords", "subreddit", (SM.OVERALL, SM.COMMUNITY), 20, 20)
    met = totals.unionByName(lists, allowMissingColumns=True)
    met.collect()
    plan = met._jdf.queryExecution().explainString(met.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "ReusedExchange" in plan
