"""The reports over stored result parts: overview (G8) and community summaries
(G17), with their co-group by community (JN3) and key union (U1).

Each part is aggregated once, by grouping sets, for the levels asked for: one
row per community, one row for all posts, or both.  Labels and list entries
are counted first, so that what is ranked and packed is one row per entry and
not per post, and both lists and totals of a part come from one exchange of
it.  The parts then meet in one aggregation by (level, community): its keys
are the union of the parts' communities, and no part is joined with another.

Defined results: a missing label counts as ``Unknown``, an entity without a
type as ``UNKNOWN``; null and empty entries are part of the totals but of no
top list; equal counts are ordered by label or term; a part without rows is
null, its lists are empty where it has rows without entries; an empty dataset has an overview with null parts and no community.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import stats as ST

OVERALL, COMMUNITY = "overall", "community"
AVERAGED_SENTIMENTS = ("Positive", "Neutral", "Negative")
SOURCES = {"sentiment": "sentiment_analysis", "entities": "named_entity_linking",
           "emotion": "emotion_detection", "topics": "topic_detection", "flags": "behavior_flags",
           "keywords": "keywords_hashtags", "summaries": "summary_generation"}
KEYS = ["_overall", "_group"]


def _levels(df: DataFrame, levels, more: list[str] = ()) -> GroupedData:
    """``df`` grouped by its ``_group`` and ``more``, by ``more`` alone, or
    both."""
    sets = {COMMUNITY: ["_group", *more], OVERALL: list(more)}
    return df.groupingSets([[F.col(c) for c in sets[x]] for x in levels], "_group", *more)


def _level() -> Column:
    return F.grouping("_group").cast("int").alias("_overall")


def _percent(n: Column, total: Column) -> Column:
    return F.round(n / total * 100, 2)


def labelled(df: DataFrame, name: str, group: str, levels, label: Column, score: Column | None = None,
             averaged: tuple[str, ...] | None = None) -> DataFrame:
    """Per level and group the posts, the count and
    percentage of each label, the most frequent label and, with ``score``, each
    label's mean confidence (of the ``averaged`` labels alone, 0 where one is
    absent, if given)."""
    rows = df.select(F.col(group).alias("_group"), F.coalesce(label, F.lit(ST.UNKNOWN_LABEL)).alias("_label"),
                     (F.lit(0.0) if score is None else F.coalesce(score, F.lit(0.0))).alias("_score"))
    counts = _levels(rows, levels, ["_label"]).agg(_level(), F.count("*").alias("n"), F.sum("_score").alias("sum"))
    packed = counts.groupBy(*KEYS).agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct(
        (-F.col("n")).alias("order"), F.col("_label").alias("label"), "n", "sum"))).alias("l"))
    entries = F.col("l")

    def mapped(value):
        return F.map_from_entries(F.transform(entries, lambda x: F.struct(x["label"], value(x))))
    out = [F.col("total").alias(f"{name}_total_posts"), mapped(lambda x: x["n"]).alias(f"{name}_distribution"),
           mapped(lambda x: _percent(x["n"], F.col("total"))).alias(f"{name}_percentages"),
           entries[0]["label"].alias(f"{name}_dominant")]
    if score is not None:
        means = mapped(lambda x: F.round(x["sum"] / x["n"], 3))
        if averaged is not None:
            means = F.map_from_arrays(F.array(*[F.lit(x) for x in averaged]), F.array(
                *[F.coalesce(F.try_element_at(means, F.lit(x)), F.lit(0.0)) for x in averaged]))
        out.append(means.alias(f"{name}_average_confidence"))
    return packed.select(*KEYS, *out)


def flagged(df: DataFrame, name: str, group: str, levels, flags: str = "flags") -> DataFrame:
    """Count and percentage of the posts with each flag."""
    rows = df.select(F.col(group).alias("_group"), *[
        F.coalesce(F.col(f"{flags}.{f}"), F.lit(False)).alias(f) for f in ST.FLAG_NAMES])
    counts = _levels(rows, levels).agg(_level(), F.count("*").alias("total"),
                                       *[F.count_if(F.col(f)).alias(f) for f in ST.FLAG_NAMES])

    def mapped(value):
        return F.create_map(*[c for f in ST.FLAG_NAMES for c in (F.lit(f), value(F.col(f)))])
    return counts.select(*KEYS, F.col("total").alias(f"{name}_total_posts"),
                         mapped(lambda n: n).alias(f"{name}_counts"),
                         mapped(lambda n: _percent(n, F.col("total"))).alias(f"{name}_percentages"))


def itemised(df: DataFrame, name: str, group: str, levels, amounts: dict[str, Column],
             lists: dict[str, tuple[Column, int]] | None = None) -> list[DataFrame]:
    """Sums of ``amounts`` over the rows, and of each of ``lists`` (an array of
    strings, k) a map of its k most frequent entries, as two frames.  A row
    becomes its amounts and list entries in one explode, counted by (group,
    kind, entry) before either is made."""
    lists = lists or {}

    def item(kind, term, n):
        return F.struct(F.lit(kind).alias("kind"), term.cast("string").alias("term"), n.cast("long").alias("n"))
    arrays = [F.array(*[item(k, F.lit(None), F.coalesce(v, F.lit(0))) for k, v in amounts.items()])]
    arrays += [_entries(kind, c) for kind, (c, _) in lists.items()]
    rows = df.select(F.col(group).alias("_group"), F.explode_outer(F.concat(*arrays)).alias("i"))
    counts = rows.select("_group", "i.*").groupBy("_group", "kind", "term").agg(F.sum("n").alias("n"))
    counts = _levels(counts, levels, ["kind", "term"]).agg(_level(), F.sum("n").alias("n"))
    out = [counts.groupBy(*KEYS).agg(*[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"{name}_{k}")
                                       for k in amounts])]
    if lists:
        ranked = counts.where(F.col("kind").isin(*lists) & (F.col("term") != "")).withColumn(
            "rank", F.row_number().over(Window.partitionBy(*KEYS, "kind").orderBy(F.col("n").desc(), "term")))
        most = F.create_map(*[F.lit(x) for kind, (_, k) in lists.items() for x in (kind, k)])
        ranked = ranked.where(F.col("rank") <= max(k for _, k in lists.values())).where(
            F.col("rank") <= most[F.col("kind")])
        out.append(ranked.groupBy(*KEYS).agg(*[F.map_from_entries(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("kind") == kind, F.struct("rank", "term", "n")))), lambda x: F.struct(x["term"], x["n"])))
            .alias(f"{name}_{kind}") for kind in lists]))
    return out


def _entries(kind: str, values: Column) -> Column:
    return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda t: F.struct(
        F.lit(kind).alias("kind"), t.cast("string").alias("term"), F.lit(1).cast("long").alias("n")))


def _terms(df: DataFrame, name: str, group: str, levels, keywords: int, hashtags: int) -> list[DataFrame]:
    return itemised(df, name, group, levels,
                    {"total_posts": F.lit(1), "total_keywords": F.size(F.coalesce("keywords", F.array())),
                     "total_hashtags": F.size(F.coalesce("hashtags", F.array()))},
                    {"top_keywords": (F.col("keywords"), keywords), "top_hashtags": (F.col("hashtags"), hashtags)})


def _entities(df: DataFrame, name: str, group: str, levels) -> list[DataFrame]:
    found = F.col("linked_entities")
    return itemised(df, name, group, levels,
                    {"total_posts_with_entities": F.lit(1), "total_entities_found": F.col("entity_count"),
                     "total_entities_linked": F.col("linked_entity_count")},
                    {"entity_types": (F.transform(found, lambda e: F.coalesce(e["type"], F.lit("UNKNOWN"))), 10),
                     "top_entities": (F.transform(found, lambda e: e["entity"]), 15)})


def _mean(total: str, count: str) -> Column:
    return F.round(F.col(total) / F.col(count), 2)


def report(pre: DataFrame, sentiment: DataFrame, emotion: DataFrame, topics: DataFrame, flags: DataFrame,
           keywords: DataFrame, entities: DataFrame | None = None, summaries: DataFrame | None = None,
           levels=(OVERALL, COMMUNITY), group: str = "subreddit", keywords_listed: int = 20) -> DataFrame:
    """One row per level and group with the columns of all parts
    (``<part>_<measure>``), ``total_posts_in_dataset``, ``_overall`` (1: the
    row of all posts) and ``_group``."""
    parts = [
        labelled(sentiment, "sentiment", group, levels, F.col("sentiment.label"), F.col("sentiment.score"),
                 AVERAGED_SENTIMENTS),
        labelled(emotion, "emotion", group, levels, F.col("emotion.label"), F.col("emotion.score")),
        labelled(topics, "topic", group, levels, F.col("topic.label")),
        flagged(flags, "behavior_flag", group, levels),
        *_terms(keywords, "keywords", group, levels, keywords_listed, 20)]
    extra = {"keywords_avg_keywords_per_post": _mean("keywords_total_keywords", "keywords_total_posts"),
             "keywords_avg_hashtags_per_post": _mean("keywords_total_hashtags", "keywords_total_posts")}
    if entities is not None:
        parts += _entities(entities, "entities", group, levels)
        found, linked = F.col("entities_total_entities_found"), F.col("entities_total_entities_linked")
        extra["entities_link_success_rate"] = F.when(found > 0, _percent(linked, found)).when(found == 0, F.lit(0.0))
        extra["entities_avg_entities_per_post"] = _mean("entities_total_entities_found",
                                                        "entities_total_posts_with_entities")
    if summaries is not None:
        parts += itemised(summaries, "summaries", group, levels,
                          {"total_summaries": F.lit(1), "words": T.word_count(F.col("summary"))})
        extra["summaries_avg_summary_length_words"] = _mean("summaries_words", "summaries_total_summaries")
    if COMMUNITY in levels:
        parts.append(pre.select(F.lit(0).alias("_overall"), F.col(group).alias("_group")).groupBy(*KEYS).agg(
            F.count("*").alias("total_posts_in_dataset")))
    if OVERALL in levels:
        parts.append(pre.agg(F.count("*").alias("total_posts_in_dataset")).select(
            F.lit(1).alias("_overall"), F.lit(None).cast("string").alias("_group"), "total_posts_in_dataset"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    measures = [c for c in rows.columns if c not in KEYS]
    # every measure comes from one part, so a level and group have one value
    met = rows.groupBy(*KEYS).agg(*[F.first(c, ignorenulls=True).alias(c) for c in measures])
    lists = {"keywords_top_keywords": "keywords_total_posts", "keywords_top_hashtags": "keywords_total_posts",
             "entities_entity_types": "entities_total_posts_with_entities",
             "entities_top_entities": "entities_total_posts_with_entities"}
    for c, of in lists.items():
        if c in measures:
            empty = F.create_map().cast("map<string,bigint>")
            extra[c] = F.when(F.col(of).isNotNull(), F.coalesce(c, empty))
    return met.withColumns(extra).drop("summaries_words")


def overview(pre: DataFrame, sentiment: DataFrame, emotion: DataFrame, topics: DataFrame,
             flags: DataFrame, keywords: DataFrame, entities: DataFrame | None = None,
             summaries: DataFrame | None = None, generated_at=None) -> DataFrame:
    """One row -- generation stamp, pipeline version, data sources, total
    posts, and per part its totals, counts, percentages, mean confidences and
    top lists (20 keywords, 20 hashtags, 10 entity types)."""
    given = {"sentiment": sentiment, "entities": entities, "emotion": emotion, "topics": topics,
             "flags": flags, "keywords": keywords, "summaries": summaries}
    row = report(pre, **given, levels=(OVERALL,)).drop(*KEYS, "entities_top_entities")
    at = F.lit(generated_at).cast("timestamp") if generated_at is not None else F.current_timestamp()
    return row.select(at.alias("generated_at"), F.lit("1.0").alias("pipeline_version"),
                      F.array(*[F.lit(SOURCES[k]) for k, v in given.items() if v is not None]).alias("data_sources"),
                      "*")


def community_summaries(pre: DataFrame, sentiment: DataFrame, emotion: DataFrame, topics: DataFrame,
                        flags: DataFrame, keywords: DataFrame, entities: DataFrame | None = None,
                        summaries: DataFrame | None = None, posts: DataFrame | None = None,
                        group: str = "subreddit") -> DataFrame:
    """G17 (G9-G16, JN3): one row per community that any part has, without
    unknown, empty and null names; a struct per part (30 keywords, 20
    hashtags, 10 entity types, 15 entities)."""
    rows = report(pre, sentiment, emotion, topics, flags, keywords, entities, summaries, levels=(COMMUNITY,),
                  group=group, keywords_listed=30)
    rows = rows.where(F.col("_group").isNotNull() & ~F.col("_group").isin("", "unknown"))
    meta = ST.community_metadata(posts if posts is not None else pre, group)
    meta = meta.select(F.col(group).alias("_group"),
                       F.struct(*[c for c in meta.columns if c != group]).alias("metadata"))

    def part(prefix: str, name: str, present: str) -> Column:
        columns = [c for c in rows.columns if c.startswith(prefix + "_")]
        return F.when(F.col(present).isNotNull(), F.struct(
            *[F.col(c).alias(c.removeprefix(prefix + "_")) for c in columns])).alias(name)
    structs = [part("sentiment", "sentiment_analysis", "sentiment_total_posts"),
               part("emotion", "emotion_detection", "emotion_total_posts"),
               part("topic", "topic_detection", "topic_total_posts"),
               part("behavior_flag", "behavior_flags", "behavior_flag_total_posts"),
               part("keywords", "keywords_hashtags", "keywords_total_posts")]
    if entities is not None:
        structs.append(part("entities", "named_entity_linking", "entities_total_posts_with_entities"))
    if summaries is not None:
        structs.append(part("summaries", "summary_generation", "summaries_total_summaries"))
    return rows.join(meta, "_group", "left").select(F.col("_group").alias(group), "metadata", *structs)
