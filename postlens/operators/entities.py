"""Entity recognition, linking and the per-post entity table
(SURVEY C12, C13, C14, A5, A6).

Re-aimed from a per-row NER model and one web search per entity to two
tables: a gazetteer ``(alias, type, kb_id)`` and a knowledge base
``(name, rank, title, page_id, snippet)``.

Recognition numbers the rows and writes them once.  The words of a text meet
the index of the aliases' first words (first word, longest alias), which every
task holds up to ``FIRST_WORDS`` of them; only at the words that start some
alias are n-grams built, up to that length, and looked up in the gazetteer by
an equi-join (those of a gazetteer of up to ``ALIASES`` are picked before).  The longest leftmost non-overlapping matches win.  Texts never
leave their partition, and what is regrouped is a few short spans.
Linking is an equi-join of the entity's normal form with the knowledge base's
names.  Spark picks broadcast joins by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow as AR
from ..functions import text as T
from ..session import stored

# Fixed values of the reference: minimum text length for recognition and
# for the entity job, minimum entity length, link URL format, snippet cap.
MIN_TEXT_CHARS = 3
MIN_JOB_TEXT_CHARS = 10
MIN_ENTITY_CHARS = 2
# First words of aliases, and aliases, that every task holds; with more of them
# the words or the n-grams of the texts all meet them in a join.
FIRST_WORDS = ALIASES = 1 << 18
LINK_URL_PREFIX = "https://en.wikipedia.org/?curid="

WORD_RE = r"(\s*)(\S+)"
EDGE_RE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"

ENTITY_TYPE = ("struct<entity:string,type:string,start:int,end:int,kb_id:string>")


def normalize_alias(c: Column) -> Column:
    """Alias / word normal form: lower-case, edge punctuation removed,
    inner whitespace collapsed."""
    words = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\S+"), 0),
                        lambda w: F.lower(F.regexp_replace(w, EDGE_RE, "")))
    return F.array_join(F.filter(words, lambda w: w != ""), " ")


def _normal_words(text: Column) -> Column:
    """The words of a text in normal form ('' for punctuation alone)."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\S+"), 0),
                       lambda w: F.lower(F.regexp_replace(w, EDGE_RE, "")))


def _with_words(df: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("__ws", F.regexp_extract_all(t, F.lit(WORD_RE), 1)) \
           .withColumn("__w", F.regexp_extract_all(t, F.lit(WORD_RE), 2))
    return df.withColumn("__nw", F.transform(F.col("__w"), lambda w: F.lower(F.regexp_replace(w, EDGE_RE, "")))) \
             .withColumn("__span", F.transform(F.col("__w"), lambda w, j: F.length(F.get(F.col("__ws"), j)) + F.length(w)))


def _hits_with_offsets() -> Column:
    """``__hits`` with the characters before each, summed as one goes on."""
    span = F.col("__span")
    first = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("upto"),
                     F.array().cast("array<struct<i:int,longest:int,chars:int>>").alias("out"))

    def step(acc, h):
        chars = F.aggregate(F.slice(span, acc["upto"] + 1, h["i"] - acc["upto"]), acc["chars"], lambda a, n: a + n)
        return F.struct(chars.alias("chars"), h["i"].alias("upto"), F.concat(acc["out"], F.array(F.struct(
            h["i"].alias("i"), h["longest"].alias("longest"), chars.alias("chars")))).alias("out"))
    return F.aggregate("__hits", first, step, lambda acc: acc["out"])


def _candidates() -> Column:
    """All n-grams that start at ``__at`` (i, longest, chars), with their span
    in the text and their surface form."""
    def at_hit(h):
        def gram(n):
            words = F.slice(F.col("__nw"), h["i"] + 1, n)
            raw = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.concat(
                F.when(k > 0, F.get(F.col("__ws"), h["i"] + k)).otherwise(""), F.get(F.col("__w"), h["i"] + k))), "")
            lead = F.length(F.regexp_extract(F.get(F.col("__w"), h["i"]), r"^[^\p{L}\p{N}]*", 0))
            return F.when(~F.array_contains(words, ""), F.struct(
                h["i"].alias("i"), n.alias("n"), F.array_join(words, " ").alias("gram"),
                (h["chars"] + F.length(F.get(F.col("__ws"), h["i"])) + lead).alias("start"),
                F.regexp_replace(raw, EDGE_RE, "").alias("entity")))
        return F.transform(F.sequence(F.lit(1), F.least(h["longest"], F.size("__nw") - h["i"])), gram)
    return F.filter(F.flatten(F.transform(F.col("__at"), at_hit)), lambda c: c.isNotNull())


def _longest_leftmost(matches: Column) -> Column:
    """Of matches sorted by (i, -n) those that overlap none before them."""
    kind = "array<struct<i:int,neg_n:int,type:string,kb_id:string,entity:string,start:int>>"
    return F.aggregate(
        matches, F.struct(F.array().cast(kind).alias("keep"), F.lit(-1).alias("end")),
        lambda acc, m: F.when(m["i"] > acc["end"], F.struct(F.concat(acc["keep"], F.array(m)).alias("keep"),
                                                            (m["i"] - m["neg_n"] - 1).alias("end"))).otherwise(acc),
        lambda acc: acc["keep"])


def prepare_gazetteer(gazetteer: DataFrame) -> DataFrame:
    """One row per normalised alias (first type/kb_id in a total order)."""
    g = gazetteer.select(normalize_alias(F.col("alias")).alias("gram"), "type", "kb_id") \
        .where(F.col("gram") != "")
    return g.groupBy("gram").agg(F.min(F.struct("type", "kb_id")).alias("v")) \
        .select("gram", F.col("v.type").alias("type"), F.col("v.kb_id").alias("kb_id"))


def first_words(gaz: DataFrame) -> DataFrame:
    """(first, longest): the words that start an alias, with the length in
    words of the longest alias that they start."""
    words = F.split("gram", " ")
    return gaz.groupBy(F.get(words, 0).alias("first")).agg(F.max(F.size(words)).alias("longest"))


def _candidates_by_join(rows: DataFrame, key: str, text: str, starts: DataFrame) -> DataFrame:
    """(key, i, n, gram, start, entity) where ``starts`` is too large to be held
    by every task."""
    words = rows.select(key, F.posexplode(_normal_words(F.col(text))).alias("i", "first")).where(F.col("first") != "")
    hits = words.join(starts, "first").groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("i", "longest"))).alias("__hits"))
    met = _with_words(rows.select(key, text).join(hits, key), text).withColumn("__at", _hits_with_offsets())
    return met.select(key, F.explode(_candidates()).alias("c")).select(key, "c.*")


def recognise(rows: DataFrame, key: str, text: str, gazetteer: DataFrame) -> DataFrame:
    """(key, entities) of the rows that have any; ``key`` is unique."""
    gaz = stored(prepare_gazetteer(gazetteer), "gazetteer")
    starts = first_words(gaz)
    rows = rows.where(F.length(T.strip_ws(F.col(text))) >= MIN_TEXT_CHARS)
    known = starts.limit(FIRST_WORDS + 1).collect()
    if len(known) <= FIRST_WORDS:
        aliases = gaz.select("gram").limit(ALIASES + 1).collect()
        wanted = frozenset(r["gram"] for r in aliases) if len(aliases) <= ALIASES else None
        index = rows.sparkSession.sparkContext.broadcast(({r["first"]: r["longest"] for r in known}, wanted))
        cand = rows.select(key, F.explode(AR.grams_at(F.col(text), index)).alias("c")).select(key, "c.*")
    else:
        cand = _candidates_by_join(rows, key, text, starts)
    matches = cand.join(gaz, "gram").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        "i", (-F.col("n")).alias("neg_n"), "type", "kb_id", "entity", "start"))).alias("__m"))
    kept = F.filter(_longest_leftmost(F.col("__m")), lambda m: F.length(m["entity"]) >= MIN_ENTITY_CHARS)
    return matches.select(key, F.transform(kept, lambda m: F.struct(
        m["entity"].alias("entity"), m["type"].alias("type"), m["start"].alias("start"),
        (m["start"] + F.length(m["entity"])).alias("end"), m["kb_id"].alias("kb_id"))).alias("entities"))


def extract_entities(df: DataFrame, text: str, gazetteer: DataFrame,
                     out: str = "entities") -> DataFrame:
    """``out`` = array of struct(entity, type, start, end, kb_id) with
    0-based character offsets (end exclusive), in text order.  Rows are
    numbered, so repeated or null post keys cannot mix posts."""
    rows = stored(df.withColumn("__row", F.monotonically_increasing_id()), "posts")
    found = recognise(rows, "__row", text, gazetteer).withColumnRenamed("entities", "__found")
    return rows.join(found, "__row", "left").withColumn(
        out, F.coalesce(F.col("__found"), F.array().cast(f"array<{ENTITY_TYPE}>"))).drop("__row", "__found")


def dedup_entities(df: DataFrame, ents: str, out: str) -> DataFrame:
    """The first occurrence of each case-folded entity text, in text
    order: sorted by text inside the row, so no pair of entities is compared."""
    z = f"__{out}_sorted"
    df = df.withColumn(z, F.array_sort(F.transform(ents, lambda e: F.struct(
        F.lower(e["entity"]).alias("name"), e["start"].alias("start"), e.alias("e")))))
    first = F.filter(F.col(z), lambda x, i: F.coalesce(F.get(F.col(z), i - 1)["name"] != x["name"], F.lit(True)))
    by_place = F.array_sort(F.transform(first, lambda x: F.struct(x["start"].alias("start"), x["e"].alias("e"))))
    return df.withColumn(out, F.transform(by_place, lambda x: x["e"])).drop(z)


def best_kb(kb: DataFrame) -> DataFrame:
    """Best-ranked KB row per normalised name, with the linked fields."""
    best = kb.groupBy(normalize_alias(F.col("name")).alias("__name")).agg(F.min_by(
        F.struct("title", "page_id", "snippet"), F.struct("rank", "page_id")).alias("b")).where(F.col("__name") != "")
    return best.select(
        "__name",
        F.struct(F.col("b.title").alias("title"),
                 F.concat(F.lit(LINK_URL_PREFIX), F.col("b.page_id").cast("string")).alias("url"),
                 F.substring(T.strip_tags(F.col("b.snippet")), 1, T.LINK_SNIPPET_CHARS).alias("snippet"))
        .alias("wikipedia"))


def link_entities(found: DataFrame, ents: str, kb: DataFrame, key: str, out: str = "linked_entities") -> DataFrame:
    """(key, out): the entities of each row that a knowledge-base name
    equals in normal form; unlinked entities and rows without any linked one
    are dropped.  ``key`` is unique."""
    ex = found.select(key, F.explode(ents).alias("e")).withColumn("__name", normalize_alias(F.col("e.entity")))
    linked = ex.join(best_kb(kb), "__name").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        F.col("e.start").alias("start"), F.col("e.entity").alias("entity"),
        F.col("e.type").alias("type"), F.col("e.end").alias("end"), "wikipedia"))).alias("__l"))
    return linked.select(key, F.transform("__l", lambda x: F.struct(
        x["entity"].alias("entity"), x["type"].alias("type"), x["start"].alias("start"),
        x["end"].alias("end"), x["wikipedia"].alias("wikipedia"))).alias(out))


def entity_table(posts: DataFrame, gazetteer: DataFrame, kb: DataFrame, key: str = "post_id") -> DataFrame:
    """C14: text chain translated -> cleaned -> title + body/content (at
    least 10 chars); entities (count before dedup), first occurrence per
    case-folded text, linked only; posts without a linked entity dropped.
    Posts that share a key, or have none, stay posts of their own."""
    cols = posts.columns

    def c(name):
        return F.col(name) if name in cols else F.lit(None).cast("string")
    text = T.pick_text([c("translated_text"), c("cleaned_text")], c("title"), c("body"), c("content"))
    keep = [x for x in ("_id", key, "subreddit", "author", "created_utc", "permalink", "title") if x in cols]
    base = posts.select(*keep, text.alias("__t")).where(F.length("__t") >= MIN_JOB_TEXT_CHARS)
    rows = stored(base.withColumn("__row", F.monotonically_increasing_id()), "posts")
    found = stored(recognise(rows, "__row", "__t", gazetteer), "found")
    linked = link_entities(dedup_entities(found, "entities", "__d"), "__d", kb, "__row")
    both = found.select("__row", F.size("entities").cast("int").alias("entity_count")).join(linked, "__row")
    return rows.select(*keep, "__row", T.snippet(F.col("__t")).alias("text_analyzed")).join(both, "__row").select(
        *keep, "text_analyzed", "entity_count",
        F.size("linked_entities").cast("int").alias("linked_entity_count"), "linked_entities")
