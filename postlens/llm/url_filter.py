"""URL filter: host word segmentation and multinomial naive Bayes.

Names in hosts are run-together words.  A unigram model (the words of the
pages' visible text and their counts) splits each name into the likeliest
words by the Viterbi recursion.  The words of the host and the tokens of the
path are the features of a naive Bayes model with two classes, which is
trained on the urls that a given rule already allows or blocks, and on those
whose host has one of a few seed words (blocked); it judges all urls without
a rule.

The unigram counts are never gathered in one place: the substrings of the
distinct names meet the counts in a join, and a name's Viterbi recursion
needs the counts of its own substrings alone.  Features are hashed into
``BUCKETS`` buckets, which bounds the naive Bayes model; all urls with a
rule train it, none is left out.

Defined results: a url that is null or has no ``://`` has an empty host and
path, no rule, and is judged by the class frequencies; without any url to
train on, every url is allowed; repeated rows are judged alike (and each
counts in training); an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_in_arrow, materialize

BUCKETS = 1 << 16      # of hashed features
SMOOTHING = 0.5        # added to each feature count
LONGEST_WORD = 20      # letters of a word in the unigram model
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed values: (host, path, verdict) of the rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


#: Seed words: a url without a rule trains as blocked if its host has one.
BLOCK_WORDS = ("ads", "adult", "bet", "bets", "casino", "poker", "porn", "viagra")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def ruling(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def unigrams(pages: DataFrame, seeds=BLOCK_WORDS) -> DataFrame:
    """(word, n): the words a-z of the pages' visible text, and the seed
    words as if each were met once more."""
    visible = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<[^>]*>", " ")
    words = F.split(F.translate(visible, UPPER, LOWER), "[^a-z]+")
    given = pages.sparkSession.createDataFrame([(w,) for w in seeds], "word string")
    return (pages.select(F.explode(words).alias("word"))
            .where((F.col("word") != "") & (F.length("word") <= LONGEST_WORD))
            .unionByName(given).groupBy("word").agg(F.count("*").alias("n")))


def viterbi(name: str, words: list[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest words of a name.  ``words``: (place, letters, count) of
    the substrings that are words.  An unknown letter run costs ten times
    more with each letter, and always more than a known word."""
    n = len(name)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for place, letters, count in sorted(words):
        ends[place + letters].append((place, math.log(count / total)))
    unknown = [-math.log(max(total, 1)) - k * math.log(10) for k in range(LONGEST_WORD + 1)]
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        ways = ends[end] + [(end - k, unknown[k]) for k in range(1, min(LONGEST_WORD, end) + 1)]
        for place, gain in ways:
            if best[place] + gain > best[end]:
                best[end], back[end] = best[place] + gain, place
    out, end = [], n
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct names."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    places = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("place"))
    parts = places.select("name", "place", F.explode(F.sequence(F.lit(1), F.least(
        F.lit(LONGEST_WORD), F.length("name") - F.col("place")))).alias("letters")).withColumn(
        "word", F.substring("name", F.col("place") + 1, F.col("letters")))
    known = parts.join(counts, "word").groupBy("name").agg(
        F.collect_list(F.struct("place", "letters", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name = b.column("name")
            found = [viterbi(x, [(k["place"], k["letters"], k["n"]) for k in known or ()], total)
                     for x, known in zip(name.to_pylist(), b.column("known").to_pylist())]
            yield pa.RecordBatch.from_arrays([name, pa.array(found, pa.list_(pa.string()))],
                                             names=["name", "words"])

    return map_in_arrow(names.join(known, "name", "left").select("name", "known"), run,
                        "name string, words array<string>")


def host_words(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, host_words) of the distinct hosts, words in their order."""
    labels = (urls.select("host").distinct()
              .select("host", F.posexplode(F.split("host", r"[^\p{L}\p{N}]+")).alias("at", "name"))
              .where("name != ''"))
    words = segmented(labels.select("name").distinct(), counts)
    return labels.join(words, "name").groupBy("host").agg(F.flatten(F.transform(F.array_sort(
        F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("host_words"))


def path_tokens(path: Column) -> Column:
    """Letter runs and numbers of the path; a number counts by its length."""
    plain = F.translate(F.translate(path, UPPER, LOWER), "123456789", "000000000")
    return F.array_remove(F.split(plain, "[^a-z0]+"), "")


def features(urls: DataFrame) -> Column:
    """Hashed buckets of the host's words and the path's tokens."""
    def hashed(kind: str, tokens: Column) -> Column:
        return F.transform(tokens, lambda x: F.pmod(F.xxhash64(F.lit(kind), x), F.lit(BUCKETS)).cast("int"))

    return F.concat(hashed("host", F.coalesce("host_words", F.array().cast("array<string>"))),
                    hashed("path", path_tokens(F.col("path"))))


def train(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds of block against allow for each bucket, and of the classes.
    ``labelled``: (buckets, label)."""
    classes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(
        F.count("*").alias("n")).collect()}
    count = {c: np.full(BUCKETS, SMOOTHING) for c in ("allow", "block")}
    rows = labelled.select("label", F.explode("buckets").alias("bucket")).groupBy(
        "label", "bucket").agg(F.count("*").alias("n"))
    for r in rows.collect():        # at most two rows for each bucket
        count[r["label"]][r["bucket"]] += r["n"]
    odds = (np.log(count["block"] / count["block"].sum())
            - np.log(count["allow"] / count["allow"].sum()))
    if not classes:
        return np.zeros(BUCKETS), -1.0
    return odds, math.log((classes.get("block", 0) + SMOOTHING) / (classes.get("allow", 0) + SMOOTHING))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, host_words) of every
    page; score: the model's log odds of block."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    words = host_words(urls, unigrams(pages))
    rule, verdict = ruling(F.col("host"), F.col("path"), rules)
    rows = urls.join(words, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"),
        F.array_join("host_words", " ").alias("host_words"), features(urls).alias("buckets"),
        F.coalesce(verdict, F.when(F.arrays_overlap("host_words", F.array(*map(F.lit, BLOCK_WORDS))),
                                   "block")).alias("label"))
    rows = materialize(rows, "urls")
    odds, prior = train(rows.where("label IS NOT NULL").select("label", "buckets"))
    model = pages.sparkSession.sparkContext.broadcast(odds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("buckets")
            ends = flat.offsets.to_numpy()
            sums = np.concatenate([[0.0], np.cumsum(model.value[flat.values.to_numpy()])])
            score = prior + sums[ends[1:]] - sums[ends[:-1]]
            own = np.where(score > 0, "block", "allow")
            verdict = [v or w for v, w in zip(b.column("verdict").to_pylist(), own.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in ("page_id", "host", "path", "rule")),
                 pa.array(verdict, pa.string()), pa.array(score), b.column("host_words")],
                names=["page_id", "host", "path", "rule", "verdict", "score", "host_words"])

    return map_in_arrow(rows.select(F.col("page_id").cast("bigint").alias("page_id"), "host", "path",
                                    "rule", "verdict", "host_words", "buckets"), run,
                        "page_id bigint, host string, path string, rule string, verdict string, "
                        "score double, host_words string")
