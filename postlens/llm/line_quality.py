"""Quality rules by cross-document line frequency, with DataFrame and SQL
functions alone.

Each line is normalised (lower case, digits to 0, white space to single
blanks) and hashed.  For every host (the column ``source``) the operator
counts in how many distinct documents a line stands; copies of one text
count as one document.  A line above the host's limit is boilerplate.  A
document loses its boilerplate lines, and is rejected if they leave too
little of it.  Rules about the text alone (``base``) come before.

What is known of a document is keyed by (id, host, text hash), so that texts
are shuffled only where the texts themselves are wanted.

Defined results: a null text has no lines and no words, so it fails the base
rules; null hosts make up one host; repeated rows get the same verdict and
count as one document; an empty table gives an empty table; other columns
are ignored by ``verdicts`` and kept by ``cleaned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# The white space that separates words, the symbols counted,
# and the limits of the base rules.
SPACES = " \t\n\u000b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8

# The limits of the method: a line is boilerplate if it stands in more than
# this many of its host's distinct documents, whatever the size of the host; a
# document is depleted if boilerplate leaves fewer words than the base rules
# ask for, or less than this share of its words.
LINE_DOCUMENTS = 20
LEFT_SHARE = 0.2


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WORD_BREAK))


def normal_line(line: Column) -> Column:
    """The form in which lines are compared across documents."""
    plain = F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACES))), "[1-9]", "0")
    # most lines have single blanks alone already and are not written anew
    return F.when(F.rlike(plain, F.lit(r"[\x09-\x0D]|  ")), F.regexp_replace(plain, WORD_BREAK, " ")).otherwise(plain)


def _halves(window: int) -> list[int]:
    """1, 2, 4, ...: the steps that double one word up to a window, whose
    length is a power of two."""
    return [1 << k for k in range(window.bit_length() - 1)]


def _doubled(hashes: Column, step: int) -> Column:
    """Each hash together with the one ``step`` places on."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step)))


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the base rules and ``base_failed``.

    Words in repeated windows: each window of words is hashed by doubling
    (two words, then two such pairs, then two such fours), the hashes are
    sorted with their places, those equal to a neighbour are repeated, and the
    words under them are counted by adding for each place, in order, the words
    up to the next."""
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("_words", _words(text)).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_words")
    for step in _halves(WINDOW):
        d = d.withColumn("_hashes", _doubled(F.col("_hashes"), step))
    d = d.withColumn("_windows", F.when(n > WINDOW, F.slice("_hashes", F.lit(1), n - WINDOW + 1))
                     .otherwise(F.array().cast("array<bigint>")))
    windows = F.col("_windows")
    d = d.withColumn("_sorted", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    s = F.col("_sorted")
    d = d.withColumn("_places", F.array_sort(F.transform(F.filter(
        s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
        lambda x: x["i"])))
    p = F.col("_places")
    repeated = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.withColumn("_lines", lines)
    d = (d.withColumn("n_words", F.size("_words").cast("long"))
         .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
         .withColumn("n_symbols", F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"))
         .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
         .withColumn("n_repeat_words", repeated))
    return d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))).drop(
        "_words", "_hashes", "_windows", "_sorted", "_places", "_lines")


KEY = ["doc_id", "host", "text_hash"]


def _host(host: str) -> Column:
    """The host of a document; a null one has a name of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keyed(docs: DataFrame, host: str) -> DataFrame:
    return docs.withColumn("text_hash", _text_hash()).withColumn("host", _host(host))


def line_rows(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, host, text_hash, line_hash, line_words): the distinct lines
    with a word of each document, and how many words each line's copies have
    together."""
    lines = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    return (keyed(docs, host).select(*KEY, lines.alias("line")).where(F.btrim("line", F.lit(SPACES)) != "")
            .withColumn("line", normal_line(F.col("line")))
            .select(*KEY, F.xxhash64("line").alias("line_hash"),
                    (F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1).alias("line_words")))


def boilerplate(docs: DataFrame, host: str) -> DataFrame:
    """(host, line_hash) of the lines above their host's limit."""
    seen = line_rows(docs, host).groupBy("host", "line_hash", "text_hash").agg(F.lit(1))
    return seen.groupBy("host", "line_hash").agg(F.count("*").alias("n")).where(
        F.col("n") > LINE_DOCUMENTS).select("host", "line_hash")


def depleted(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, host, text_hash, lost_words, lost_lines): what documents
    with boilerplate lines lose."""
    found = line_rows(docs, host).join(boilerplate(docs, host), ["host", "line_hash"])
    # a repeated row has the same lines once more, which its copies share
    rows = keyed(docs, host).groupBy(*KEY).agg(F.count("*").alias("rows")).where("rows > 1")
    lost = found.groupBy(*KEY).agg(F.sum("line_words").alias("words"),
                                   F.collect_set("line_hash").alias("lost_lines"))
    same = [lost[k].eqNullSafe(rows[k]) for k in KEY]
    return lost.join(rows, same, "left").select(
        *[lost[k] for k in KEY],
        (F.col("words") / F.coalesce("rows", F.lit(1))).cast("long").alias("lost_words"), "lost_lines")


def verdicts(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, text_hash, the base columns, lost_lines, kept) of
    every document, without its text."""
    # written down: a filter on a verdict would otherwise be pushed below the
    # projections and evaluate their arrays again for every element
    base = materialize(base_rules(keyed(docs.select("doc_id", "text", host), host)).select(
        *KEY, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), "base-rules")
    lost = depleted(docs.select("doc_id", "text", host), host)
    same = [base[k].eqNullSafe(lost[k]) for k in KEY]
    left = F.col("n_words") - F.coalesce("lost_words", F.lit(0))
    return base.join(lost, same, "left").select(
        *[base[k] for k in KEY], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "lost_lines",
        (~F.col("base_failed") & (F.col("lost_lines").isNull() | (
            (left >= LEAST_WORDS) & (left >= LEFT_SHARE * F.col("n_words"))))).alias("kept"))


def cleaned(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents kept, without their boilerplate lines."""
    found = verdicts(docs, host).where("kept").select(
        *[F.col(k).alias("_" + k) for k in KEY], F.col("lost_lines").alias("_lost")).distinct()
    rows = docs.withColumn("_of_host", _host(host)).withColumn("_of_text", _text_hash())
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id"))
                       & (F.col("_of_host") == F.col("_host"))
                       & (F.col("_of_text") == F.col("_text_hash")))
    lines = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(
        F.col("_lost"), F.xxhash64(normal_line(x))))
    return joined.withColumn("text", F.when(F.col("_lost").isNull(), F.col("text")).otherwise(
        F.array_join(lines, "\n"))).select(*docs.columns)


def digests(docs: DataFrame, host: str = "source") -> DataFrame:
    return verdicts(docs, host).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
