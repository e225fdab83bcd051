"""Behaviour scoring and boolean flags.

One projection per row: each category's score is ``greatest`` over its
patterns of the matches in the lower-cased text, counted a batch at a time, so
the job is a single map-only stage with no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow as AR
from ..functions import text as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results:
# categories in declared order, their regular expressions and thresholds.
# ---------------------------------------------------------------------------
FLAG_PATTERNS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("toxicity", (
        r"\b(?:idiot|stupid|dumbass|retard|fuck|shit|bitch|asshole|dick|pussy|cunt|whore|slut|fag|nigg|chink|spic|kike|retard|moron)\b",
        r"\b(?:kill|die|hurt|harm|attack|beat|punch|hit|fight|war|murder|suicide)\s+(?:yourself|urself|u|myself|me|them|him|her|everyone|everybody)\b",
    )),
    ("spam", (
        r"\b(?:free|win|won|prize|trial|congrat|selected|winner|claim|reward|offer|discount|sale|limited|time|click|link|http|www\.|bit\.ly|goo\.gl|tinyurl)\b",
        r"\b(?:follow me|followers|retweet|rt|like|subscribe|share|comment|tag|dm|direct message|whatsapp|telegram|signal)\b",
    )),
    ("threats", (
        r"\b(?:kill|harm|hurt|attack|beat|punch|hit|fight|war|murder|suicide|bomb|shoot|stab|rape|torture|destroy|ruin|wreck|burn|bomb)\b",
        r"\b(?:i\s*(?:will|am going to|gonna|imma|im a|wanna|want to))\s+(?:kill|harm|hurt|attack|beat|punch|hit|fight|murder|bomb|shoot|stab|rape|torture|destroy|ruin|wreck|burn|bomb)\b",
    )),
    ("harassment", (
        r"\b(?:ugly|fat|stupid|idiot|retard|moron|loser|weirdo|freak|creep|pervert|stalker|harass|harassment|bully|bullying|hate|hater|hateful|racist|sexist|homophobic|transphobic|xenophobic|bigot|bigotry|discriminate|discrimination)\b",
    )),
    ("misinformation", (
        r"\b(?:fake news|hoax|conspiracy|cover[ -]up|false flag|deep state|government\s+lies|media\s+lies|mainstream\s+media\s+lies|fact[ -]check|fact[ -]checked|fact[ -]checking|fact[ -]checker|fact[ -]checkers|fact[ -]checking|fact[ -]checks|fact[ -]checked|fact[ -]checking|fact[ -]checker|fact[ -]checkers|fact[ -]checking|fact[ -]checks)\b",
    )),
    ("bot_like", (
        r"\b(?:follow me|followers|retweet|rt|like|subscribe|share|comment|tag|dm|direct message|whatsapp|telegram|signal|join now|click here|link in bio|check out|promote|promotion|sponsored|advertisement|ad|ads|advert|adverts|advertising|marketing|seo|traffic|leads|sales|conversion|conversions|converting|converted|converts|convert|converter|converters)\b",
    )),
)
THRESHOLDS: dict[str, float] = {
    "toxicity": 0.2, "spam": 0.2, "threats": 0.3,
    "harassment": 0.2, "misinformation": 0.3, "bot_like": 0.3,
}
# Score rule: base 0.3 + 0.2 per match (max 0.9), +0.2 (max 1.0) below 10 words.
BASE, STEP, CAP, SHORT_BONUS, SHORT_WORDS, DISCUSSION_WORDS = 0.3, 0.2, 0.9, 0.2, 10, 50
# Flag categories feeding each boolean
SPAM_FROM = ("spam", "bot_like")
OFFENSIVE_FROM = ("toxicity", "harassment", "threats")
# ---------------------------------------------------------------------------


def category_scores(text: Column, patterns=FLAG_PATTERNS, thresholds=THRESHOLDS,
                    words: Column | None = None) -> list[tuple[str, Column]]:
    """Per-category score column (null when no match or below threshold).
    ``text`` should be an attribute (it is referenced once per pattern)."""
    lc = F.lower(F.coalesce(text, F.lit("")))
    wc = words if words is not None else T.word_count(lc)
    out = []
    found = iter(AR.pattern_counts(lc, [p for _, pats in patterns for p in pats]))
    for cat, pats in patterns:
        counts = [next(found) for _ in pats]
        m = counts[0] if len(counts) == 1 else F.greatest(*counts)
        s = F.least(F.lit(CAP), F.lit(BASE) + m * F.lit(STEP))
        s = F.when(wc < SHORT_WORDS, F.least(F.lit(1.0), s + F.lit(SHORT_BONUS))).otherwise(s)
        s = F.round(s, 2)
        out.append((cat, F.when((m > 0) & (s >= F.lit(thresholds.get(cat, 0.5))), s)))
    return out


def detected_map(scores: list[tuple[str, Column]]) -> Column:
    """``map<string,double>`` of the kept categories, in declared order."""
    m = F.map_from_arrays(F.array(*[F.lit(c) for c, _ in scores]),
                          F.array(*[s.cast("double") for _, s in scores]))
    return F.map_filter(m, lambda k, v: v.isNotNull())


def behaviour_flags(df: DataFrame, text: Column | None = None, key: str = "post_id",
                    patterns=FLAG_PATTERNS, thresholds=THRESHOLDS) -> DataFrame:
    """C4: flags struct + ``detected_flags`` map.  Text defaults to the P5
    chain ``cleaned_text`` -> ``translated_text`` -> ''.  Blank text gives
    all-false flags and a null map."""
    if text is None:
        text = F.coalesce(F.when(F.col("cleaned_text") != "", F.col("cleaned_text")),
                          F.when(F.col("translated_text") != "", F.col("translated_text")),
                          F.lit(""))
    keep = [c for c in ("_id", key, "subreddit", "author", "created_utc", "permalink", "title")
            if c in df.columns]
    base = df.select(*keep, text.alias("__t"))
    base = base.withColumn("__wc", T.word_count(F.col("__t"))) \
               .withColumn("__lc", F.lower(F.col("__t")))
    scores = category_scores(F.col("__lc"), patterns, thresholds, words=F.col("__wc"))
    for cat, s in scores:
        base = base.withColumn(f"__s_{cat}", s)
    blank = T.strip_ws(F.col("__t")) == ""

    def has(cats):
        return reduce(lambda a, b: a | b, [F.col(f"__s_{c}").isNotNull() for c in cats], F.lit(False))

    cats = [c for c, _ in patterns]
    flags = F.struct(
        (~blank & has([c for c in SPAM_FROM if c in cats])).alias("spam"),
        (~blank & has([c for c in OFFENSIVE_FROM if c in cats])).alias("offensive"),
        (~blank & has([c for c in SPAM_FROM if c in cats])).alias("promotional"),
        (~blank & F.contains(F.col("__t"), F.lit("?"))).alias("question"),
        (~blank & (F.col("__wc") > DISCUSSION_WORDS)).alias("discussion"),
    )
    det = F.when(~blank, detected_map([(c, F.col(f"__s_{c}")) for c in cats]))
    return base.select(*keep, flags.alias("flags"), det.alias("detected_flags"))
