"""Column -> Column text functions.

Compositions of built-in expressions, and for cleaning and tokens the batch
functions of ``arrow``: all run where the rows are, with no shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import arrow as AR

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Hashtag model A: '#tag' or '#   tag', letters/digits/underscore then also '-'
HASHTAG_A_PATTERN = r"(?U)(?<!\w)#\s*([A-Za-z0-9_][A-Za-z0-9_-]*)"
# Hashtag model B: '#' followed by word characters
HASHTAG_B_PATTERN = r"(?U)#(\w+)"
# Mentions: model A keeps the '@', model B keeps only the name
MENTION_A_PATTERN = r"@[A-Za-z0-9_]+"
MENTION_B_PATTERN = r"@([a-zA-Z0-9_]+)"
# Keyword tokens: a letter then at least two letters or hyphens
TOKEN_PATTERN = r"[A-Za-z][A-Za-z\-]{2,}"
# Stop words of the keyword extractor
STOPWORDS = (
    "the", "and", "for", "that", "with", "this", "from", "have", "you", "your", "are", "was",
    "were", "will", "they", "them", "their", "our", "ours", "has", "had", "but", "not", "all",
    "any", "can", "could", "should", "would", "there", "here", "what", "when", "where", "who",
    "whom", "why", "how", "a", "an", "in", "on", "of", "to", "as", "by", "it", "its", "is",
    "be", "or", "at", "we", "me", "my", "he", "she", "his", "her", "if", "about", "into",
    "over", "under", "no", "yes", "do", "did", "done", "just", "than", "then", "too", "very",
)
# Stored snippets: of a text, of a link
SNIPPET_CHARS = 500
LINK_SNIPPET_CHARS = 200
# Letters with no canonical decomposition, and one-to-many transliterations
TRANSLIT_MULTI = (
    ("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"),
    ("ø", "o"), ("Ø", "O"), ("đ", "d"), ("Đ", "D"), ("ł", "l"), ("Ł", "L"),
    ("þ", "th"), ("Þ", "Th"), ("ð", "d"), ("Ð", "D"), ("ı", "i"), ("ħ", "h"), ("Ħ", "H"),
)
# Emoji code-point ranges removed before cleaning
EMOJI_CLASS = (
    "[\\x{1F000}-\\x{1FAFF}\\x{2600}-\\x{27BF}\\x{2300}-\\x{23FF}\\x{2B00}-\\x{2BFF}"
    "\\x{1F1E6}-\\x{1F1FF}\\x{FE0E}\\x{FE0F}\\x{200D}\\x{20E3}\\x{3030}\\x{303D}"
    "\\x{3297}\\x{3299}\\x{E0020}-\\x{E007F}]"
)
# ---------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _translit_one_to_one() -> tuple[str, str]:
    """Latin letters (U+00C0..U+024F, U+1E00..U+1EFF) that decompose
    canonically to an ASCII base letter plus marks (rule: Unicode NFD, keep
    the base)."""
    src, dst = [], []
    multi = {a for a, _ in TRANSLIT_MULTI}
    for cp in list(range(0x00C0, 0x0250)) + list(range(0x1E00, 0x1F00)):
        ch = chr(cp)
        if ch in multi:
            continue
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


def remove_emoji(c: Column) -> Column:
    """Drop emoji code points (and joiners / variation selectors)."""
    return F.regexp_replace(c, EMOJI_CLASS, "")


# Unicode spaces, which become plain ones
UNICODE_SPACES = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def transliterate(c: Column) -> Column:
    """Latin-script transliteration to ASCII (accents, ß, æ, ...);
    Unicode spaces become plain ones."""
    src, dst = _translit_one_to_one()
    src, dst = src + UNICODE_SPACES, dst + " " * len(UNICODE_SPACES)
    out = F.translate(c, src, dst)
    for a, b in TRANSLIT_MULTI:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _letters() -> dict[int, str | None]:
    """Code point -> transliteration of T2 and T3 together."""
    src, dst = _translit_one_to_one()
    out = dict(zip(map(ord, src + UNICODE_SPACES), dst + " " * len(UNICODE_SPACES)))
    out |= {ord(a): b for a, b in TRANSLIT_MULTI}
    ranges = re.findall(r"\\x\{(\w+)\}(?:-\\x\{(\w+)\})?", EMOJI_CLASS)
    return out | {c: None for a, b in ranges for c in range(int(a, 16), int(b or a, 16) + 1)}


def clean_text(c: Column) -> Column:
    """Emoji, transliteration, URLs, mentions, hashtags, non-alphanumerics,
    whitespace collapse -- in this order.  Null -> ''."""
    return AR.cleaner(_letters())(c)


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: all leading/trailing whitespace.  Texts that
    neither begin nor end with any are not read character by character."""
    white = F.lit("\t\n\x0b\f\r " + UNICODE_SPACES)
    edge = F.contains(white, F.substring(c, 1, 1)) | F.contains(white, F.substring(c, -1, 1))
    return F.when(edge, F.btrim(c, white)).otherwise(c)


def nonblank(c: Column) -> Column:
    """``c`` when it has a non-whitespace character, else null."""
    return F.when(F.coalesce(strip_ws(c), F.lit("")) != "", c)


def build_content(title: Column, body: Column) -> Column:
    """``title + '\\n\\n' + body`` (body only when non-empty), stripped."""
    t = F.coalesce(title, F.lit(""))
    b = F.coalesce(body, F.lit(""))
    return strip_ws(F.concat(t, F.when(b != "", F.concat(F.lit("\n\n"), b)).otherwise(F.lit(""))))


def build_text(content: Column, title: Column, body: Column) -> Column:
    """Stripped ``content`` when non-blank, else P1."""
    c = strip_ws(F.coalesce(content, F.lit("")))
    return F.when(c != "", c).otherwise(build_content(title, body))


def join_parts(*parts: Column) -> Column:
    """Space-join of the non-empty parts ('' when all are empty)."""
    return F.concat_ws(" ", *[F.when(p != "", p) for p in parts])


def pick_text(chain: list[Column], title: Column, body: Column,
              content: Column) -> Column:
    """First non-empty column of ``chain``, else title joined with
    body (or content when body is empty), stripped."""
    fallback = strip_ws(F.concat_ws(" ", F.coalesce(title, F.lit("")),
                                    F.when(F.coalesce(body, F.lit("")) != "", body)
                                    .otherwise(F.when(F.coalesce(content, F.lit("")) != "", content))))
    return F.coalesce(*[F.when(c != "", c) for c in chain], fallback)


def _extract_all(c: Column, mark: str, pattern: str, group: int) -> Column:
    """All matches of a pattern that begins with ``mark``; only texts that have
    the mark are searched."""
    found = F.regexp_extract_all(c, F.lit(pattern), group)
    return F.when(F.contains(c, F.lit(mark)), found).otherwise(F.array().cast("array<string>"))


def hashtags_a(c: Column) -> Column:
    """Distinct '#'+lower(tag), as a sorted array (a set has no order)."""
    tags = _extract_all(c, "#", HASHTAG_A_PATTERN, 1)
    return F.array_sort(F.array_distinct(F.transform(tags, lambda x: F.concat(F.lit("#"), F.lower(x)))))


def hashtags_b(c: Column) -> Column:
    """lower(tag) without '#', duplicates kept, in text order."""
    tags = _extract_all(c, "#", HASHTAG_B_PATTERN, 1)
    return F.transform(tags, lambda x: F.lower(x))


def mentions_a(c: Column) -> Column:
    """T10: '@name' lower-cased, duplicates kept, in text order."""
    return F.transform(_extract_all(c, "@", MENTION_A_PATTERN, 0),
                       lambda x: F.lower(x))


def mentions_b(c: Column) -> Column:
    """T11: 'name' lower-cased, without '@'."""
    return F.transform(_extract_all(c, "@", MENTION_B_PATTERN, 1),
                       lambda x: F.lower(x))


def tokens(c: Column, stopwords=STOPWORDS) -> Column:
    """Lower-cased keyword tokens, stop words removed, text order."""
    return AR.tokens(c, stopwords or ())


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words (Python ``len(s.split())``)."""
    return AR.word_count(c)


def has_words(c: Column, n: int) -> Column:
    """Whether there are at least ``n`` such words: reads no further."""
    return F.coalesce(c, F.lit("")).rlike(rf"(?U)^\s*+(?:\S++\s++){{{n - 1}}}\S")


def icontains(c: Column, q: str) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(q.lower()))


def snippet(c: Column, n: int = SNIPPET_CHARS) -> Column:
    """First ``n`` characters."""
    return F.substring(c, 1, n)


def strip_tags(c: Column) -> Column:
    """Remove HTML tags."""
    return F.regexp_replace(c, r"<[^>]+>", "")
