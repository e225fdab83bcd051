"""DuckDB SQL counterparts of the Column functions, used only to build the
oracle queries of ``__spark_entry__.oracle_sql()``.

Each helper takes a SQL expression string and returns one.  They restate
the same semantics in DuckDB's dialect (RE2 has no look-behind and an
ASCII ``\\w``, so a few patterns are spelled differently).
"""

from __future__ import annotations

from ..functions import text as T


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def transliterate(x: str) -> str:
    out = f"translate({x}, {q(T.UNICODE_SPACES)}, {q(' ' * len(T.UNICODE_SPACES))})"
    for a, b in T.TRANSLIT_MULTI:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return f"strip_accents({out})"


def clean_text(x: str) -> str:
    s = f"regexp_replace(coalesce({x}, ''), {q(T.EMOJI_CLASS)}, '', 'g')"
    s = transliterate(s)
    s = f"regexp_replace({s}, 'http\\S+', '', 'g')"
    s = f"regexp_replace({s}, '@\\w+', '', 'g')"
    s = f"regexp_replace({s}, '#\\w+', '', 'g')"
    s = f"regexp_replace({s}, '[^A-Za-z0-9\\s]+', '', 'g')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


def build_content(title: str, body: str) -> str:
    return strip_ws(f"coalesce({title}, '') || CASE WHEN coalesce({body}, '') <> '' "
                    f"THEN chr(10) || chr(10) || {body} ELSE '' END")


HASHTAG_A_SQL = "(?:^|[^\\p{L}\\p{N}_])#\\s*([A-Za-z0-9_][A-Za-z0-9_-]*)"
HASHTAG_B_SQL = "#([\\p{L}\\p{N}_]+)"


def hashtags_a(x: str) -> str:
    return (f"list_sort(list_distinct(list_transform(regexp_extract_all(coalesce({x}, ''), "
            f"{q(HASHTAG_A_SQL)}, 1), lambda t: '#' || lower(t))))")


def hashtags_b(x: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({x}, ''), {q(HASHTAG_B_SQL)}, 1), lambda t: lower(t))"


def mentions_a(x: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({x}, ''), {q(T.MENTION_A_PATTERN)}), lambda t: lower(t))"


def mentions_b(x: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({x}, ''), {q(T.MENTION_B_PATTERN)}, 1), lambda t: lower(t))"


def stop_list() -> str:
    return "[" + ", ".join(q(w) for w in sorted(set(T.STOPWORDS))) + "]"


def tokens(x: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all(coalesce({x}, ''), {q(T.TOKEN_PATTERN)}), "
            f"lambda t: lower(t)), lambda t: NOT list_contains({stop_list()}, t))")


def word_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({x}, ''), '\\S+')) AS BIGINT)"


def null_if_empty(x: str) -> str:
    return f"CASE WHEN len({x}) > 0 THEN {x} END"
