"""Text work over Arrow batches, where Java's regular expressions and lambdas
take most of the time of a job.

Each function is a Column -> Column one like those of ``text`` and gives the
rows that the JVM expressions give; it runs where the rows are, a batch at a
time, with no shuffle.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the UDFs carry this module's functions along, so that workers need no package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Java's \s without flags
SPACES = " \t\n\x0b\f\r"
# the rows of one step, so that what a batch makes stays small
STEP = 512
# letters to transliterate that are replaced one after the other
MANY = 64
# tokens that are counted together
COUNTED = 1 << 20
# normal forms of words beyond ASCII that a batch remembers, emptied when full
NORMAL = 1 << 17
# texts whose tokens are scored together
SCORED = 4096

# Patterns that RE2 and Java read alike over ASCII texts
_ALIKE = re.compile(r"(?:[A-Za-z0-9 _,'-]|\\[bsw.]|\(\?:|[()|+*?\[\]])*")
_POSSESSIVE = re.compile(r"[*+?]\+")


def _by_row(f, v: pa.Array, kind: pa.DataType) -> pa.Array:
    """``f`` of each string of ``v``, null as ''."""
    parts = [pa.array([f(x or "") for x in v[i:i + STEP].to_pylist()], kind) for i in range(0, len(v), STEP)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def cleaner(letters: dict[int, str | None]):
    """T1 as a UDF: ``letters`` maps code points to their transliteration (None:
    dropped); then URLs, mentions, hashtags, all but letters, digits and
    spaces, and repeated spaces go."""
    url, mention, hashtag = (re.compile(p) for p in (f"http[^{SPACES}]+", "@[A-Za-z0-9_]+", "#[A-Za-z0-9_]+"))
    kept = set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + SPACES.encode())
    dropped = bytes(c for c in range(256) if c not in kept)
    spaced = bytes.maketrans(SPACES.encode(), b" " * len(SPACES))

    def clean(s: str) -> str:
        if not s.isascii():
            met = letters.keys() & set(map(ord, set(s)))
            if len(met) > MANY:
                s = s.translate(letters)
            else:           # no replacement is replaced again: they are of ASCII
                for c in met:
                    s = s.replace(chr(c), letters[c] or "")
        if "http" in s:
            s = url.sub("", s)
        if "@" in s:
            s = mention.sub("", s)
        if "#" in s:
            s = hashtag.sub("", s)
        b = s.encode("ascii", "ignore").translate(spaced, dropped).strip(b" ")
        while b"  " in b:
            b = b.replace(b"  ", b" ")
        return b.decode("ascii")

    @F.arrow_udf("string")
    def cleaned(v: pa.Array) -> pa.Array:
        return _by_row(clean, v, pa.string())
    return cleaned


def counted_alike(pattern: str) -> bool:
    """Whether RE2 counts the matches of a pattern as Java does, over ASCII
    texts without vertical tabs."""
    return _ALIKE.fullmatch(pattern) is not None and _POSSESSIVE.search(pattern) is None


def pattern_counts(text: Column, patterns: list[str]) -> list[Column]:
    """The matches of each pattern, upper and lower case alike, in a text that
    is not null.  Patterns or texts that RE2 might read otherwise are counted
    by the JVM."""
    alike = [p for p in patterns if counted_alike(p)]

    @F.arrow_udf("array<int>")
    def counts(v: pa.Array) -> pa.Array:
        found = [pc.fill_null(pc.count_substring_regex(v, "(?i)" + p), 0).cast(pa.int32()).to_numpy() for p in alike]
        flat = np.stack(found, axis=1).ravel()
        return pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * len(alike), flat)
    plain = (F.octet_length(text) == F.length(text)) & ~F.contains(text, F.lit("\x0b"))
    met = counts(F.when(plain, text)) if alike else None
    out = []
    for p in patterns:
        jvm = F.regexp_count(text, F.lit("(?i)" + p))
        out.append(F.when(plain, F.get(met, alike.index(p))).otherwise(jvm) if p in alike else jvm)
    return out


# Classes of bytes of which four make a number below 2 ** 20: letters have one each
_CLASS = bytes((c & 31) if 97 <= c <= 122 else 27 + (c >> 6) if c > 32 else 0 for c in range(256))


def _fours(b: bytes) -> np.ndarray:
    """The numbers of all runs of four bytes."""
    c = np.frombuffer(b.translate(_CLASS), np.uint8).astype(np.int32)
    two = c[:-1] << 5 | c[1:]
    return two[:-2] << 10 | two[2:]


def keyword_hits(text: Column, lexicon: list[list[str]]) -> Column:
    """array<int>: of each list the keywords that the text has, as substrings.
    Those of four bytes and more are sought only where the text has all their
    runs of four."""
    lists = [list(words) for words in lexicon]
    sought = [(w, i) for i, words in enumerate(lists) for w in words]
    short = [(w, i) for w, i in sought if len(w.encode()) < 4]
    long = [(w, i) for w, i in sought if len(w.encode()) >= 4]
    runs = [_fours(w.encode()) for w, _ in long]
    flat = np.concatenate(runs) if runs else np.zeros(0, np.int32)
    starts = np.cumsum([0, *map(len, runs)])[:-1]

    @F.arrow_udf("array<int>")
    def hits(v: pa.Array) -> pa.Array:
        has = np.zeros(1 << 20, bool)

        def of(s: str) -> list[int]:
            out = [0] * len(lists)
            for w, i in short:
                out[i] += w in s
            b = s.encode()
            if runs and len(b) >= 4:
                fours = _fours(b)
                has[fours] = True
                for j in np.flatnonzero(np.logical_and.reduceat(has[flat], starts)):
                    w, i = long[j]
                    out[i] += w in s
                has[fours] = False
            return out
        return _by_row(of, v, pa.list_(pa.int32()))
    return hits(text)


_WHITE = "\t\n\x0b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def word_count(text: Column) -> Column:
    """The words between Unicode white space."""
    word, other = re.compile(f"[^{_WHITE}]+"), re.compile("[\x1c-\x1f]")   # those split() also takes as spaces

    def count(s: str) -> int:
        if s.isascii() and s.isprintable() and "  " not in s:       # words between single spaces
            s = s.strip(" ")
            return s.count(" ") + 1 if s else 0
        return len(word.findall(s)) if other.search(s) else len(s.split())

    @F.arrow_udf("bigint")
    def words(v: pa.Array) -> pa.Array:
        return _by_row(count, v, pa.int64())
    return words(text)


_LETTERS = bytes(c | 32 if 65 <= c & 223 <= 90 and c < 128 else c if c == 45 else 32 for c in range(256))


def _token_lists(v: pa.Array, stop: pa.Array) -> pa.ListArray:
    """T13's words: runs of ASCII letters and hyphens from a letter on, of three
    characters at least, in lower case; all other bytes part them."""
    plain = [x.encode().translate(_LETTERS) if x else b"" for x in v.to_pylist()]
    lists = pc.split_pattern(pa.array(plain, pa.binary()).view(pa.string()), " ")
    words, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy())
    if any(b"-" in b for b in plain):
        words = pc.ascii_ltrim(words, "-")
    kept = pc.and_(pc.greater(pc.binary_length(words), 2), pc.invert(pc.is_in(words, value_set=stop)))
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(before[np.concatenate([[0], ends])].astype(np.int32), words.filter(kept))


def tokens(text: Column, stopwords) -> Column:
    """Lower-cased ASCII words but the stop words."""
    stop = list(stopwords)

    @F.arrow_udf("array<string>")
    def toks(v: pa.Array) -> pa.Array:
        known = pa.array(stop, pa.string())
        parts = [_token_lists(v[i:i + STEP], known) for i in range(0, len(v), STEP)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))
    return toks(text)


def top_tokens(text: Column, stopwords, k: int) -> Column:
    """The ``k`` most frequent ``tokens``, ties by first appearance."""
    stop = list(stopwords)

    @F.arrow_udf("array<string>")
    def top(v: pa.Array) -> pa.Array:
        known, out = pa.array(stop, pa.string()), []
        for i in range(0, len(v), STEP):
            lists = _token_lists(v[i:i + STEP], known)
            words, at = lists.flatten().to_numpy(zero_copy_only=False).tolist(), lists.offsets.to_pylist()
            out.append(pa.array([[w for w, _ in Counter(words[a:b]).most_common(k)] for a, b in zip(at, at[1:])],
                                pa.list_(pa.string())))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.string()))
    return top(text)


def term_counts(df: DataFrame, y: str, toks: str) -> DataFrame:
    """(y, term, n): the tokens of each class ``y``, counted in each task by
    ``COUNTED`` of them or a batch, to be summed up.  Null tokens don't count."""
    def counted(parts: list[pa.Table]) -> pa.RecordBatch:
        n = pa.concat_tables(parts).group_by(["y", "term"], use_threads=False).aggregate([([], "count_all")])
        n = n.select(["y", "term", "count_all"]).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in n.columns], names=["y", "term", "n"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            lists = b.column("toks")
            t = pa.table({"y": b.column("y").take(pc.list_parent_indices(lists)), "term": pc.list_flatten(lists)})
            t = t.filter(pc.is_valid(t["term"]))
            held.append(t)
            size += len(t)
            if size >= COUNTED:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)
    return df.select(F.col(y).cast("int").alias("y"), F.col(toks).alias("toks")).mapInArrow(run, "y int, term string, n bigint")


def weight_sums(toks: Column, held, k: int, rest: bool) -> Column:
    """struct(sums array<double>, rest array<string>): the sums of the tokens'
    ``k`` weights by the broadcast ``held`` (the terms, a row of weights per term
    and a last one of zeros), and the tokens that are none of the terms (where
    asked for)."""
    kind = pa.struct([("sums", pa.list_(pa.float64())), ("rest", pa.list_(pa.string()))])

    def step(v: pa.Array) -> pa.Array:
        terms, weights = held.value
        flat, sizes = v.flatten(), pc.fill_null(pc.list_value_length(v), 0).to_numpy()
        at = pc.fill_null(pc.index_in(flat, value_set=terms, skip_nulls=True), len(terms)).to_numpy()
        ends = np.cumsum(sizes)
        # one row of zeros more, so that every text begins somewhere
        sums = np.add.reduceat(np.concatenate([weights[at], np.zeros((1, k))]), ends - sizes, axis=0)
        sums[sizes == 0] = 0.0
        lists = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * k, sums.ravel())
        if rest:
            unknown = (at == len(terms)) & ~pc.is_null(flat).to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(unknown)])
            more = pa.ListArray.from_arrays(before[np.concatenate([[0], ends])].astype(np.int32),
                                            flat.filter(pa.array(unknown)))
        else:
            more = pa.nulls(len(v), pa.list_(pa.string()))
        return pa.StructArray.from_arrays([lists, more], fields=list(kind))

    @F.arrow_udf("struct<sums:array<double>,rest:array<string>>")
    def sums(v: pa.Array) -> pa.Array:
        # the terms are hashed once a step
        parts = [step(v.slice(i, SCORED)) for i in range(0, len(v), SCORED)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)
    return sums(toks)


def _inner(w: str) -> tuple[int, int]:
    """Where a word's first letter or digit is and where its last one ends."""
    a, b = 0, len(w)
    if w.isascii() and w and w[0].isalnum() and w[-1].isalnum():
        return a, b
    while a < b and unicodedata.category(w[a])[0] not in "LN":
        a += 1
    while b > a and unicodedata.category(w[b - 1])[0] not in "LN":
        b -= 1
    return a, b


GRAM = pa.struct([("i", pa.int32()), ("n", pa.int32()), ("gram", pa.string()), ("start", pa.int32()),
                  ("entity", pa.string())])


def grams_at(text: Column, index) -> Column:
    """The n-grams, in normal form, with the place of the first letter and the
    surface form.  The broadcast ``index`` is a map of the words that they start
    with (word, most words) and the set of those wanted, or None for all."""
    word, other = re.compile(f"[^{SPACES}]+"), re.compile("[\x1c-\x1f]")   # those split() also takes as spaces
    edges = "".join(c for c in map(chr, range(128)) if not c.isalnum())

    def form_of(w: str, normal: dict[str, str]) -> str:
        a, b = _inner(w)
        normal[w] = w[a:b].lower()
        return normal[w]

    def grams(s: str, longest: dict[str, int], wanted: frozenset[str] | None, normal: dict[str, str]) -> list[dict]:
        words = s.split() if s.isascii() and not other.search(s) else word.findall(s)
        forms = [w.lower().strip(edges) if w.isascii() else normal.get(w) or form_of(w, normal) for w in words]
        out, starts = [], None
        for i in [i for i, w in enumerate(forms) if w in longest]:
            gram = ""
            for n, form in enumerate(forms[i:i + longest[forms[i]]], 1):
                if not form:
                    break
                gram = f"{gram} {form}" if gram else form
                if wanted is None or gram in wanted:
                    if starts is None:
                        starts = [m.start() for m in word.finditer(s)]
                    start, end = starts[i] + _inner(words[i])[0], starts[i + n - 1] + _inner(words[i + n - 1])[1]
                    out.append({"i": i, "n": n, "gram": gram, "start": start, "entity": s[start:end]})
        return out

    @F.arrow_udf("array<struct<i:int,n:int,gram:string,start:int,entity:string>>")
    def found(v: pa.Array) -> pa.Array:
        longest, wanted = index.value
        normal: dict[str, str] = {}

        def of(s: str) -> list[dict]:
            if len(normal) > NORMAL:
                normal.clear()
            return grams(s, longest, wanted, normal)
        return _by_row(of, v, pa.list_(GRAM))
    return found(text)


def replaced_words(text: Column, lemmas) -> Column:
    """The words of a text by the broadcast map ``lemmas`` (others as they
    are), with single spaces."""
    find = re.compile(f"[^{SPACES}]+").findall

    @F.arrow_udf("string")
    def replaced(v: pa.Array) -> pa.Array:
        known = lemmas.value
        return _by_row(lambda s: " ".join([known.get(w, w) for w in find(s)]), v, pa.string())
    return replaced(text)


def trigram_sums(lowered: Column, model) -> Column:
    """array<long>: over the trigrams of a padded text, with single spaces, the
    sums of the weights of the broadcast ``model``: the trigrams' places, and a
    row of weights per place; the last row is that of all other trigrams."""
    space = re.compile(f"[{SPACES}]+")

    @F.arrow_udf("array<bigint>")
    def sums(v: pa.Array) -> pa.Array:
        places, weights = model.value
        other = len(weights) - 1

        def of(s: str) -> list[int]:
            s = f" {space.sub(' ', s)} "
            met = Counter(zip(s, s[1:], s[2:]))
            at = [places.get("".join(g), other) for g in met]
            return (np.array(list(met.values()), np.int64) @ weights[at]).tolist()
        return _by_row(of, v, pa.list_(pa.int64()))
    return sums(lowered)


def replaced_matches(text: Column, pattern: str, names: Callable[[str], str]) -> Column:
    """Every match of a pattern by ``names`` of it; null stays null, and texts of
    ASCII alone, which the pattern doesn't match, stay as they are."""
    find = re.compile(pattern)

    @F.arrow_udf("string")
    def replaced(v: pa.Array) -> pa.Array:
        known: dict[str, str] = {}

        def name(m):
            found = m.group()
            if found not in known:
                known[found] = names(found)
            return known[found]
        done = _by_row(lambda s: s if s.isascii() else find.sub(name, s), v, pa.string())
        return pc.if_else(pc.is_valid(v), done, pa.scalar(None, pa.string()))
    return replaced(text)
