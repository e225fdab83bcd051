"""Statistical keyphrases.

The unsupervised method of Campos et al. (2020): a term's score comes from
its case, position, frequency, the variety of its neighbours and its spread
over sentences; a phrase's score from those of its terms.  Lower is better.

    case    = max(acronyms, capitalised inside a sentence) / (1 + ln TF)
    place   = ln(ln(3 + median sentence number))
    norm    = TF / (mean TF + standard deviation of TF)
    rel     = 1 + (distinct/all left neighbours + distinct/all right) * TF / max TF
    spread  = sentences with the term / sentences
    S(term) = rel * place / (case + norm / rel + spread / rel)
    S(phrase) = prod S / (TF(phrase) * (1 + sum S))

Sentences end at ``. ! ?`` and line ends, and phrases do not cross other
punctuation.  A phrase holds no stop word; words of fewer than three
characters and numbers count as stop words.  Library-exact scores are not
promised.

All of it depends on one text alone and runs where the row is, over Arrow
batches, with no shuffle: the words of some hundred texts become arrays of
numbers, whose groups are terms and phrases.  What letters, capitals and lower
case are is settled by the JVM.
"""

from __future__ import annotations

import sys
from decimal import ROUND_HALF_UP, Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# the UDF carries this module's functions along, so that workers need no package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the reference: longest phrase, similarity that makes two
# phrases duplicates, candidates, phrases kept.
MAX_WORDS = 3
DEDUP_LIMIT = 0.9
CANDIDATES = 20
KEPT = 15

SENTENCE_ENDS = ".!?"           # and line ends
PHRASE_BREAK = r"[^\p{L}\p{N}\s'’-]+"
INNER = "'’-"                   # in words, but not at their start
MIN_TERM_CHARS = 3
DECIMALS = 9                    # scores equal up to here tie

# texts, or bytes of them, that are worked on together
STEP = 512
STEP_BYTES = 1 << 20

# ASCII in phrases as it is, spaces as blanks, sentence ends as line ends and
# all other signs as commas; letters beyond ASCII stay
_SIGNS = bytes(c if c > 127 or chr(c).isalnum() or c in b"'-" else 32 if c in b" \t\x0b\f\r" else
               10 if c in b"\n.!?" else 44 for c in range(256))


class Tokens(NamedTuple):
    """The words of some texts in order.  ``text``, ``chunk`` (the run of words
    that no sign parts), ``code`` (a place in ``names``), ``term`` (numbers a
    word of one text) and ``score`` (nan for stop words) have a value a word."""
    text: np.ndarray
    chunk: np.ndarray
    code: np.ndarray
    names: list[str]
    term: np.ndarray
    score: np.ndarray


class Phrases(NamedTuple):
    """The distinct phrases of some texts: text, words, first place, score."""
    text: np.ndarray
    n: np.ndarray
    pos: np.ndarray
    score: np.ndarray


def signs_parted(text: Column) -> Column:
    """A text, null as '', in which every character beyond ASCII belongs to a
    word; in texts with such characters the signs are replaced, too."""
    valid = F.make_valid_utf8(F.coalesce(text, F.lit("")))
    ended = valid
    for mark in SENTENCE_ENDS:
        ended = F.replace(ended, F.lit(mark), F.lit("\n"))
    return F.when(F.octet_length(valid) == F.length(valid), valid).otherwise(F.regexp_replace(ended, PHRASE_BREAK, ","))


def _parts(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of texts and the signs between them, ',' or a line end, which
    ends every text; and the texts' numbers.  Some parts are empty."""
    plain = [(s.encode().translate(_SIGNS) + b"\n").replace(b"\n", b" \n ").replace(b",", b" , ") for s in texts.to_pylist()]
    lists = pc.split_pattern(pa.array(plain, pa.binary()).view(pa.string()), " ")
    return np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy()), pc.utf8_ltrim(lists.flatten(), INNER)


def _bools(v: pa.Array) -> np.ndarray:
    return v.to_numpy(zero_copy_only=False)


def _opens(keys: np.ndarray) -> np.ndarray:
    """Whether a key differs from the one before."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return new


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of keys, by group and in order; where each group starts
    there; the group of each key."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits < 64:       # key and place in one number sort faster
        both = np.sort(keys << bits | np.arange(len(keys)))
        order, new = both & (1 << bits) - 1, _opens(both >> bits)
    else:
        order = np.argsort(keys, kind="stable")
        new = _opens(keys[order])
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), group


def scored_tokens(text: pa.Array, lower: pa.Array, upper: pa.Array, stopwords: pa.Array) -> Tokens:
    """The words of texts (and of the same in lower and upper case) with the
    scores of their terms."""
    number, part = _parts(text)
    end = _bools(pc.equal(part, "\n"))
    mark = end | _bools(pc.equal(part, ","))
    at = np.flatnonzero(~mark & (pc.binary_length(part).to_numpy() > 0))
    word, low, up = (p.take(pa.array(at)) for p in (part, _parts(lower)[1], _parts(upper)[1]))     # the signs have no case
    number, raw, chunk = number[at], np.cumsum(end)[at], np.cumsum(mark)[at]

    opens, first = _opens(number), _opens(raw)
    doc, sentence = np.cumsum(opens) - 1, np.cumsum(first)
    sentence = sentence - sentence[opens][doc]
    known = low.dictionary_encode()
    code, names = known.indices.to_numpy().astype(np.int64), known.dictionary
    stop = _bools(pc.or_(pc.or_(pc.is_in(names, value_set=stopwords), pc.less(pc.utf8_length(names), MIN_TERM_CHARS)),
                         pc.match_substring_regex(names, "^[0-9'’-]+$")))
    acronym = _bools(pc.and_(pc.equal(up, word), pc.greater(pc.utf8_length(word), 1)))
    capital = _bools(pc.equal(pc.utf8_slice_codeunits(up, 0, 1), pc.utf8_slice_codeunits(word, 0, 1))) & ~acronym & ~first

    # one value a term of a text
    order, start, term = _groups(doc * len(names) + code)
    tf = np.diff(np.append(start, len(at)))
    s = sentence[order]
    middle = (s[start + (tf - 1) // 2] + s[start + tf // 2]) / 2
    apart = _opens(s)
    apart[start] = True
    spread, acronyms, capitals = (np.bincount(term[order], x, len(start)) for x in (apart, acronym[order], capital[order]))
    right = np.flatnonzero(chunk[1:] == chunk[:-1])

    def variety(places: np.ndarray, near: np.ndarray) -> np.ndarray:
        pairs = np.sort(term[places] * len(names) + code[near])
        distinct = np.bincount(pairs[_opens(pairs)] // len(names), minlength=len(start))
        return distinct / np.maximum(np.bincount(term[places], minlength=len(start)), 1)
    varieties = variety(right + 1, right) + variety(right, right + 1)

    live = np.flatnonzero(~stop[code[order[start]]])
    tf, of = tf[live], doc[order[start]][live]
    docs = int(opens.sum())
    terms, total, squares = (np.bincount(of, x, docs) for x in (np.ones(len(of)), tf, tf * tf))
    most = np.zeros(docs)
    most[of[_opens(of)]] = np.maximum.reduceat(tf, np.flatnonzero(_opens(of)))
    sentences = np.maximum.reduceat(sentence, np.flatnonzero(opens)) + 1
    terms = np.maximum(terms, 1)
    usual = total / terms + np.sqrt(np.maximum(terms * squares - total * total, 0)) / terms
    rel = 1 + varieties[live] * tf / most[of]
    case = np.maximum(acronyms, capitals)[live] / (1 + np.log(tf))
    place = np.log(np.log(3 + middle[live]))
    norm = tf / usual[of]
    score = np.full(len(start), np.nan)
    score[live] = rel * place / (case + norm / rel + (spread[live] / sentences[of]) / rel)
    return Tokens(number, chunk, code, names.to_numpy(zero_copy_only=False).tolist(), term, score[term])


def _rounded(score: np.ndarray) -> np.ndarray:
    """To ``DECIMALS``, halves of the decimal form up as the JVM does."""
    scaled = score * 10.0 ** DECIMALS
    out = np.rint(scaled) / 10.0 ** DECIMALS
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3):
        out[i] = float(Decimal(repr(float(score[i]))).quantize(Decimal(1).scaleb(-DECIMALS), ROUND_HALF_UP))
    return out


def phrases(t: Tokens, n: int = MAX_WORDS) -> Phrases:
    """The phrases of 1 to ``n`` terms."""
    at = np.flatnonzero(~np.isnan(t.score))
    terms = int(t.term.max(initial=-1)) + 1
    known, product, total = np.zeros(len(at), np.int64), np.ones(len(at)), np.zeros(len(at))
    found = []
    for k in range(n):
        if k:       # the phrases that go on
            on = np.minimum(at + k, len(t.text) - 1)
            goes_on = (at + k == on) & (t.chunk[at] == t.chunk[on]) & ~np.isnan(t.score[on])
            at, known, product, total = at[goes_on], known[goes_on], product[goes_on], total[goes_on]
        last = at + k
        product, total = product * t.score[last], total + t.score[last]
        order, start, known = _groups(known * terms + t.term[last])
        tf, one = np.diff(np.append(start, len(at))), order[start]
        found.append((t.text[at[one]], np.full(len(one), k + 1), at[one], _rounded(product[one] / (tf * (1 + total[one])))))
    return Phrases(*map(np.concatenate, zip(*found)))


def _distance(a: str, b: str) -> int:
    """The edit distance, a column of the table at once as the bits of whole
    numbers (Hyyrö 2003)."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) >> 1
    more, less, out = full, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        level = ((((same & more) + more) ^ more) | same) & full
        same |= less
        up, down = less | full & ~(level | more), more & level
        out += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & full, down << 1 & full
        more, less = down | full & ~(same | up), up & same
    return out


def _within(a: str, b: str, d: int) -> bool:
    """Whether the edit distance of strings whose lengths differ by at most
    ``d`` is that or less."""
    i, j, k = 0, len(a), len(b)
    while i < j and i < k and a[i] == b[i]:
        i += 1
    while j > i and k > i and a[j - 1] == b[k - 1]:
        j, k = j - 1, k - 1
    a, b = a[i:j], b[i:k]
    if max(len(a), len(b)) <= d:
        return True
    # of d + 1 parts of one, an edit leaves at least one whole, moved by d at most
    cuts = [len(a) * p // (d + 1) for p in range(d + 2)]
    if all(b.find(a[x:y], max(x - d, 0), y + d) < 0 for x, y in zip(cuts, cuts[1:])):
        return False
    return _distance(a, b) <= d


class _Edits(dict):
    """By the longer length: the largest distance with a similarity above ``dedup``."""

    def __init__(self, dedup: float):
        super().__init__()
        self.dedup = dedup

    def __missing__(self, longest: int) -> int:
        d = int((1 - self.dedup) * longest) + 1
        while d >= 0 and not 1.0 - d / longest > self.dedup:
            d -= 1
        self[longest] = d
        return d


def _ranked(found: Phrases) -> np.ndarray:
    """The phrases by text, score, place and words: one number each, in 63 bits
    unless a text has some hundred million words."""
    by, rank = np.argsort(found.score), np.empty(len(found.score), np.int64)
    rank[by] = np.cumsum(_opens(found.score[by]))
    words, places = int(found.n.max(initial=0)) + 1, int(found.pos.max(initial=0)) + 1
    return np.argsort(((found.text * (len(rank) + 1) + rank) * places + found.pos) * words + found.n)


def best_phrases(found: Phrases, t: Tokens, texts: int, k: int = KEPT, candidates: int = CANDIDATES,
                 dedup: float = DEDUP_LIMIT) -> pa.ListArray:
    """Of each text the ``k`` best phrases, best first (ties: the earlier one,
    then the shorter).  Of two whose similarity (1 - edit distance / longer
    length) is above ``dedup`` the better stays."""
    order = _ranked(found)
    ends = np.searchsorted(found.text[order], np.arange(texts), side="right").tolist()
    edits = _Edits(dedup)
    names, scores, sizes = [], [], []
    begin = 0
    for end in ends:
        kept: list[tuple[str, int]] = []
        for at in order[begin:end]:
            if len(kept) >= candidates:
                break
            pos = found.pos[at]
            phrase = " ".join([t.names[c] for c in t.code[pos:pos + found.n[at]].tolist()])
            size = len(phrase)
            for other, m in kept:
                d = edits[size if size > m else m]
                if -d <= size - m <= d and d and _within(phrase, other, d):
                    break
            else:
                kept.append((phrase, size))
                scores.append(found.score[at])
        names += [phrase for phrase, _ in kept[:k]]
        del scores[len(names):]
        sizes.append(len(names))
        begin = end
    flat = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["phrase", "score"])
    return pa.ListArray.from_arrays(pa.array([0, *sizes], pa.int32()), flat)


def _steps(sizes: np.ndarray):
    """Slices of at most ``STEP`` texts and ``STEP_BYTES``, one text at least."""
    begin = size = 0
    for i, s in enumerate(sizes.tolist()):
        if i > begin and (i - begin == STEP or size + s > STEP_BYTES):
            yield begin, i
            begin, size = i, 0
        size += s
    yield begin, len(sizes)


def keyphrases(df: DataFrame, text: str, out: str = "keyphrases", n: int = MAX_WORDS, k: int = KEPT,
               candidates: int = CANDIDATES, dedup: float = DEDUP_LIMIT, stopwords=T.STOPWORDS) -> DataFrame:
    """``out`` = array<struct<phrase, score>>, best first; empty for a null
    or blank text or one of stop words alone.  Rows are kept as they are, with
    repeated and null keys: the phrases depend on the text alone."""
    stop = sorted(set(stopwords))

    @F.arrow_udf("array<struct<phrase:string,score:double>>")
    def best(v: pa.Array, lower: pa.Array, upper: pa.Array) -> pa.Array:
        known, parts = pa.array(stop, pa.string()), []
        for i, j in _steps(pc.binary_length(v).to_numpy()):
            t = scored_tokens(*(x.slice(i, j - i) for x in (v, lower, upper)), known)
            parts.append(best_phrases(phrases(t, n), t, j - i, k, candidates, dedup))
        return pa.concat_arrays(parts)
    parted = df.withColumn("__text", signs_parted(F.col(text)))
    return parted.withColumn(out, best("__text", F.lower("__text"), F.upper("__text"))).drop("__text")
