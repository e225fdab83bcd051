"""Emoji and their aliases.

The table is built from the Unicode names that Python carries: a symbol's
alias is its name in lower case, words joined by underscores, between colons
(``:grinning_face:``).  Skin tones, key caps, flags of two regional indicators
and sequences joined by U+200D follow from rules over their parts.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column

from . import arrow as AR

# the alias function goes along with its UDF
cloudpickle.register_pickle_by_value(sys.modules[__name__])

JOINER, VARIATION, KEYCAP = "\u200D", "\uFE0F", "\u20E3"
# Blocks of symbols shown as emoji, skin tone modifiers, regional
# indicators, people that joined sequences begin with.
BLOCKS = ((0x2600, 0x27BF), (0x2B05, 0x2B55), (0x1F300, 0x1F5FF), (0x1F600, 0x1F64F), (0x1F680, 0x1F6FF),
          (0x1F7E0, 0x1F7EB), (0x1F900, 0x1F9FF), (0x1FA70, 0x1FAFF))
TONES = {"\U0001F3FB": "light", "\U0001F3FC": "medium_light", "\U0001F3FD": "medium", "\U0001F3FE": "medium_dark",
         "\U0001F3FF": "dark"}
REGIONAL = 0x1F1E6
KEYS = "0123456789#*"
OTHER_NAMES = {"\u2764": "red_heart", "\U0001F44D": "thumbs_up", "\U0001F44E": "thumbs_down"}


def _name(symbol: str) -> str:
    if symbol in OTHER_NAMES:
        return OTHER_NAMES[symbol]
    return unicodedata.name(symbol, "").lower().replace(" ", "_").replace("-", "_")


@functools.cache
def symbols() -> dict[str, str]:
    """Names of single symbols."""
    every = (chr(c) for first, last in BLOCKS for c in range(first, last + 1))
    return {s: _name(s) for s in every if _name(s) and s not in TONES}


def part_pattern() -> str:
    """One symbol with its variation selector or skin tone."""
    ranges = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in BLOCKS)
    tones = "[\\x{1F3FB}-\\x{1F3FF}]"
    return f"(?:(?!{tones})[{ranges}](?:{tones}|\\x{{FE0F}})?)"


def pattern() -> str:
    """Every emoji sequence, longest first at its place: joined symbols, flags,
    key caps."""
    flag = "[\\x{1F1E6}-\\x{1F1FF}]"
    return f"{part_pattern()}(?:\\x{{200D}}{part_pattern()})*|{flag}{flag}|[{KEYS}]\\x{{FE0F}}?\\x{{20E3}}"


def alias(sequence: str) -> str:
    """The alias of one sequence that ``pattern`` matches."""
    if sequence[-1] == KEYCAP:
        return f":keycap_{sequence[0]}:"
    if ord(sequence[0]) - REGIONAL in range(26):
        return ":flag_" + "".join(chr(ord(c) - REGIONAL + ord("a")) for c in sequence) + ":"
    out = []
    for part in sequence.split(JOINER):
        tone = f"_{TONES[part[1]]}_skin_tone" if part[1:] in TONES else ""
        out.append(_name(part[0]) + tone)
    return ":" + "_".join(out) + ":"


class _Aliases(dict):
    def __missing__(self, sequence):
        return alias(sequence)


def aliases() -> dict[str, str]:
    return _Aliases()


def _named() -> Callable[[str], str]:
    """``alias`` of the sequences whose symbols all have names, else themselves."""
    names, tones = symbols(), TONES

    def named(sequence: str) -> str:
        if sequence[-1] == KEYCAP:
            return f":keycap_{sequence[0]}:"
        if ord(sequence[0]) - REGIONAL in range(26):
            return ":flag_" + "".join(chr(ord(c) - REGIONAL + ord("a")) for c in sequence) + ":"
        parts = sequence.split(JOINER)
        if any(p[0] not in names for p in parts):
            return sequence
        return ":" + "_".join(names[p[0]] + (f"_{tones[p[1]]}_skin_tone" if p[1:] in tones else "") for p in parts) + ":"
    return named


def to_aliases(c: Column) -> Column:
    """T4: every emoji sequence of the text replaced by its alias, the rest as
    it is; null stays null.  Symbols that the pattern's blocks hold but Unicode
    does not name are left alone.  One pass over a batch of texts, no shuffle."""
    return AR.replaced_matches(c, re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), pattern()), _named())
