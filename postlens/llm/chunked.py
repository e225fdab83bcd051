"""Tokenising with the ``tokenizers`` library through a memo of chunks.

Both vocabularies split a text before any merge, and never across the
places where this module cuts it.  A chunk therefore has the same ids alone
as inside its text, and each worker encodes a chunk it has met before by a
dictionary lookup.  The memo is bounded.
"""

from __future__ import annotations

import functools
import re

import numpy as np

from .common import vocabulary

MEMO_ENTRIES = 600_000      # chunks in one of a worker's two generations
MEMO_CHUNK_CHARS = 64       # longer chunks are encoded each time they occur

_HARD_SPACE = re.compile(r" (?=\s|\Z)")
_WORD_SPACE = re.compile(r" (?=\S)")


def byte_level_chunks(text: str) -> list[str]:
    """Keys of chunks that start at a space followed by a visible character.
    The byte-level split pattern begins a match at each such space, since it
    takes a single space only together with what follows it.  A key is the
    chunk without that space; the text's first chunk, which has none, has
    one as its key."""
    parts = text.split(" ") if not _HARD_SPACE.search(text) else _WORD_SPACE.split(text)
    parts[0] = " " + parts[0]
    return parts


def white_space_chunks(text: str) -> list[str]:
    """Chunks between blanks and line ends, which the word-level split
    pattern drops."""
    return text.replace("\n", " ").split(" ")


class ChunkEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    The memo has two generations: when the younger one is full it becomes
    the older one, and what is met again moves back.  New chunks are encoded
    many to a text and their ids cut apart again (``join`` and ``ends``)."""

    MANY = 2000             # new chunks in one text

    def __init__(self, file: str, split):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(file)
        self.model.encode_special_tokens = True
        self.split = split
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def text(self, key: str) -> str:
        """The chunk of a key."""
        raise NotImplementedError

    def together(self, keys: list[str]) -> list[str]:
        """Those of the keys whose chunks can be encoded with others."""
        raise NotImplementedError

    def join(self, keys: list[str]) -> str | None:
        """One text of the chunks, None if they can't be told apart in it."""
        raise NotImplementedError

    def ends(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each chunk's ids begin and end among those of ``join``."""
        raise NotImplementedError

    def _encode(self, new: set[str]) -> None:
        memo = self.memo
        some = self.together([c for c in new if len(c) <= MEMO_CHUNK_CHARS])
        for at in range(0, len(some), self.MANY):
            part = some[at:at + self.MANY]
            text = self.join(part)
            if text is not None:
                ids = self.ids(text)
                first, last = self.ends(ids)
                raw = ids.tobytes()
                for key, a, b in zip(part, (4 * first).tolist(), (4 * last).tolist(), strict=True):
                    memo[key] = raw[a:b]
        for c in new.difference(memo):
            memo[c] = self.ids(self.text(c)).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo, self.older = {}, self.memo
        known, older = self.memo, self.older
        split = [self.split(t) for t in texts]
        new = set().union(*split).difference(known)
        again = new.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        new -= again
        self._encode(new)
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for c in new:
            if len(c) > MEMO_CHUNK_CHARS:
                del known[c]
        return out


class ByteLevel(ChunkEncoder):
    """Chunks that hold their only space in front are written one after the
    other; a token with a space in front begins the next."""

    MANY = 100              # the library takes less time a chunk on short texts

    def __init__(self, file: str):
        super().__init__(file, byte_level_chunks)
        names = self.model.get_vocab()
        self.begins = np.zeros(max(names.values()) + 1, bool)
        self.begins[[i for name, i in names.items() if name.startswith("\u0120")]] = True

    def text(self, key: str) -> str:
        return key[1:] if key[0] == " " else " " + key

    def together(self, keys: list[str]) -> list[str]:
        return [k for k in keys if " " not in k]

    def join(self, keys: list[str]) -> str | None:
        return " " + " ".join(keys)

    def ends(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(self.begins[ids])
        return first, np.append(first[1:], len(ids))


class WordLevel(ChunkEncoder):
    """Chunks are written with a symbol between them that none of them has."""

    SYMBOLS = "~^|"      # no other character is normalised to one of these

    def __init__(self, file: str):
        super().__init__(file, white_space_chunks)
        self.between = 0

    def text(self, key: str) -> str:
        return key

    def together(self, keys: list[str]) -> list[str]:
        return [k for k in keys if k]

    def join(self, keys: list[str]) -> str | None:
        text = "\n".join(keys)
        for symbol in self.SYMBOLS:
            own = self.ids(symbol)
            if symbol not in text and len(own) == 1:
                self.between = own[0]
                return text.replace("\n", f" {symbol} ")
        return None

    def ends(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(ids == self.between)
        return np.append(0, at + 1), np.append(at, len(ids))


@functools.cache
def byte_level(name: str) -> ChunkEncoder:
    return ByteLevel(vocabulary(name))


@functools.cache
def word_level(name: str) -> ChunkEncoder:
    return WordLevel(vocabulary(name))
