"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Merging by rank leaves every byte string with exactly one encoding, and each
prefix of the string has an encoding of its own.  For each prefix it is
enough to store its *last* token: the token is the only one ending there
whose pairing with the last token of the shorter prefix survives the merges.
The table is filled from left to right, so bytes can be appended exactly,
and after an edit only the entries near it have to be filled again.

A pair of tokens survives if no merge across the border between them would
have come before the merges that built its two sides; see ``Ranks.fits``.

Defined results: a null text is the empty text, an empty text has no ids,
texts of any length are encoded whole, repeated rows are encoded alike, an
empty table gives an empty table, other columns are kept as they are.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunked import byte_level_chunks
from .common import map_in_arrow, texts, vocabulary

NEVER = 1 << 62
FITS_ENTRIES = 300_000      # remembered answers of Ranks.fits
MEMO_ENTRIES = 150_000      # chunks, and pieces, in one of a worker's two generations
MEMO_CHUNK_CHARS = 64       # longer ones are not remembered
LAZY_BYTES = 256            # longer matches have all their prefixes filled from left to right
SLICE_CHARS = 1 << 21       # characters of texts encoded at once


class Ranks:
    """A rank file (base64 token, rank per line) and what follows from it."""

    def __init__(self, file: str):
        with open(file, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of: list[bytes] = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.bytes_of[rank] = token
        self.longest = max(map(len, self.rank))
        self.raw = [*map(bytes, np.arange(len(self.bytes_of), dtype="<u4").reshape(-1, 1).view(np.uint8))]
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.known_fits: dict[int, bool] = {}

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None if merging its
        bytes never makes it (a single byte is its own token)."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.bytes_of[token]]
            while len(parts) > 2:
                best, at = min(((self.rank.get(parts[i] + parts[i + 1], NEVER), i)
                                for i in range(len(parts) - 1)))
                if best >= token:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (tuple(self.rank[p] for p in parts)
                                   if len(parts) == 2 else None)
        return self._halves[token]

    def made_by_merging(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self.halves(token) is not None

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` followed by ``right`` stays as it is.

        Both tokens are taken apart again in the reverse order of their
        merges.  At each moment a token x touches a token y at the border; a
        merge of the two comes first, and spoils the pair, if its rank is
        below that of the merge that x goes into, and not above that of y
        (of equal ranks the merge further left is made first)."""
        if len(self.known_fits) > FITS_ENTRIES:
            self.known_fits.clear()
        fit = self.known_fits[left << 32 | right] = (
            self.made_by_merging(right) and self._survives(left, right))
        return fit

    def _survives(self, x: int, y: int) -> bool:
        x_goes, y_goes = NEVER, NEVER
        while True:
            across = self.rank.get(self.bytes_of[x] + self.bytes_of[y], NEVER)
            if across < x_goes and across <= y_goes:
                return False
            x_made = x if len(self.bytes_of[x]) > 1 else -1
            y_made = y if len(self.bytes_of[y]) > 1 else -1
            if x_made < 0 and y_made < 0:
                return True
            if y_made >= x_made:
                y, y_goes = self.halves(y)[0], y
            else:
                x, x_goes = self.halves(x)[1], x


class Prefixes:
    """The last token of each prefix of a byte string, which may grow and
    change.  ``last[i]`` belongs to the first ``i`` bytes; None: not asked for
    so far."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", [-1]
        self.append(data)

    def _fill(self, i: int) -> int:
        data, last, ranks = self.data, self.last, self.ranks
        rank, known, fits = ranks.rank, ranks.known_fits, ranks.fits
        for start in range(max(0, i - ranks.longest), i):
            token = rank.get(data[start:i])
            if token is None:
                continue
            if start == 0:
                if ranks.made_by_merging(token):
                    return token
            else:
                before = last[start]
                if before is None:
                    before = last[start] = self._fill(start)
                fit = known.get(before << 32 | token)
                if fit is None:
                    fit = fits(before, token)
                if fit:
                    return token
        raise ValueError("no token ends here")

    def append(self, data: bytes) -> None:
        at = len(self.data)
        self.data += data
        for i in range(at + 1, len(self.data) + 1):
            self.last.append(self._fill(i))

    def become(self, data: bytes) -> None:
        """Hold ``data`` instead; the entries of the common prefix stay, and of a
        short string the others are filled when they are asked for."""
        n, most = 0, min(len(data), len(self.data))
        while n < most and data[n] == self.data[n]:
            n += 1
        del self.last[n + 1:]
        if len(data) > LAZY_BYTES:
            self.data = data[:n]
            self.append(data[n:])
        else:
            self.data = data
            self.last += [None] * (len(data) - n)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in place of bytes ``start`` to ``stop``; returns how
        many entries were filled anew.  Entries before the edit stay.  An
        entry depends on the bytes and entries one token length back, so once
        that many in a row come out as they were, the rest is as before."""
        old, grown = self.last, len(data) - (stop - start)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[:start + 1]
        same, i = 0, start
        while i < len(self.data) and same <= self.ranks.longest:
            i += 1
            self.last.append(self._fill(i))
            before = i - grown
            same = same + 1 if before > stop and old[before] == self.last[i] else 0
        self.last += old[i - grown + 1:]
        return i - start

    def tokens(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            if self.last[i] is None:
                self.last[i] = self._fill(i)
            out.append(self.last[i])
            i -= len(self.ranks.bytes_of[out[-1]])
        return out[::-1]


class Memo:
    """A bounded dictionary of two generations: when the younger one is full it
    becomes the older one, and what is met again moves back."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: set[str]) -> set[str]:
        """Those of the keys that are not known; the others are in ``young``."""
        if len(self.young) > MEMO_ENTRIES:
            self.young, self.old = {}, self.young
        new = keys.difference(self.young)
        again = new.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        return new - again

    def drop_long(self, keys) -> None:
        for k in keys:
            if len(k) > MEMO_CHUNK_CHARS:
                del self.young[k]


class Encoder:
    """Ids of whole texts: each match of the split pattern separately, a
    match that is a token at once, any other by its prefixes."""

    def __init__(self, ranks: Ranks, pattern: str):
        import regex

        self.ranks = ranks
        # \s of the pattern is the Unicode white space property
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(
            r"(?!\S)", r"(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}"))
        self.piece_ids, self.memo = Memo(), Memo()

    def piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass")
        token = self.ranks.rank.get(data)
        return [token] if token is not None else Prefixes(self.ranks, data).tokens()

    def __call__(self, texts: list[str]) -> list[bytes]:
        """A space before a visible character always starts a match, so texts
        may be cut there; chunks and matches met before are looked up.  New
        matches are taken in byte order: each keeps the prefix entries that
        it has in common with the one before."""
        rank, raw = self.ranks.rank, self.ranks.raw
        cut = [byte_level_chunks(t) for t in texts]
        chunks = {c: self.pieces.findall(c[1:] if c[:1] == " " else " " + c)
                  for c in self.memo.missing(set().union(*cut))}
        new = self.piece_ids.missing(set().union(*chunks.values()))
        memo, ids = self.memo.young, self.piece_ids.young
        table = Prefixes(self.ranks)
        for data, p in sorted((p.encode("utf-8", "surrogatepass"), p) for p in new):
            token = rank.get(data)
            if token is None:
                table.become(data)
                ids[p] = b"".join(map(raw.__getitem__, table.tokens()))
            else:
                ids[p] = raw[token]
        for c, ps in chunks.items():
            memo[c] = b"".join(map(ids.__getitem__, ps)) if len(ps) != 1 else ids[ps[0]]
        out = [b"".join(map(memo.__getitem__, parts)) for parts in cut]
        self.piece_ids.drop_long(new)
        self.memo.drop_long(chunks)
        return out


class EditableText:
    """An encoded text that takes appends and edits.  Only the matches of
    the pattern near an edit are found and encoded again."""

    LOOK = 3    # characters from its start that a match looks at, at least

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text, self.pieces = encoder, "", []
        self.replace(0, 0, text)

    def replace(self, start: int, stop: int, new: str) -> int:
        """Put ``new`` in place of characters ``start`` to ``stop``; returns
        how many matches were encoded anew."""
        # a match looks two characters past its end: the run of white space
        # that it gives one character back from, and what follows the run
        kept, at = [], 0
        for piece in self.pieces:
            if at + max(len(piece[0]) + 2, self.LOOK) > start:
                break
            kept.append(piece)
            at += len(piece[0])
        begins, old_at = {}, 0
        for k, piece in enumerate(self.pieces):
            begins[old_at] = k
            old_at += len(piece[0])
        grown = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        made, tail = [], []
        for m in self.encoder.pieces.finditer(self.text, at):
            if m.start() - grown >= stop and m.start() - grown in begins:
                tail = self.pieces[begins[m.start() - grown]:]
                break
            made.append((m[0], self.encoder.piece(m[0])))
        self.pieces = kept + made + tail
        return len(made)

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def tokens(self) -> list[int]:
        return [t for _, ids in self.pieces for t in ids]


@functools.cache
def encoder(vocab: str, pattern: str) -> Encoder:
    return Encoder(Ranks(vocabulary(vocab)), pattern)


@functools.cache
def ranks_of(vocab: str) -> Ranks:
    return Ranks(vocabulary(vocab))


def encode(df: DataFrame, text: str, out: str, vocab: str, pattern: str) -> DataFrame:
    """Add ``out``: the ids of the whole text as binary, little-endian
    unsigned 32-bit integers.  Runs in the scan's tasks, without a shuffle."""
    schema = T.StructType([f for f in df.schema if f.name != out]).add(out, "binary")
    names = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab, pattern)
        for b in batches:
            # rows go out in slices, so that a batch of long texts stays small
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                ids = pa.array(enc(texts(part.column(text))), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), ids], names=[*names, out])

    return map_in_arrow(df, run, schema)


def decode(ids: Column, vocab: str) -> Column:
    """The bytes that ids (binary, as ``encode`` makes them) stand for."""

    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = ranks_of(vocab).bytes_of
        for s in batches:
            yield s.map(lambda x: b"".join(map(table.__getitem__, np.frombuffer(x, "<u4").tolist())),
                        na_action="ignore")

    return back(ids)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(first, length) of runs of texts of at most ``SLICE_CHARS`` together,
    or of one longer text."""
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > SLICE_CHARS:
            yield at, i - at
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes) - at


def digests(df: DataFrame, vocab: str, pattern: str) -> DataFrame:
    """Per document: the number of ids, the SHA-256 of the ids and that of
    the bytes decoded from them.  Ids and bytes stay in the worker that made
    them, which has one table for both ways."""
    schema = T.StructType([df.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab, pattern)
        table = pa.array(enc.ranks.bytes_of, pa.large_binary())
        for b in batches:
            lengths = [n or 0 for n in pc.utf8_length(b.column("text")).to_pylist()]
            for at, n in _slices(lengths):
                part = b.slice(at, n)
                ids = enc(texts(part.column("text")))
                counts = [len(x) // 4 for x in ids]
                hashes = [hashlib.sha256(x).hexdigest() for x in ids]
                decoded = table.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
                raw = memoryview(decoded.buffers()[2] or b"")
                ends = np.frombuffer(decoded.buffers()[1], np.int64)[np.cumsum([0, *counts])].tolist()
                back = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(back)],
                    names=schema.names)

    return map_in_arrow(df.select("doc_id", "text"), run, schema)
