"""SimHash near-duplicates found through Golay-code keys.

Fingerprints of 64 bits link if they differ in at most ``max_bits`` (up to
5) bits.  A fingerprint is cut into three segments of at most 23 bits.  The
binary Golay code of length 23 is perfect: each word lies within three bits
of exactly one code word.  The keys of a segment are the code words that it
and its one-bit neighbours decode to: six if the segment is three bits off
its code word, otherwise one.  Two segments that differ in two bits or fewer
have a neighbour in common, hence a key.  With five differing bits or fewer,
no two segments can both differ in three, so two segments share a key each:
fingerprints meet on a *pair* of keys, 24 bits of it, in some pair of
segments, and are then compared.

Where many distinct fingerprints meet, only a star for each linked set of
them is put out, never all pairs; copies of one fingerprint are one node.
Components are found by alternating large and small stars over the links.

Defined results: a null text has no words; a text without words has the
fingerprint zero, which links like any other; repeated rows come back each
with the same component; a null ``doc_id`` is never a component's id unless
all its documents lack one; an empty table gives an empty table; other
columns are ignored by ``components`` and kept by ``representatives``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_in_arrow, materialize, texts

GENERATOR = 0b101011100011      # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SHORT_RUN = 8                   # meetings of so few are compared by shifting


def fingerprint(text: str, shingle: int) -> bytes:
    """The 64 bits, highest first: a bit is set if it is in over half the
    hashes (XXH64, seed 42) of the text's word shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(8)
    ends = list(itertools.accumulate(map(len, words), lambda a, n: a + 1 + n))
    line, starts = b" ".join(words), [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], 42) for a, b in
                       zip(starts, ends[shingle - 1:] or ends[-1:])])
    # in parts, so that a very long text needs little memory
    count, n = np.zeros(64, np.int64), len(hashes) // 8
    for at in range(0, len(hashes), 1 << 20):
        part = np.frombuffer(hashes, np.uint8, min(1 << 20, len(hashes) - at), at)
        count += np.unpackbits(part.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * count > n).tobytes()


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fingerprint as bigint) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = b"".join([fingerprint(t, shingle) for t in texts(b.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.frombuffer(made, ">i8").astype(np.int64))],
                names=["doc_id", "fingerprint"])

    return map_in_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
                        run, "doc_id bigint, fingerprint bigint")


# -- Golay keys -----------------------------------------------------------------

def _syndrome(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << bit - 11
    return word


def _tables() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes of each byte of a word, and for each syndrome the patterns
    that lead from a word to the code words of its keys (-1: no more)."""
    by_byte = [np.array([_syndrome(v << s & (1 << 23) - 1) for v in range(256)], np.int32)
               for s in (0, 8, 16)]
    leader = np.zeros(2048, np.int64)
    for weight in (1, 2, 3):
        for bits in itertools.combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            leader[_syndrome(pattern)] = pattern
    near = np.full((2048, 6), -1, np.int64)
    for s in range(2048):
        found = {int(leader[s])} | {1 << b ^ int(leader[s ^ _syndrome(1 << b)]) for b in range(23)}
        near[s, :len(found)] = sorted(found)
    return by_byte, near


BY_BYTE, NEAR = _tables()


def segment_keys(words: np.ndarray) -> np.ndarray:
    """The code word indices (12 bits) of each word's keys, six columns, -1
    where there are fewer."""
    syndrome = (BY_BYTE[0][words & 255] ^ BY_BYTE[1][words >> 8 & 255] ^ BY_BYTE[2][words >> 16])
    pattern = NEAR[syndrome]
    return np.where(pattern >= 0, (words[:, None] ^ pattern) >> 11, -1)


def meeting_keys(prints: DataFrame) -> DataFrame:
    """(key, fingerprint): every pair of keys of every pair of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                f = whole.column("fingerprint").slice(at, 4096).to_numpy()
                bits = f.view(np.uint64)
                parts = [segment_keys((bits >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64))
                         for s, n in SEGMENTS]
                for k, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
                    x, y = parts[a][:, :, None], parts[b][:, None, :]
                    row, i, j = np.nonzero((x >= 0) & (y >= 0))
                    key = k << 24 | parts[a][row, i] << 12 | parts[b][row, j]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.astype(np.int32)), pa.array(f[row])],
                        names=["key", "fingerprint"])

    return map_in_arrow(prints.select("fingerprint"), run, "key int, fingerprint bigint")


# -- links ------------------------------------------------------------------------

def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits differ (bitwise_count takes the magnitude of signed
    integers, hence the view)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def stars(prints: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among ``prints``: each linked
    set as a star around its smallest member."""
    out, rest = [], np.sort(prints)
    while len(rest):
        centre, found, todo = rest[0], [], [rest[0]]
        rest = rest[1:]
        while todo and len(rest):
            near = differing(rest, todo.pop()) <= max_bits
            if near.any():
                found.append(rest[near])
                todo.extend(rest[near])
                rest = rest[~near]
        if found:
            leaves = np.concatenate(found)
            out.append((leaves, np.full(len(leaves), centre)))
    return out


def links(meetings: DataFrame, max_bits: int) -> DataFrame:
    """Distinct links (u, v), u > v, that connect all fingerprints which
    meet on a key and differ in at most ``max_bits`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.zeros(0, np.int32), np.zeros(0, np.int64)

        def linked(key: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            short = np.repeat(size <= SHORT_RUN, size)
            found = []
            for d in range(1, SHORT_RUN):
                at = np.flatnonzero((key[d:] == key[:-d]) & short[d:])
                at = at[differing(f[at + d], f[at]) <= max_bits]
                found.append((f[at + d], f[at]))
            for k in np.flatnonzero(size > SHORT_RUN):
                found += stars(f[first[k]:first[k] + size[k]], max_bits)
            u = np.concatenate([x for x, _ in found])
            v = np.concatenate([x for _, x in found])
            pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

        parts: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for b in itertools.chain(batches, [None]):
            if b is not None:
                parts.append((b.column("key").to_numpy(), b.column("fingerprint").to_numpy()))
                rows += b.num_rows
                if rows < 100_000:
                    continue
            if not parts and not len(held):
                continue
            key = np.concatenate([held_key, *(k for k, _ in parts)])
            f = np.concatenate([held, *(x for _, x in parts)])
            parts, rows = [], 0
            # the last key may go on in the next batch
            stop = len(key) if b is None else int(np.searchsorted(key, key[-1]))
            held_key, held = key[stop:], f[stop:]
            if stop:
                yield linked(key[:stop], f[:stop])

    dealt = meetings.repartition("key").sortWithinPartitions("key", "fingerprint")
    return map_in_arrow(dealt, run, "u bigint, v bigint").distinct()


def star_forest(edges: DataFrame) -> DataFrame:
    """Connected components of links (u, v), u > v: rows (u, v) that name
    for every node but the smallest its component's smallest node.

    A round lets each node link its larger neighbours to the smallest one it
    knows (large star), then its smaller ones (small star); the links are
    written to the shared folder after each round, until they stay alike."""
    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first())

    now = materialize(edges, "links")
    was = state(now)
    while was[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        if (found := state(now)) == was:
            break
        was = found
    return now


def components(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, fingerprint as bigint, component_id): the smallest id that
    links lead to."""
    if not 0 <= max_bits <= 5:
        raise ValueError("two of three segments must be within two bits: at most 5 bits in all")
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    forest = star_forest(links(meeting_keys(nodes), max_bits))
    rooted = nodes.join(forest.withColumnRenamed("u", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("v", "fingerprint").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(roots, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest
    id, and of repeated rows with this id one.  Documents without an id
    cannot be named and stay."""
    keep = components(docs, shingle, max_bits).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(keep, "doc_id", "left_semi")
    turn = Window.partitionBy("doc_id").orderBy(
        F.xxhash64(*[c for c in docs.columns if c != "doc_id"]))
    return (named.withColumn("_turn", F.row_number().over(turn)).where("_turn = 1")
            .select(*docs.columns).unionByName(docs.where("doc_id IS NULL")))


def digests(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """``components`` with the fingerprint as 16 hexadecimal digits."""
    return components(docs, shingle, max_bits).withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
