"""Line dedup by content-defined chunks of lines.

The lines of a text are hashed, and a rolling hash, whose window is one
line, decides after which lines a chunk ends.  A boundary depends on its line
alone, so lines put in or left out elsewhere don't shift it, and a passage
that two documents share is cut alike in both, but for its ends.  One set of
boundaries misses most short passages, whose ends are glued to lines of their
own documents, so each text is cut by up to ``SETS`` independent sets, one for
each bit of the hash.

A chunk (of any set) of at least two lines with words that occurs more than
once in the corpus stays in the document with the smallest id, at its first
place.  Elsewhere its lines are removed once its bytes have been compared,
but for those that a chunk which stays there has, so that each repeated chunk
stays whole in one place.

Spark moves hashes only to find what is repeated: first pairs of adjacent
lines, since a chunk repeats only where all its pairs do, then the chunks of
the repeated pairs.  The bytes of one occurrence of each repeated chunk then
travel to the documents that have the others, where they are compared and the
lines taken out.

Defined results: a null text stays null, an empty one empty; a text whose
chunks are all removed becomes empty, its row stays; rows that share an id
count as one document, so repeated rows come out alike; rows without an id
count as one document behind all others; an empty table gives an empty
table; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_in_arrow, materialize

SETS = 64            # boundary sets: a line is a boundary in half of them
LEAST_LINES = 2      # lines with words of a chunk that may be removed
EDGE = (1 << 64) - 1     # a text begins and ends with a boundary of every set


def hashed(lines: list[str]) -> np.ndarray:
    """The hash of each line; its lowest bit says if the line has words."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    return np.array([digest(x.encode("utf-8", "surrogatepass")) & ~1 | bool(x.strip()) for x in lines], np.uint64)


def boundaries(hashes: np.ndarray) -> np.ndarray:
    """For each line hash the sets, as bits, in which a chunk ends with it."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def chunks(text: str, of: int = 0) -> list[tuple[int, int]]:
    """(first line, line after the last) of each chunk of a text, by the
    boundary set ``of``."""
    out, start = [], 0
    cut = (boundaries(hashed(text.split("\n"))) >> np.uint64(of) & np.uint64(1)).tolist()
    for i, end in enumerate(cut, 1):
        if end or i == len(cut):
            out.append((start, i))
            start = i
    return out


def repeatable(text: str, of: int = 0) -> Iterator[tuple[int, int, str]]:
    """(first line, line after the last, chunk) of the chunks with enough
    lines that have words, by the boundary set ``of``."""
    lines = text.split("\n")
    for a, b in chunks(text, of):
        if sum(1 for x in lines[a:b] if x.strip()) >= LEAST_LINES:
            yield a, b, "\n".join(lines[a:b])


def adjacent(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, before, this, next, last): each line that has
    a next one, with the hashes of both, the boundary sets of the line before
    it, and whether the next line is the text's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, at, sizes = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                if text is None or "\n" not in text:
                    continue
                h = hashed(text.split("\n"))
                last = np.zeros(len(h) - 1, bool)
                last[-1] = True
                parts.append((np.arange(len(h) - 1, dtype=np.int32),
                              np.r_[np.uint64(EDGE), boundaries(h[:-2])].view(np.int64),
                              h[:-1].view(np.int64), h[1:].view(np.int64), last))
                at.append(i)
                sizes.append(len(h) - 1)
            if not parts:
                continue
            place = pa.array(np.repeat(at, sizes))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(place), b.column("text_hash").take(place),
                 *[pa.array(np.concatenate(c)) for c in zip(*parts)]],
                names=["doc_id", "text_hash", "line", "before", "this", "next", "last"])

    return map_in_arrow(docs.select("doc_id", "text_hash", "text"), run,
                        "doc_id bigint, text_hash bigint, line int, before bigint, this bigint, next bigint, last boolean")


def spans(pairs: dict[int, tuple[int, int, int, bool]], sets: int) -> Iterator[tuple[int, int, bytes]]:
    """(first line, line after the last, hash) of the chunks of all sets that
    lie within ``pairs``: line -> (before, this, next, last)."""
    import xxhash

    order = sorted(pairs)
    hashes = np.array([pairs[i][1:3] for i in order], np.int64).view(np.uint64).reshape(-1, 2)
    cuts = boundaries(hashes).tolist()
    used = (1 << sets) - 1
    for first, a in enumerate(order):
        before, this, _, _ = pairs[a]
        # the sets with a boundary before the chunk and none in it so far
        open_sets, words, k = before & used & ~cuts[first][0], this & 1, first
        state = xxhash.xxh3_128(int(hashes[k, 0]).to_bytes(8, "little"))
        while open_sets:
            _, _, after, last = pairs[order[k]]
            ends = EDGE if last else cuts[k][1]
            words += after & 1
            state.update(int(hashes[k, 1]).to_bytes(8, "little"))
            if open_sets & ends and words >= LEAST_LINES:
                yield a, order[k] + 2, state.digest()
            open_sets &= ~ends
            if k + 1 == len(order) or order[k + 1] != order[k] + 1:
                break
            k += 1


def occurrences(docs: DataFrame, sets: int) -> DataFrame:
    """(doc_id, text_hash, line, end, chunk_hash, again): the chunks all of
    whose pairs of lines are repeated; ``again``: the same document has the
    chunk further up."""
    rows = adjacent(docs)
    often = rows.groupBy("this", "next").agg(F.count("*").alias("n")).where("n > 1").select("this", "next")
    pairs = rows.join(often, ["this", "next"]).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("line", "before", "this", "next", "last")).alias("pairs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, own, found in zip(*(b.column(k).to_pylist() for k in ("doc_id", "text_hash", "pairs"))):
                # repeated rows have the same pairs once more
                known = {p["line"]: (p["before"], p["this"], p["next"], p["last"]) for p in found}
                seen: set[bytes] = set()
                for a, z, chunk in spans(known, sets):
                    out.append((doc, own, a, z, chunk, chunk in seen))
                    seen.add(chunk)
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()))],
                names=["doc_id", "text_hash", "line", "end", "chunk_hash", "again"])

    return map_in_arrow(pairs, run, "doc_id bigint, text_hash bigint, line int, end int, chunk_hash binary, again boolean")


def cover(found: list[dict]) -> Iterator[tuple[int, int, bytes, list[int]]]:
    """(first line, line after the last, hash, lines to take out): few of a
    text's repeated chunks (line, end, chunk_hash, stays) that together have
    all the lines it loses, each line in one of them."""
    held = {i for x in found if x["stays"] for i in range(x["line"], x["end"])}
    todo = sorted((x["line"], x["end"], x["chunk_hash"]) for x in found if not x["stays"])
    done, k = 0, 0
    while k < len(todo):
        # the furthest chunk among those that begin where the last one ended
        best = todo[k]
        while k < len(todo) and todo[k][0] <= max(done, best[0]):
            best = max(best, todo[k], key=lambda x: x[1])
            k += 1
        a, z, chunk = best
        gone = [i for i in range(max(a, done), z) if i not in held]
        if gone:
            yield a, z, chunk, gone
        done = max(done, z)


def _cuts(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, end, chunk_hash, gone) of ``cover``."""
    grouped = rows.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("line", "end", "chunk_hash", "stays")).alias("found")).where(
        F.exists("found", lambda x: ~x["stays"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(doc, own, *x) for doc, own, found in zip(*(
                b.column(k).to_pylist() for k in ("doc_id", "text_hash", "found"))) for x in cover(found)]
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32())))],
                names=["doc_id", "text_hash", "line", "end", "chunk_hash", "gone"])

    return map_in_arrow(grouped, run, "doc_id bigint, text_hash bigint, line int, end int, chunk_hash binary, gone array<int>")


def _chunk_at(docs: DataFrame) -> DataFrame:
    """(chunk_hash, chunk): the bytes of the chunks asked for in the column
    ``wanted``, an array of (line, end, chunk_hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found = [], []
            for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                lines = text.split("\n")
                for w in wanted:
                    keys.append(w["chunk_hash"])
                    found.append("\n".join(lines[w["line"]:w["end"]]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())],
                                             names=["chunk_hash", "chunk"])

    # a repeated row has the same bytes once more
    return map_in_arrow(docs.select("text", "wanted"), run, "chunk_hash binary, chunk string").dropDuplicates(["chunk_hash"])


def removals(docs: DataFrame, sets: int) -> DataFrame:
    """(doc_id, text_hash, parts): what documents may lose, as an array of
    (line, end, chunk, gone), the chunk being the bytes of the occurrence that
    stays and ``gone`` the lines to take out.  ``docs`` has doc_id, text_hash
    and text."""
    found = materialize(occurrences(docs, sets), "chunks")
    # keepers: the smallest id, and the first place within it
    often = found.groupBy("chunk_hash").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("keeper")).where("n > 1")
    rows = materialize(found.join(often, "chunk_hash").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("keeper")) & ~F.col("again")).select(
        "doc_id", "text_hash", "line", "end", "chunk_hash", "stays"), "repeated")
    cuts = materialize(_cuts(rows), "cuts")
    wanted = rows.where("stays").join(cuts.select("chunk_hash").distinct(), "chunk_hash", "left_semi").dropDuplicates(
        ["chunk_hash"]).groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("line", "end", "chunk_hash")).alias("wanted"))
    held = _chunk_at(_beside(_named(docs, F.col("text_hash")), wanted, "inner"))
    return cuts.join(held, "chunk_hash").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("line", "end", "chunk", "gone")).alias("parts"))


#: Names of the join columns beside a user's own columns.
OWN_HASH, OWN_ID = "__text_hash", "__id"


def _named(docs: DataFrame, text_hash: Column) -> DataFrame:
    """``docs`` with the join columns; a null id is a value of its own."""
    return docs.withColumn(OWN_HASH, text_hash).withColumn(
        OWN_ID, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def _beside(docs: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """``docs`` (with join columns) and the other columns of ``more``, whose
    key is (doc_id, text_hash)."""
    return docs.join(_named(more, F.col("text_hash")).drop("doc_id", "text_hash"), [OWN_ID, OWN_HASH], how)


def dedup(docs: DataFrame, sets: int = 1) -> DataFrame:
    """``docs`` without the repeated chunks of their texts by the first
    ``sets`` boundary sets, and the columns ``n_removed_chunks`` (of ``cover``)
    and ``n_removed_lines`` (int).  The queries use all ``SETS``."""
    names = docs.columns
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.xxhash64("text").alias("text_hash"), "text")
    lost = removals(narrow, sets).withColumnRenamed("parts", "__parts")
    joined = _beside(_named(docs, F.xxhash64("text")), lost, "left")
    schema = T.StructType([docs.schema[n] for n in names]).add("n_removed_chunks", T.IntegerType()).add(
        "n_removed_lines", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, n_chunks, n_lines = [], [], []
            for text, parts in zip(b.column("text").to_pylist(), b.column("__parts").to_pylist()):
                lost, lines, gone = set(), text.split("\n") if parts else [], 0
                for p in parts or ():
                    if "\n".join(lines[p["line"]:p["end"]]) == p["chunk"]:
                        lost.update(p["gone"])
                        gone += 1
                out.append("\n".join([x for i, x in enumerate(lines) if i not in lost]) if gone else text)
                n_chunks.append(gone)
                n_lines.append(len(lost))
            cols = {"text": pa.array(out, pa.string()), "n_removed_chunks": pa.array(n_chunks, pa.int32()),
                    "n_removed_lines": pa.array(n_lines, pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [cols[n] if n in cols else b.column(n) for n in schema.names], names=schema.names)

    return map_in_arrow(joined.select(*names, "__parts"), run, schema)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that dedup by all sets leaves."""
    return dedup(docs, SETS).select(*docs.columns)
