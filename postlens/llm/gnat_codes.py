"""Vector codes (product quantisation) with the nearest entries found through
a GNAT over each codebook.

Vectors are scaled to integers and cut into parts; each part position has a
codebook of integer entries, and a vector's code names the nearest entry of
each part.  A codebook's GNAT has a few split points among its entries; every
other entry is the child of its nearest split point.  For each pair of split
points i, j it stores the range of the distances from i to the entries of j's
child set.  A part's distances to the split points then exclude, by the
triangle inequality, every child set that lies wholly farther away than the
best distance found so far: for some i, the range to i is out of reach.  Only
sets *strictly* out of reach are left out, with the ranges and distances
rounded to the safe side, and what remains is compared by integer squared
distances, so ties go to the smaller index exactly.

Codebooks are bounded by parameters (entries times dimensions); they go to
the tasks with the code and come back as summed rows of the same bound.

Defined results: a vector that is null or holds null or non-finite
components, or components too large for a long once scaled, takes no part;
other lengths than the table's are brought to the longest, which is rounded up
to a multiple of the parts, by zeros (an empty vector is all zeros); the seeds
are the rows with the smallest ids, equal ids by their vectors, null ids last;
with fewer rows than entries there are as many entries as rows; repeated rows
come back each with the same code; an empty table gives an empty table; other
columns are kept by ``encode`` (the output's own names win).  Sums beyond the
exact range of 64-bit integers are taken in Python integers; an error above a
long's range is null, and so is the error of its label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import map_in_arrow

SPLITS = 8                      # split points of a codebook's GNAT
SAFE = 1 << 20                  # smaller components: squares and sums fit 64 bits
ROWS = 4096                     # vectors encoded at once


# -- integer vectors --------------------------------------------------------------

def scaled(rows: DataFrame, vector: str, factor: int, into: str) -> DataFrame:
    """``rows`` with ``into``, the floors of the scaled components, where all
    of them are finite; other rows are left out."""
    v = F.col(vector)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))
    fits = ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double"))
                     | (F.abs(x.cast("double")) * F.lit(float(factor)) >= F.lit(2.0 ** 63)))
    return rows.where(v.isNotNull() & fits).withColumn(into, whole)


def matrix(column: pa.Array, dim: int, kind) -> np.ndarray:
    """The integer vectors of an Arrow list column, with zeros up to ``dim``."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy()
    out = np.zeros((len(ends), dim), kind)
    if (ends == dim).all():
        out[:] = flat.reshape(len(ends), dim)
    else:
        start = np.r_[0, np.cumsum(ends)]
        for i, n in enumerate(ends):
            out[i, :n] = flat[start[i]:start[i] + n]
    return out


# -- GNAT ----------------------------------------------------------------------------

def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer squared distances of all rows of ``a`` to all rows of ``b``."""
    d = a[:, None, :] - b[None, :, :]
    return (d * d).sum(axis=2)


def _root(square: np.ndarray, up: bool) -> np.ndarray:
    """Distances, surely not below (above) the true ones."""
    return np.sqrt(square.astype(np.float64)) * (1 + 1e-12 if up else 1 - 1e-12)


class Gnat:
    """Exact nearest entries of one codebook."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS):
        self.entries = entries
        self.size = len(entries)
        # split points far from each other: each the farthest from those before
        chosen = [0]
        apart = squares(entries, entries[:1])[:, 0]
        while len(chosen) < min(splits, self.size):
            at = int(apart.argmax())
            if not apart[at]:
                break
            chosen.append(at)
            apart = np.minimum(apart, squares(entries, entries[at:at + 1])[:, 0])
        self.splits = np.array(chosen, np.int64)
        others = np.setdiff1d(np.arange(self.size), self.splits)
        between = squares(entries, entries[self.splits])       # entry x split
        child = between[others].argmin(axis=1) if len(others) else others
        self.children = [others[child == j] for j in range(len(chosen))]
        far = (len(chosen), len(chosen))
        self.low, self.high = np.zeros(far), np.zeros(far)      # from split i to the set of j
        for j, of_j in enumerate(self.children):
            if len(of_j):
                self.low[:, j] = _root(between[of_j].min(axis=0), up=False)
                self.high[:, j] = _root(between[of_j].max(axis=0), up=True)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of each row's nearest entry, ties to the
        smaller index, and the number of distances computed."""
        size = self.size
        square = squares(parts, self.entries[self.splits])
        # distance and index in one integer, so that the least is the answer
        best = (square * size + self.splits).min(axis=1)
        done = square.size
        low, high = _root(square, up=False), _root(square, up=True)
        for j in np.argsort([-len(c) for c in self.children], kind="stable"):
            of_j = self.children[j]
            if not len(of_j):
                continue
            reach = _root(best // size, up=True)
            gap = np.maximum(low - self.high[:, j], self.low[:, j] - high).max(axis=1)
            near = np.flatnonzero(gap <= reach)
            if len(near):
                found = squares(parts[near], self.entries[of_j])
                done += found.size
                best[near] = np.minimum(best[near], (found * size + of_j).min(axis=1))
        return (best % size).astype(np.int64), best // size, done


# -- codebooks ------------------------------------------------------------------------

class Codec:
    """Codebooks of all part positions: an array (part, entry, component)."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.trees = [Gnat(b) for b in books]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Entry index and squared distance of each vector and part."""
        n, parts, width = len(vectors), len(self.books), self.books.shape[2]
        index, error, done = np.zeros((n, parts), np.int64), np.zeros((n, parts), self.books.dtype), 0
        for p, tree in enumerate(self.trees):
            index[:, p], error[:, p], k = tree.nearest(vectors[:, p * width:(p + 1) * width])
            done += k
        return index, error, done

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.books.ravel()).encode()).hexdigest()


def first_codec(vectors: DataFrame, order: str, vector: str, parts: int, entries: int) -> Codec | None:
    """Codebooks from the vectors of the rows that come first."""
    shape = vectors.agg(F.max(F.size(vector)).alias("dim"), F.max(F.aggregate(
        vector, F.lit(0).cast("bigint"), lambda a, x: F.greatest(a, x, -x))).alias("most")).first()
    if shape["dim"] is None:
        return None
    seeds = [r[0] for r in vectors.orderBy(F.col(order).asc_nulls_last(), vector).limit(entries).select(vector).collect()]
    width = max(-(-shape["dim"] // parts), 1)
    kind = np.int64 if max(shape["most"], entries << 8, width * parts << 8) < SAFE else object
    rows = np.zeros((len(seeds), parts * width), kind)
    for i, s in enumerate(seeds):
        rows[i, :len(s)] = s
    return Codec(np.ascontiguousarray(rows.reshape(len(seeds), parts, width).transpose(1, 0, 2)))


def refined(codec: Codec, vectors: DataFrame, vector: str) -> Codec:
    """One round: each entry becomes the floor of the mean of its parts.  A
    partition puts out one row per entry and component at most."""
    parts, entries, width = codec.books.shape
    kind = codec.books.dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((parts, entries, width), kind), np.zeros((parts, entries), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                v = matrix(whole.column(0).slice(at, ROWS), parts * width, kind)
                index, _, _ = codec.assign(v)
                for p in range(parts):
                    np.add.at(sums[p], index[:, p], v[:, p * width:(p + 1) * width])
                    count[p] += np.bincount(index[:, p], minlength=entries)
        p, e = np.nonzero(count)
        at = np.repeat((p * entries + e)[:, None] * width, width, axis=1) + np.arange(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.ravel(), pa.int64()), pa.array([str(x) for x in sums[p, e].ravel()], pa.string()),
             pa.array(np.repeat(count[p, e], width), pa.int64())], names=["at", "sum", "n"])

    found = map_in_arrow(vectors.select(vector), run, "at bigint, sum string, n bigint").groupBy("at").agg(
        F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n"))
    books = codec.books.copy()
    for r in found.collect():                  # at most entries x components rows
        books.reshape(-1)[r["at"]] = int(r["sum"]) // r["n"]
    return Codec(books)


def trained(vectors: DataFrame, order: str, vector: str, parts: int, entries: int, rounds: int) -> Codec | None:
    codec = first_codec(vectors, order, vector, parts, entries)
    for _ in range(rounds if codec else 0):
        codec = refined(codec, vectors, vector)
    return codec


def encode(codec: Codec, vectors: DataFrame, vector: str) -> DataFrame:
    """The columns of ``vectors`` but the vector, with ``code`` (one byte per
    part, or two from 256 entries on), ``error`` (summed squared distances) and
    ``n_distances`` (distances computed for the row's batch, per row)."""
    parts, _, width = codec.books.shape
    kind, code = codec.books.dtype, "u1" if codec.books.shape[1] <= 256 else ">u2"
    own = ("code", "error", "n_distances")
    others = [c for c in vectors.columns if c != vector and c not in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                index, error, done = codec.assign(matrix(b.column(vector), parts * width, kind))
                total = [int(x) for x in error.sum(axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in others],
                     pa.array([r.tobytes() for r in index.astype(code)], pa.binary()),
                     pa.array([x if x < 1 << 63 else None for x in total], pa.int64()),
                     pa.array(np.full(b.num_rows, done // max(b.num_rows, 1)), pa.int64())],
                    names=[*others, *own])

    schema = StructType([vectors.schema[c] for c in others] + [
        StructField("code", BinaryType()), StructField("error", LongType()), StructField("n_distances", LongType())])
    return map_in_arrow(vectors.select(*others, vector), run, schema)


def decoded(codec: Codec, code: bytes) -> list[int]:
    """The integer vector that a code stands for."""
    index = np.frombuffer(code, "u1" if codec.books.shape[1] <= 256 else ">u2")
    return [int(x) for p, e in enumerate(index) for x in codec.books[p, e]]


def digests(rows: DataFrame, parts: int, entries: int, rounds: int, factor: int) -> DataFrame:
    """Codes in hexadecimal, errors, their sums over equal labels, and the hash
    of the codebooks."""
    v = scaled(rows, "embedding", factor, "_v").select(F.col("vec_id"), F.col("label"), "_v")
    codec = trained(v, "vec_id", "_v", parts, entries, rounds)
    schema = StructType([rows.schema["vec_id"], StructField("code", StringType()), StructField("error", LongType()),
                         StructField("label_error", LongType()), StructField("codebooks_sha256", StringType()),
                         StructField("n_distances", LongType())])
    if codec is None:
        return rows.sparkSession.createDataFrame([], schema)
    coded = encode(codec, v, "_v")
    same = [F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("_label")]
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    sums = coded.groupBy(*same).agg(F.when(F.count("error") == F.count("*"), total).alias("label_error"))
    return coded.withColumn("_label", same[0]).join(sums, "_label").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codec.sha256()).alias("codebooks_sha256"), "n_distances")
