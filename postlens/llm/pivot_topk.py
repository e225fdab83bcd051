"""Exact top-k by inner product with a pivot table.

The distances of every vector to the pivots are computed once.  For a query,
the triangle inequality gives each candidate a lower bound on its distance
from each pivot; the largest of these is kept.  Since
``2 q.v = |q|^2 + |v|^2 - |q - v|^2``, it is an upper bound on the score.
Candidates are evaluated in the order of their bounds until the next bound
is below the k-th score found, so the result is exact, ties included.

Queries and candidates are dealt into blocks by a hash of their id.  Each
pair of a query block and a candidate block is one group of bounded size; a
group gives at most k rows per query, and the k best of all groups remain.
The pivots are a documented, bounded sample: the ``PIVOTS`` vectors whose
ids have the smallest hashes.

Defined results: vectors that are null, empty, or hold null, NaN or infinite
components, and rows without an id, take no part; a shorter vector counts as
filled up with zeros; a candidate with the query's id is its own row; a
repeated query is asked once, repeated candidates are each candidates; ties
go to the smaller id; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_in_arrow, ship

PIVOTS = 32
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
FIRST = 64           # candidates evaluated before the first threshold

VECTORS = "vec_id bigint, vector binary"
FOUND = "query_id bigint, vec_id bigint, score bigint"


def scaled(rows: DataFrame, factor: int) -> DataFrame:
    """(vec_id, vector): floor(factor * component) as little-endian 64-bit
    integers, for the vectors that take part.  Components beyond 2^53 in
    magnitude after scaling have no exact integer in a double; they are
    taken as that double."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for i, v in zip(b.column("vec_id").to_pylist(), b.column("embedding").to_pylist()):
                if i is None or not v or None in v:
                    continue
                x = np.floor(np.asarray(v, np.float64) * factor)
                if np.isfinite(x).all() and (np.abs(x) < 2.0 ** 63).all():
                    ids.append(i)
                    out.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                             names=["vec_id", "vector"])

    return map_in_arrow(rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"),
                        run, VECTORS)


def _matrix(column, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    for k, v in enumerate(column.to_pylist()):
        x = np.frombuffer(v, "<i8")
        out[k, :len(x)] = x
    return out


def _exact_type(*matrices: np.ndarray):
    """The quickest type in which inner products of these are exact."""
    largest = max((int(np.abs(m).max(initial=0)) for m in matrices), default=0)
    most = largest * largest * max(m.shape[1] for m in matrices)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def search(query_ids, queries, ids, vectors, pivots, k: int) -> list[tuple]:
    """The k best candidates of each query in one block, as (query_id,
    vec_id, score)."""
    kind = _exact_type(queries, vectors)
    p, v, q = (m.astype(np.float64) for m in (pivots, vectors, queries))
    table = np.sqrt(np.maximum((v * v).sum(1)[:, None] - 2 * v @ p.T + (p * p).sum(1), 0)).T.copy()
    to_query = np.sqrt(np.maximum((q * q).sum(1)[:, None] - 2 * q @ p.T + (p * p).sum(1), 0))
    v_norm, q_norm = (v * v).sum(1), (q * q).sum(1)
    # far more than the rounding of the distances
    slack = 1e-6 * (1 + float(v_norm.max(initial=0)) + float(q_norm.max(initial=0))
                    + float((p * p).sum(1).max(initial=0)))
    values, asked = vectors.astype(kind), queries.astype(kind)
    out = []
    for j, query_id in enumerate(query_ids):
        away = np.abs(table - to_query[j][:, None]).max(axis=0) if len(p) else np.zeros(len(v))
        bound = (q_norm[j] + v_norm - away * away) / 2 + slack
        bound[ids == query_id] = -np.inf
        order, at, step = None, 0, FIRST
        best = np.zeros(0, np.int64)
        scores = np.zeros(0, kind)
        threshold = -np.inf
        while True:
            if order is None:      # the first few without sorting all bounds
                n = min(step, len(bound))
                part = np.argpartition(-bound, n - 1)[:n] if n < len(bound) else np.arange(len(bound))
                rest = np.ones(len(bound), bool)
                rest[part] = False
            else:
                part = order[at:at + step]
                at, step = at + step, step * 2
                if not len(part) or bound[part[0]] < threshold:
                    break
                part = part[bound[part] >= threshold]
            part = part[bound[part] > -np.inf]
            best = np.concatenate([best, part])
            scores = np.concatenate([scores, values[part] @ asked[j]])
            if len(best) > k:
                keep = np.lexsort((ids[best], -scores))[:k] if kind is not object else np.array(
                    sorted(range(len(best)), key=lambda i: (-scores[i], ids[best[i]]))[:k])
                best, scores = best[keep], scores[keep]
            if len(best) == k:
                threshold = float(min(scores))
            if order is None:
                left = np.flatnonzero(rest & (bound >= threshold))
                order = left[np.argsort(-bound[left], kind="stable")]
        out += [(query_id, int(ids[i]), int(s)) for i, s in zip(best, scores)]
    return out


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score); both sides as ``scaled`` makes them."""
    spark = candidates.sparkSession
    rows = candidates.count()
    pivots = [r["vector"] for r in candidates.orderBy(
        F.xxhash64("vec_id"), "vec_id", "vector").limit(PIVOTS).collect()]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, -(-rows // CANDIDATE_BLOCK))
    asked = queries.dropDuplicates(["vec_id"])
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def block(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = candidates.withColumn("block", block(blocks)).withColumn("query_block", every(query_blocks))
    right = asked.withColumn("query_block", block(query_blocks)).withColumn("block", every(blocks))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and b.num_rows:
            columns = (a.column("vector"), b.column("vector"))
            dim = max(len(x) // 8 for x in [*pivots, *(x for c in columns for x in c.to_pylist())])
            found = search(b.column("vec_id").to_pylist(), _matrix(columns[1], dim),
                           a.column("vec_id").to_numpy(), _matrix(columns[0], dim),
                           _matrix(pa.array(pivots, pa.binary()), dim), k)
        cols = list(zip(*found)) or [()] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    ship(spark)
    keys = ("query_block", "block")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def search_table(rows: DataFrame, k: int, factor: int, every: int) -> DataFrame:
    """Top-k among all rows for the rows whose id is divisible by ``every``."""
    vectors = scaled(rows, factor)
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
