"""Best-fit packing by a configuration linear program.

Documents become token sequences of at most ``capacity`` tokens.  Only a
longer document is cut, into pieces of full capacity and a last one.  How to
combine pieces depends on their lengths alone, and there are at most
``capacity`` lengths, so the plan is made from the length histogram:

1. The linear program chooses how often to use each *configuration* (a
   multiset of lengths that fits one sequence) so that all pieces are
   covered with the fewest sequences.  It is solved by multiplicative
   weights: each length has a price, the configuration worth most at these
   prices is found by a knapsack dynamic program, and the prices of what it
   covers go down.
2. The fractional solution is rounded down; the remaining pieces are put
   together longest first, each time filled as well as what remains allows
   (an exact subset sum), and such a filling is used as often as it can be.

Spark then ranks the pieces of each length, and a piece's rank says which
use of which configuration it takes.  Ranks are made in two steps (within
buckets, then bucket by bucket), so a length that a third of all pieces
share is spread over all tasks.

Defined results: a null or empty text has the closing id alone; repeated
rows are packed as documents of their own; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunked import word_level
from .common import map_in_arrow, materialize, texts

ROUNDS = 120          # rounds of multiplicative weights
RATE = 0.5            # how fast the price of a covered length falls
COLUMNS = 64          # configurations taken from one round's knapsack
NEARLY = 0.98         # of the optimum: what such a configuration must be worth
STEP = 0.25           # part of its scarcest length that one step uses
BUCKET_PIECES = 50_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id bigint, offset bigint"


# -- the plan: lengths only ---------------------------------------------------

def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity``: the worth of the best configuration
    that fits it, and one length of that (0: leave a token empty).
    ``lengths`` ascends."""
    worth, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        fit = int(np.searchsorted(lengths, room, "right"))
        if fit:
            values = worth[room - lengths[:fit]] + prices[:fit]
            best = int(values.argmax())
            if values[best] > worth[room]:
                worth[room], took[room] = values[best], lengths[best]
    return worth, took


def configuration(took: np.ndarray, room: int, first: int) -> dict[int, int]:
    """The best configuration that has ``first`` besides what fits ``room``."""
    config = {first: 1}
    while room:
        if n := int(took[room]):
            config[n] = config.get(n, 0) + 1
        room -= max(int(took[room]), 1)
    return config


def linear_program(count: dict[int, int], capacity: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often to use each, a fractional number.  No
    length is used more often than it occurs.

    A round prices the lengths, solves one knapsack, and takes from its
    table the best configurations through each of the least covered lengths,
    as long as they are worth nearly the optimum."""
    lengths = np.array(sorted(count), np.int64)
    demand = np.array([count[int(n)] for n in lengths], float)
    at = {int(n): i for i, n in enumerate(lengths)}
    covered = np.zeros(len(lengths))
    uses: dict[tuple, float] = {}
    for _ in range(ROUNDS):
        # a length's worth is the part of a sequence that it fills
        prices = lengths / capacity * np.exp(-RATE * covered / demand)
        worth, took = knapsack(lengths, prices, capacity)
        through = prices + worth[capacity - lengths]
        least = np.argsort(covered / demand, kind="stable")[:COLUMNS]
        for i in least[through[least] >= NEARLY * worth[capacity]]:
            n = int(lengths[i])
            config = configuration(took, capacity - n, n)
            step = min(demand[at[m]] / k for m, k in config.items()) * STEP
            for m, k in config.items():
                covered[at[m]] += step * k
            key = tuple(sorted(config.items()))
            uses[key] = uses.get(key, 0.0) + step
    over = np.maximum(covered / demand, 1.0)
    return [(dict(c), x / max(over[at[n]] for n, _ in c)) for c, x in uses.items()]


def best_fill(left: dict[int, int], room: int) -> dict[int, int]:
    """Pieces out of ``left`` (length: how many) that fill ``room`` best."""
    reach, steps = 1, []
    mask = (1 << room + 1) - 1
    for n in sorted((n for n in left if n <= room), reverse=True):
        many, k = min(left[n], room // n), 1
        while many:
            k = min(k, many)
            steps.append((n, k, reach))
            reach |= reach << n * k & mask
            many -= k
            k *= 2
        if reach >> room & 1:
            break
    total, fill = reach.bit_length() - 1, {}
    for n, k, before in reversed(steps):
        if not before >> total & 1:
            fill[n] = fill.get(n, 0) + k
            total -= n * k
    return fill


def plan(count: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(configuration, how many sequences)] that hold exactly the pieces
    counted in ``count`` ({length: pieces})."""
    made: list[tuple[dict[int, int], int]] = []
    left = {n: c for n, c in count.items() if c}
    if full := left.pop(capacity, 0):
        made.append(({capacity: 1}, full))
    if left:
        for config, x in linear_program(left, capacity):
            times = min(int(x + 1e-9), *(left.get(n, 0) // k for n, k in config.items()))
            if times > 0:
                made.append((config, times))
                for n, k in config.items():
                    left[n] -= k * times
    left = {n: c for n, c in left.items() if c}
    while left:
        longest = max(left)
        left[longest] -= 1
        config = best_fill({n: c for n, c in left.items() if c}, capacity - longest)
        left[longest] += 1
        config[longest] = config.get(longest, 0) + 1
        times = min(left[n] // k for n, k in config.items())
        made.append((config, times))
        for n, k in config.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return made


def slots(made: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by length: from which rank on pieces of a length go to which
    sequences.  ``key`` is length << 40 | first rank, ascending."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for config, times in made:
        offset = 0
        for n in sorted(config, reverse=True):
            first = taken.get(n, 0)
            rows.append((n << 40 | first, sequence, config[n], offset))
            taken[n] = first + times * config[n]
            offset += n * config[n]
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("key", "sequence", "many", "offset"), table.T))


# -- the Spark side ------------------------------------------------------------

def pieces(docs: DataFrame, vocab: str, end_id: int, capacity: int,
           keep_ids: bool = False) -> DataFrame:
    """The pieces of every whole text: ``PIECE_SCHEMA``, and with
    ``keep_ids`` also ``ids`` (binary, little-endian unsigned 32 bits)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = PIECE_SCHEMA + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = word_level(vocab), np.asarray([end_id], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                rows = []
                for doc, ids in zip(b.column("doc_id").to_pylist(), coder(texts(b.column("text")))):
                    ids += end
                    for k, i in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[i:i + 4 * capacity]
                        rows.append((doc, k, i // 4, len(cut) // 4, zlib.crc32(cut), cut))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
                cols = list(zip(*rows))[:6 if keep_ids else 5]
                if cols:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, types)], names=names[:len(cols)])

    return map_in_arrow(docs, run, schema)


def ranked(parts: DataFrame, rows: int) -> DataFrame:
    """Add ``rank``: the place of a piece among those of its length, from 0."""
    buckets = max(1, rows // BUCKET_PIECES,
                  int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = parts.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    own = Window.partitionBy("bucket", "length")
    local = dealt.withColumn("in_bucket", F.row_number().over(
        own.orderBy("doc_id", "piece", "ids_crc32")) - 1)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = dealt.groupBy("bucket", "length").agg(F.count("*").alias("n")).select(
        "bucket", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return local.join(sums, ["bucket", "length"]).withColumn(
        "rank", F.col("earlier") + F.col("in_bucket")).drop("bucket", "in_bucket", "earlier")


def pack(parts: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of ``PIECE_SCHEMA``.  The
    histogram (at most ``capacity`` rows) is all that the driver sees."""
    spark = parts.sparkSession
    count = {r["length"]: r["n"] for r in
             parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(count, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in ("length", "rank"))
            at = np.searchsorted(t["key"], length << 40 | rank, "right") - 1
            turn = rank - (t["key"][at] & (1 << 40) - 1)
            many = t["many"][at]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(t["sequence"][at] + turn // many),
                 pa.array(t["offset"][at] + turn % many * length)],
                names=[c.split()[0] for c in PACKED_SCHEMA.split(", ")])

    return map_in_arrow(ranked(parts, sum(count.values())).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "rank"), run, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, vocab: str, end_id: int, capacity: int) -> DataFrame:
    """Tokenise once, keep the pieces' measures, pack."""
    return pack(materialize(pieces(docs, vocab, end_id, capacity), "pieces"), capacity)


def sequences(packed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """The token sequences themselves: (sequence_id, ids as binary), from
    ``pack``'s rows and the pieces made with ``keep_ids``."""
    keys = ["doc_id", "piece", "ids_crc32"]
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("length"))
    rows = packed.withColumn("copy", n).alias("p").join(
        with_ids.select(*keys, "ids", n.alias("copy")).alias("i"),
        [F.col(f"p.{k}").eqNullSafe(F.col(f"i.{k}")) for k in [*keys, "copy"]])
    return rows.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, X'', (a, p) -> a || p.ids)").alias("ids"))
