"""Minimax contiguous sharding, with DataFrame operations alone.

Documents with equal texts form an atomic group, groups are ordered by the
hash of their text, and each shard takes a run of consecutive groups.  The
smallest capacity for which ``shards`` runs are enough is found by binary
search; whether a capacity is enough is checked greedily (each shard takes
groups for as long as they fit), and the shards are cut where the greedy
check with that capacity cuts.

The greedy check needs running sums at a few places only.  The driver holds
the sums of intervals of the hash range, at first 4096 of them.  Where a cut
would fall inside an interval, that interval is split into 4096 smaller
ones by one aggregation on Spark, until it is a single group.  The driver
thus sees a few times 4096 sums however many groups there are, and a
document's shard follows from its text's hash and the cuts, row by row.

Slots number the rows of a shard from 0: first within buckets of a shard
(dealt by the document id), then bucket by bucket.

Defined results: a null text has no bytes and is in one group with the empty
text; rows with equal texts, repeated rows too, go to one shard; an empty
table gives an empty table; if there are fewer groups than shards, some
shards stay empty; other columns are ignored.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SPLIT_BITS = 12          # an interval is split into 2^12 parts
BATCH = 64               # intervals split by one aggregation
BUCKET_ROWS = 100_000
LEAST = -(1 << 63)


@dataclass
class Interval:
    """Groups with hashes from ``low`` on, up to the next interval."""
    low: int
    bits: int            # it spans 2^bits hashes
    size: int
    groups: int


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, group_hash); size: bytes of the text plus 1."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64(text).alias("group_hash"))


class Sums:
    """Sizes of the groups by intervals of their hash, as fine as needed."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.largest = groups.agg(F.max("size")).first()[0] or 0
        self.parts = self._split([Interval(LEAST, 64, 0, 0)])
        self.total = sum(p.size for p in self.parts)

    def _split(self, wide: list[Interval]) -> list[Interval]:
        """The non-empty parts of some intervals."""
        rows: list[Interval] = []
        by_width: dict[int, list[Interval]] = {}
        for w in wide:
            by_width.setdefault(w.bits, []).append(w)
        for bits, same in by_width.items():
            inside = F.lit(bits == 64)
            if bits < 64:
                for w in same:
                    inside |= F.col("group_hash").between(w.low, w.low + (1 << bits) - 1)
            shift = max(bits - SPLIT_BITS, 0)
            for r in self.groups.where(inside).groupBy(
                    F.shiftright("group_hash", shift).alias("part")).agg(
                    F.sum("size").alias("size"), F.count("*").alias("groups")).collect():
                rows.append(Interval(r["part"] << shift, shift, r["size"], r["groups"]))
        return sorted(rows, key=lambda p: p.low)

    def refine(self, wanted: list[Interval]) -> None:
        wanted = wanted[:BATCH]
        drop = {id(w) for w in wanted}
        kept = [p for p in self.parts if id(p) not in drop]
        self.parts = sorted(kept + self._split(wanted), key=lambda p: p.low)

    def greedy(self, capacity: int, shards: int):
        """(cuts, whether all groups are taken, intervals to split first).
        A cut is the hash at which the next shard begins.  With intervals to
        split, the cuts are not exact yet."""
        ends, total = [], 0
        for p in self.parts:
            total += p.size
            ends.append(total)
        cuts, taken, unclear = [], 0, []
        for _ in range(shards):
            at = bisect.bisect_right(ends, taken + capacity)
            if at == len(ends):
                return cuts, True, unclear
            if self.parts[at].groups > 1:
                unclear.append(self.parts[at])
            taken = ends[at] - self.parts[at].size
            cuts.append(self.parts[at].low)
        return cuts, False, unclear

    def exact(self, capacity: int, shards: int) -> tuple[list[int], bool]:
        while True:
            cuts, done, unclear = self.greedy(capacity, shards)
            if not unclear:
                return cuts, done
            self.refine(list({id(p): p for p in unclear}.values()))


def capacity_and_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity that ``shards`` runs of groups need, and the
    hashes at which the second and later runs begin.  ``groups``:
    (group_hash, size), one row each."""
    sums = Sums(groups)
    low, high = max(sums.largest, -(-sums.total // shards)), sums.largest + -(-sums.total // shards)
    while low < high:
        middle = (low + high) // 2
        if sums.exact(middle, shards)[1]:
            high = middle
        else:
            low = middle + 1
    return low, sums.exact(low, shards)[0]


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document."""
    rows = materialize(sized(docs), "sized")
    groups = materialize(rows.groupBy("group_hash").agg(F.sum("size").alias("size")), "groups")
    _, cuts = capacity_and_cuts(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("group_hash") >= cut).cast("int")
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                  -(-rows.count() // BUCKET_ROWS))
    order = ["group_hash", "doc_id", "text_crc32"]
    dealt = rows.withColumn("shard", shard).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "group_hash"), F.lit(buckets)).cast("int"))
    own = Window.partitionBy("shard", "bucket").orderBy(*order)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return dealt.withColumn("turn", F.row_number().over(own)).join(earlier, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("earlier") + F.col("turn") - 1).alias("slot"))


def digests(docs: DataFrame, shards: int) -> DataFrame:
    return assign(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
