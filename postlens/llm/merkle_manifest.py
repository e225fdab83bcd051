"""Merkle manifest of a dataset, kept as concatenated level strings.

A leaf is the hash of a document's fields.  The leaves of one group (a
language) stand in ascending order of their key; eight consecutive nodes make
a parent, until one node is left, the group's subroot.  The subroots, in
order of their group, make the root in the same way.

Nodes are kept in aligned blocks of 512 consecutive positions.  Each of a
block's three levels is one string of hexadecimal digests, 64 characters
each: a parent hashes the substring of its eight children, and the siblings
of a node are the two substrings that flank it in its parent's.  The blocks'
top nodes are the next round's nodes, so each round takes three levels and
leaves one row where it found up to 512; no step holds more than a block.

Positions are found without a window over a group: the leaves are dealt by
ranges of (group, key), sorted and written, and each range's rows are shifted
by the counts of the ranges before it.

Defined results: a null field is the text ``-``; a null group is a group of
its own, before all others; null keys come first in their group; equal keys
stand in the order of their digests, so repeated rows have places of their
own beside each other and the same leaf; the siblings of a lone node are the
empty text; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FANOUT = 8
DIGEST = 64                     # characters of a digest
RUN = FANOUT * DIGEST           # characters of a parent's children
LEVELS = 3                      # levels in a block
BLOCK = FANOUT ** LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(*values: Column) -> Column:
    """Hash of the values, each with its length in bytes before it."""
    texts = [v.cast("string") for v in values]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                          for t in texts]))


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf and its path of flanking siblings lead to."""
    return F.aggregate(path, node, lambda a, s: sha(F.concat(s["left"], a, s["right"])))


def siblings(path: Column) -> Column:
    """All siblings of a path, from the leaf's level to the root's."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _group_name(group: Column) -> Column:
    """Orders as the group does, nulls first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


# -- positions ----------------------------------------------------------------------

def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (written before, with ``_grp``) with ``_pos``, the place in the
    group, and ``_n``, the group's size."""
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["_grp", *order, "_tie"]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("_range", F.shiftright("_at", 33))    # the range's number
    ranges = placed.groupBy("_grp", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    group = Window.partitionBy("_grp")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.select("_grp", "_range", F.sum("_rows").over(group).alias("_n"),
                           (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (placed.join(shifts, ["_grp", "_range"]).withColumn("_pos", F.col("_at") + F.col("_shift"))
            .drop("_at", "_range", "_shift"))


# -- levels ---------------------------------------------------------------------------

def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / RUN).cast("int"))
    return F.array_join(F.transform(runs, lambda i: sha(F.substring(level, i * RUN + 1, F.lit(RUN)))), "")


def _blocks(nodes: DataFrame, carry: list[str]) -> DataFrame:
    """One row per block of (_grp, _pos, _n, _node, carry): its items in order
    and its levels ``l0`` to ``l3`` (null above the group's only node)."""
    items = F.array_sort(F.collect_list(F.struct("_pos", "_node", *carry)))
    out = nodes.groupBy("_grp", F.floor(F.col("_pos") / BLOCK).alias("_block"), "_n").agg(items.alias("items"))
    out = out.withColumn("l0", F.array_join(F.transform("items", lambda x: x["_node"]), ""))
    for k in range(LEVELS):
        out = out.withColumn(f"l{k + 1}", F.when(F.col("_n") > FANOUT ** k, _parents(F.col(f"l{k}"))))
    return out


def _flanks(i: Column) -> Column:
    """Siblings of the block's item ``i``, level by level, as substrings of the
    level strings."""
    steps = []
    for k in range(LEVELS):
        at = F.floor(i / FANOUT ** k).cast("int")
        run = F.substring(F.col(f"l{k}"), F.floor(at / FANOUT).cast("int") * RUN + 1, F.lit(RUN))
        own = at % FANOUT * DIGEST
        steps.append(F.when(F.col(f"l{k + 1}").isNotNull(), F.struct(
            F.substring(run, F.lit(1), own).alias("left"),
            F.substring(run, own + DIGEST + 1, F.lit(RUN)).alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def climb(nodes: DataFrame, carry: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of every round, from the nodes up, and the top node
    of each group: (_grp, _node)."""
    rounds = []
    while True:
        blocks = materialize(_blocks(nodes, carry), "blocks")
        rounds.append(blocks)
        nodes = blocks.select("_grp", F.col("_block").alias("_pos"),
                              F.ceil(F.col("_n") / BLOCK).alias("_n"),
                              F.coalesce(*[f"l{k}" for k in range(LEVELS, -1, -1)]).alias("_node"))
        carry = []
        if (nodes.agg(F.max("_n")).first()[0] or 0) <= 1:
            return rounds, nodes.select("_grp", "_node")


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The path of every node of the first round: its flanking siblings up to
    its group's top node, then those of ``tops`` (_grp, _path, more)."""
    more = [c for c in tops.columns if c not in ("_grp", "_path")]
    down = tops.withColumn("_block", F.lit(0).cast("bigint"))
    for k, blocks in enumerate(reversed(rounds)):
        met = blocks.join(down, ["_grp", "_block"])
        items = F.transform("items", lambda x, i: F.struct(
            x.alias("item"), F.concat(_flanks(i), F.col("_path")).alias("_path")))
        rows = met.select("_grp", *more, F.inline(items))
        if k < len(rounds) - 1:
            down = rows.select("_grp", *more, "_path", F.col("item._pos").alias("_block"))
    return rows.select("_grp", *more, "_path", "item.*")


# -- manifest ---------------------------------------------------------------------------

def manifest(leaves: DataFrame, group: str, key: str, node: str) -> DataFrame:
    """All columns of ``leaves`` with ``subroot``, ``root`` and ``path``, the
    array of (left, right) sibling texts from the leaf to the root."""
    carry = [c for c in leaves.columns if c != node]
    safe = {c: f"c{i}_" for i, c in enumerate(carry)}
    rows = materialize(leaves.select(_group_name(F.col(group)).alias("_grp"), F.col(node).alias("_node"),
                                     *[F.col(c).alias(s) for c, s in safe.items()]), "leaves")
    rounds, subroots = climb(numbered(rows, [safe[key], "_node"]), list(safe.values()))
    subroots = materialize(subroots, "subroots")
    # the subroots are the nodes of one more tree
    top = numbered(subroots.select(F.lit("").alias("_grp"), F.col("_grp").alias("_name"), "_node"), ["_name"])
    top_rounds, root = climb(top, ["_name"])
    empty = F.array().cast("array<struct<left:string,right:string>>")
    above = descend(top_rounds, root.select("_grp", F.col("_node").alias("_root"), empty.alias("_path")))
    above = above.select(F.col("_name").alias("_grp"), "_root", F.col("_node").alias("_subroot"), "_path")
    out = descend(rounds, above)
    return out.select(*[F.col(s).alias(c) for c, s in safe.items()], F.col("_node").alias(node),
                      F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
                      F.col("_path").alias("path"))


def digests(docs: DataFrame) -> DataFrame:
    """The manifest's rows with the hash of their proofs, and the verdict on
    texts of which every third or so was lower-cased after the manifest was
    made."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    told = F.when(changed, leaf(*[F.col(c) if c != "text" else F.translate("text", upper, upper.lower())
                                  for c in FIELDS]))
    leaves = docs.select("doc_id", "lang", leaf(*[F.col(c) for c in FIELDS]).alias("leaf"), told.alias("told"))
    rows = manifest(leaves, "lang", "doc_id", "leaf")
    rows = rows.select("doc_id", "leaf", "subroot", "root", sha(siblings(F.col("path"))).alias("proof_sha256"),
                       fold(F.coalesce("told", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
