"""Operator 11 against a tree made by hand."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postlens.llm import merkle_manifest

from llm_help import awkward, none, same  # noqa: F401


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(doc, text):
    values = [doc["doc_id"], doc["source"], doc["lang"], doc["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels of nodes, from the leaves to the top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + 8])))
        at //= 8
    return out


def manifest_by_hand(docs):
    groups = defaultdict(list)
    for d in docs:
        groups[d["lang"]].append((d["doc_id"] is not None, d["doc_id"] or 0, leaf_by_hand(d, d["text"]), d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(rows, key=lambda x: x[:3])]) for g, rows in groups.items()}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (_, _, leaf, d) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = path(trees[g], at) + path(top, k)
            node = leaf
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0 and d["text"] is not None:
                node = leaf_by_hand(d, re.sub("[A-Z]", lambda m: m[0].lower(), d["text"]))
            for left, right in steps:
                node = sha(left + node + right)
            out.append((d["doc_id"], leaf, trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), node,
                        node == top[-1][0]))
    return out


def test_manifest(awkward, none):
    want = manifest_by_hand([r.asDict() for r in awkward.collect()])
    same(map(tuple, merkle_manifest.digests(awkward).collect()), want)
    assert {x[-1] for x in want} == {True, False}
    assert merkle_manifest.digests(none).count() == 0


def test_a_lone_document(awkward):
    one = awkward.where("doc_id = 301")
    row = merkle_manifest.digests(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == sha("")


@pytest.mark.parametrize("rows", [512, 513, 4700])
def test_blocks_and_rounds(spark, rows):
    """One group of several blocks, ten of one document, ids out of order."""
    docs = spark.range(rows).select(
        (F.col("id") * 7919 % 10007).alias("doc_id"), F.lit("s").alias("source"),
        F.when(F.col("id") < 10, F.concat(F.lit("l"), "id")).otherwise("en").alias("lang"),
        F.lit(5).cast("bigint").alias("n_chars"), F.concat(F.lit("Text "), "id").alias("text")).repartition(7)
    want = manifest_by_hand([r.asDict() for r in docs.collect()])
    same(map(tuple, merkle_manifest.digests(docs).collect()), want)


def test_paths_lead_to_the_root(awkward):
    """Columns of any name are kept beside the manifest's."""
    leaves = awkward.select("*", F.lit(1).alias("_pos"), F.lit(2).alias("_node"), F.lit(3).alias("items"),
                            merkle_manifest.leaf(F.col("text")).alias("h"))
    rows = merkle_manifest.manifest(leaves, "source", "doc_id", "h")
    assert set(leaves.columns) < set(rows.columns)
    assert rows.where(merkle_manifest.fold(F.col("h"), F.col("path")) != F.col("root")).count() == 0
    assert rows.where(merkle_manifest.fold(merkle_manifest.sha(F.col("h")), F.col("path")) == F.col("root")).count() == 0
    assert rows.select("root").distinct().count() == 1
