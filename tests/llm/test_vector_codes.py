"""Operator 13 against brute force in Python integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import gnat_codes

from llm_help import same


def nearest(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))


def codes_by_hand(rows, parts, entries, rounds, factor):
    kept = [(i, label, [math.floor(float(x) * factor) for x in v]) for i, label, v in rows
            if v is not None and all(x is not None and math.isfinite(x) and abs(x) * factor < 2 ** 63 for x in v)]
    width = max(-(-max(len(v) for _, _, v in kept) // parts), 1)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = [[(v + [0] * (parts * width))[p * width:(p + 1) * width] for p in range(parts)]
           for v in (list(v) for _, _, v in kept)]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = defaultdict(list)
            for v in cut:
                own[nearest(v[p], book)[1]].append(v[p])
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else book[e]
                        for e in range(len(book))]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    error = [sum(d for d, _ in f) for f in found]
    label_error = defaultdict(int)
    for (_, label, _), e in zip(kept, error):
        label_error[label] += e
    def long(x):
        return x if x < 2 ** 63 else None

    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for _, e in f), long(err), long(label_error[label]), sha)
            for (i, label, _), f, err in zip(kept, found, error)]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, label bigint, embedding array<float>").select(
        "*", *[F.lit(1).alias(c) for c in ("code", "error", "_v", "_label", "n_distances")]).repartition(5)


@pytest.fixture(scope="module")
def vectors():
    """Ties on a coarse grid, repeats, nulls, bad components, other lengths."""
    r = np.random.default_rng(1)
    rows = [(int(i) * 7 % 400, int(r.integers(0, 3)) if i % 5 else None,
             (r.integers(-6, 7, 32) / 256).astype(np.float32).tolist()) for i in range(400)]
    rows += [rows[3], rows[3], (1, None, None), (2, 1, []), (3, 1, [float("nan")] * 32), (4, 1, [float("inf")] * 32),
             (5, 1, [None] * 32), (6, 2, [0.25] * 7), (None, 1, [0.5] * 32), (None, None, None), (7, 1, [3e38] * 32)]
    return rows


@pytest.mark.parametrize("entries", [64, 5, 1])
def test_codes(spark, vectors, entries):
    got = gnat_codes.digests(table(spark, vectors), 16, entries, 2, 256).drop("n_distances")
    same(map(tuple, got.collect()), codes_by_hand(vectors, 16, entries, 2, 256))


def test_fewer_rows_than_entries_and_none(spark, vectors):
    few = vectors[:9]
    got = gnat_codes.digests(table(spark, few), 16, 64, 2, 256).drop("n_distances")
    same(map(tuple, got.collect()), codes_by_hand(few, 16, 64, 2, 256))
    assert gnat_codes.digests(table(spark, vectors).where("false"), 16, 64, 2, 256).count() == 0
    assert gnat_codes.digests(table(spark, [(1, 1, None)]), 16, 64, 2, 256).count() == 0


def test_large_components_are_exact(spark):
    r = np.random.default_rng(2)
    rows = [(i, i % 2, (r.random(16) * 10.0 ** (i % 9)).astype(np.float32).tolist()) for i in range(120)]
    got = gnat_codes.digests(table(spark, rows), 16, 8, 2, 256).drop("n_distances")
    same(map(tuple, got.collect()), codes_by_hand(rows, 16, 8, 2, 256))


@pytest.mark.parametrize("spread", [3, 50, 4000])
def test_gnat_leaves_nothing_nearer_out(spread):
    """Close grids have many ties; wide ones let whole sets be left out."""
    r = np.random.default_rng(spread)
    centres = r.integers(-spread, spread + 1, (6, 4))
    entries = (centres[r.integers(0, 6, 64)] + r.integers(-2, 3, (64, 4))).astype(np.int64)
    parts = (centres[r.integers(0, 6, 3000)] + r.integers(-3, 4, (3000, 4))).astype(np.int64)
    index, error, done = gnat_codes.Gnat(entries).nearest(parts)
    every = gnat_codes.squares(parts, entries)
    assert (error == every.min(axis=1)).all() and (index == every.argmin(axis=1)).all()
    assert done <= every.size and (spread < 4000 or done < 0.6 * every.size)
    same_index, same_error, _ = gnat_codes.Gnat(entries.astype(object)).nearest(parts.astype(object))
    assert (same_index == index).all() and (same_error == error).all()


def test_codes_decode_to_entries(spark, vectors):
    v = gnat_codes.scaled(table(spark, vectors[:400]), "embedding", 256, "whole")
    codec = gnat_codes.trained(v, "vec_id", "whole", 16, 64, 2)
    for r in gnat_codes.encode(codec, v.select("vec_id", "whole", F.col("whole").alias("kept")), "whole").collect():
        assert sum((a - b) ** 2 for a, b in zip(gnat_codes.decoded(codec, r["code"]), r["kept"])) == r["error"]
