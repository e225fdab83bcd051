"""Keyed tables and the upserting stream, density curves."""

import datetime as dt
import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from postlens.operators import eda
from postlens.sources import keyed
from postlens.streaming import ingest

SCHEMA = "id string, n int, text string, at timestamp, seq int"


def day(d):
    return dt.datetime(2024, 1, d)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def files(path):
    return set(glob.glob(f"{path}/*/*.parquet"))


def test_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"), F.lit("x").alias("text"))
    keyed.create(base, path, "id", buckets=8)
    before = files(path)
    updates = spark.createDataFrame([("7", 2, 1), ("7", 3, 2), (None, 9, 3)], "id string, n int, seq int")
    assert keyed.upsert_into(path, updates, "id", ["n"], ["seq"]) == 1
    after = files(path)
    assert len({os.path.dirname(f) for f in before ^ after}) == 1
    want = sorted((str(i), 3 if i == 7 else 1, "x") for i in range(200))
    assert rows(keyed.read(spark, path), "id", "n", "text") == want
    keyed.upsert_into(path, updates, "id", ["n"], ["seq"])
    assert rows(keyed.read(spark, path), "id", "n", "text") == want
    more = spark.createDataFrame([("7", "y"), ("new", None)], "id string, extra string")
    keyed.upsert_into(path, more, "id", ["extra"])
    got = {r["id"]: (r["n"], r["text"], r["extra"]) for r in keyed.read(spark, path).collect()}
    assert len(got) == 201 and got["7"] == (3, "x", "y") and got["new"] == (None, None, None) and got["8"] == (1, "x", None)
    assert keyed.upsert_into(path, more.limit(0), "id", ["extra"]) == 0


def test_replace_into_replaces_whole_rows(spark, tmp_path):
    path = keyed.create(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, text string"),
                        str(tmp_path / "t"), "id", buckets=4)
    keyed.replace_into(path, spark.createDataFrame([("a", 5)], "id string, n int"), "id", F.lit(day(1)))
    got = {r["id"]: (r["n"], r["text"], r["last_updated"]) for r in keyed.read(spark, path).collect()}
    assert got == {"a": (5, None, day(1)), "b": (2, "y", None)}


def test_stream_upserts_with_late_rows_and_replay(spark, tmp_path):
    landed, table, late = (str(tmp_path / x) for x in ("in", "table", "late"))
    checkpoint = str(tmp_path / "checkpoint")

    def land(*data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(landed)

    def drain():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
        return {r["batch"]: r["late"] for r in ingest.run_upserts(
            stream, table, late, "id", ["n", "text"], "at", day(10), ["seq"], checkpoint).collect()}
    land(("a", 1, "one", day(11), 1), ("a", 2, "two", day(11), 2), ("old", 1, "late", day(9), 1))
    assert drain() == {0: 1}
    assert rows(keyed.read(spark, table), "id", "n", "text") == [("a", 2, "two")]
    land(("a", 3, None, day(12), 3), ("b", 1, "new", day(12), 1), ("b", 1, "new", day(12), 1), ("c", 1, "x", None, 1))
    assert drain() == {0: 1, 1: 1}
    want = [("a", 3, None), ("b", 1, "new")]
    key = lambda r: r[0]
    assert sorted(map(tuple, keyed.read(spark, table).select("id", "n", "text").collect()), key=key) == want
    # the last batch once more, as after a lost driver
    again = spark.createDataFrame([("a", 3, None, day(12), 3), ("b", 1, "new", day(12), 1), ("c", 1, "x", None, 1)], SCHEMA)
    ingest.upsert_batch(again, 1, table, late, "id", ["n", "text"], "at", day(10), ["seq"])
    assert sorted(map(tuple, keyed.read(spark, table).select("id", "n", "text").collect()), key=key) == want
    assert spark.read.schema(SCHEMA + ", batch long").parquet(late).count() == 2


def test_density_curve(spark):
    values = [float(i % 7) ** 2 for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values + [None, math.nan, math.inf]], "v double")
    got = sorted(map(tuple, eda.density_curve(df, "v", q=0.9, bins=4000).collect()))
    cut = sorted(values)[int(0.9 * 199)]
    kept = [v for v in values if v < cut]
    n, mean = len(kept), sum(kept) / len(kept)
    bw = math.sqrt(sum((v - mean) ** 2 for v in kept) / (n - 1)) * n ** -0.2
    assert [p for p, _, _ in got] == list(range(200)) and got[0][1] == 0.0 and got[-1][1] == max(kept)
    for _, x, d in got:
        want = sum(math.exp(-0.5 * ((x - v) / bw) ** 2) for v in kept) / (n * bw * math.sqrt(2 * math.pi))
        assert d == pytest.approx(want, rel=2e-3)
    for some in ([], [None], [2.0, 2.0, 2.0]):
        assert eda.density_curve(spark.createDataFrame([(v,) for v in some], "v double"), "v").count() == 0
