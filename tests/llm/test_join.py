"""Operator 12 against all pairs by hand."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from postlens.llm import jaccard_join
from postlens.llm.common import materialize

from llm_help import WORD, awkward, none, same, texts_of  # noqa: F401


def shingles(text, k=5):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components_by_hand(docs, percent=80, k=5):
    sets = [frozenset(shingles(t, k)) for _, t in docs]
    distinct = [s for s in dict.fromkeys(sets) if s]
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for a, b in itertools.combinations(distinct, 2):
        if 100 * len(a & b) >= percent * len(a | b):
            root[find(a)] = find(b)
    least = defaultdict(list)
    for (d, _), s in zip(docs, sets):
        if s and d is not None:
            least[find(s)].append(d)
    return [(d, len(s), (min(least[find(s)], default=None) if s else d)) for (d, _), s in zip(docs, sets)]


def test_components(awkward, none):
    want = components_by_hand(texts_of(awkward))
    same(map(tuple, jaccard_join.components(awkward, 5, 80).collect()), want)
    assert sum(c != d for d, _, c in want) > 10
    assert jaccard_join.components(none, 5, 80).count() == 0


def near_copies(seed):
    """Chains of small edits, many edits of one text, texts that are mostly one
    shared passage, and texts of a few words."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]

    def words(n):
        return [r.choice(vocab) for _ in range(n)]

    def edited(w, n):
        w = list(w)
        for _ in range(n):
            w[r.randrange(len(w))] = r.choice(vocab)
        return w

    out = []
    for _ in range(6):
        w = words(r.randint(60, 120))
        for _ in range(8):
            out.append(w)
            w = edited(w, r.choice([1, 2, 3]))
    base = words(150)
    out += [edited(base, r.randint(1, 4)) for _ in range(60)]
    passage = words(80)
    out += [words(a := r.randint(5, 40)) + passage + words(a % 7) for _ in range(40)]
    out += [words(r.randint(1, 9)) for _ in range(30)] + [passage[:n] for n in range(1, 12)]
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("percent,block,most", [(80, 4, 16), (60, 256, 16), (70, 4, 1)])
def test_near_copies(spark, monkeypatch, percent, block, most):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "MOST", most)
    docs = near_copies(percent)
    got = jaccard_join.components(spark.createDataFrame(docs, "doc_id bigint, text string"), 5, percent)
    want = components_by_hand(docs, percent)
    same(map(tuple, got.collect()), want)
    assert sum(c != d for d, _, c in want) > 20


def test_all_candidates_without_centres(spark, monkeypatch):
    """The pairs across components alone find every link."""
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    docs = near_copies(1)
    got = jaccard_join.components(spark.createDataFrame(docs, "doc_id bigint, text string"), 5, 80)
    same(map(tuple, got.collect()), components_by_hand(docs))


def test_popular_shingles_put_out_pairs_not_meetings(spark, monkeypatch):
    """Nodes that share popular shingles and rare ones: the meetings put out grow
    with the rows, and each pair that meets often enough comes out once."""
    r, met, pairs = random.Random(3), [], jaccard_join._pairs

    def counting(rows, percent, every):
        met.append(rows.count())
        return pairs(rows, percent, every)

    monkeypatch.setattr(jaccard_join, "_pairs", counting)
    monkeypatch.setattr(jaccard_join, "POPULAR", 16, raising=False)
    prefixes = {node: sorted(r.sample(range(30), r.randint(3, 20))) + [100 + node // 5] for node in range(200)}
    rows = [(t, node, 6, 60, at, at, 1.0, node // 7) for node, tokens in prefixes.items() for at, t in enumerate(tokens)]
    rooted = spark.createDataFrame(rows, jaccard_join.PREFIX_ROWS + ", root bigint")
    got = jaccard_join.across(rooted, 80)
    assert met[0] <= 16 * len(rows) / 2
    want = []
    for v, u in itertools.combinations(prefixes, 2):
        a, b = prefixes[v], prefixes[u]
        both = set(a) & set(b)
        if both and v // 7 != u // 7 and len(both) >= 6:
            left = 59 - max(max(x.index(t) for t in both) for x in (a, b))
            if (len(both) + left) * 180 >= 120 * 80 and all(
                    (min(a.index(t), b.index(t)) + 60 - max(a.index(t), b.index(t))) * 180 >= 120 * 80 for t in both):
                want.append((u, v))
    assert len(want) > 100
    same(map(tuple, got.collect()), want)


@pytest.mark.parametrize("popular,block,columns", [(4, 8, 16), (2, 512, 1024)])
def test_near_copies_at_popular_shingles(spark, monkeypatch, popular, block, columns):
    for name, value in (("POPULAR", popular), ("BLOCK", block), ("COLUMNS", columns), ("ROUNDS", 1)):
        monkeypatch.setattr(jaccard_join, name, value)
    docs = near_copies(7)
    got = jaccard_join.components(spark.createDataFrame(docs, "doc_id bigint, text string"), 5, 80)
    same(map(tuple, got.collect()), components_by_hand(docs))


def test_demands_hold_for_all_similar_sets():
    """Whatever the demands, similar sets share as many prefix places."""
    r = np.random.default_rng(0)
    for _ in range(300):
        n = int(r.integers(5, 80))
        a = set(r.choice(2000, n, replace=False).tolist())
        b = set(list(a)[int(r.integers(0, n // 8 + 1)):]) | set(r.integers(0, 2000, int(r.integers(0, n // 8 + 1))).tolist())
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        for la, lb in itertools.product((1, 2, 5, 9), repeat=2):
            la, lb = min(la, jaccard_join.shared_least(len(a), 80)), min(lb, jaccard_join.shared_least(len(b), 80))
            pa, pb = (set(sorted(s)[:len(s) - jaccard_join.shared_least(len(s), 80) + m]) for s, m in ((a, la), (b, lb)))
            assert len(pa & pb) >= min(la, lb)


def test_the_demand_grows_where_comparisons_cost_more():
    places, met = np.arange(25), np.full(25, 100)
    assert jaccard_join.demand(100, places, met, 40, 80) > 1
    assert jaccard_join.demand(100, np.zeros(0, int), np.zeros(0, int), 40, 80) == 1
    assert jaccard_join.demand(1, places[:1], met[:1], 1, 80) == 1


def test_shuffle_files_go_with_their_write(spark):
    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while files.hasNext():
            names.add(files.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    before = left()
    rows = spark.range(20000, numPartitions=4).selectExpr("id % 5000 AS k", "id")
    out = materialize(rows.groupBy("k").count().join(rows, "k"), "counted")
    assert left() <= before
    assert out.count() == 20000 and out.where("count = 4").count() == 20000


def test_texts_are_dealt_once(spark, monkeypatch):
    """Repeated rows and null ids: one text a node, and no exchange after the join."""
    plans = []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(jaccard_join, "materialize", seen)
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (0, "d"), (2, None)],
                                     "doc_id long, text string")
        counted = docs.selectExpr("doc_id", "xxhash64(text) AS text_key", "text AS t").distinct().selectExpr(
            "doc_id", "text_key", "monotonically_increasing_id() AS node", "t = 'c' AS open")
        out = jaccard_join._texts_of(docs, counted)
        got = sorted((str(r.open), str(r.text)) for r in out.collect())
        assert got == [("False", "a b"), ("False", "d"), ("False", "d"), ("None", "None"), ("True", "c")]
        assert "hashpartitioning(node" not in plans[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
