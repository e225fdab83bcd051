"""Operators 4 and 5 against rules by hand and brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import pivot_topk, url_filter

URLS = [
    "http://Blog.Example.ORG/es/1", "https://example.org/en/123?x=1", "http://a.example.org/en/9#t",
    "http://x.com/fr/1", "http://x.com/de/1", "HTTP://notorg/fr/", "http://org", "http://org/", None, "", "no scheme/x",
    "http://?q", "http://h.com#frag/de/", "http://free-bets.example.net/en/1", "http://casinowin.example.net/en/1",
    "http://plain.example.net/fr/77", "http://plain.example.net/de/77", "://e.com/fr/a?://b", "http://exämple.com/de/ü",
    "http://x.com/a\nb/c", "http://" + "a" * 400 + ".com/fr/",
]


def by_hand(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, says) for h, p, says in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


@pytest.fixture(scope="module")
def pages(spark):
    html = "<p>Casino win free bets plain <b>words</b> casino win</p><script>x</script>"
    rows = [(i, u, html if i % 3 else None, 1) for i, u in enumerate(URLS * 2)] + [(None, URLS[0], html, 1)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host int")


def test_url_rules_and_verdicts(pages):
    rows = url_filter.judge(pages).collect()
    assert len(rows) == 2 * len(URLS) + 1
    for r in rows:
        host, path, rule, says = by_hand(URLS[(r["page_id"] or 0) % len(URLS)])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (says or ("block" if r["score"] > 0 else "allow"))
    verdict = {r["page_id"]: r["verdict"] for r in rows}
    assert verdict[URLS.index("http://casinowin.example.net/en/1")] == "block"
    score = {r["page_id"]: r["score"] for r in rows}
    assert score[URLS.index("http://plain.example.net/fr/77")] < score[URLS.index("http://plain.example.net/de/77")]


def test_url_filter_without_rows_or_labels(pages):
    assert url_filter.judge(pages.where("false")).count() == 0
    alone = url_filter.judge(pages.where("page_id = 8")).collect()
    assert [r["verdict"] for r in alone] == ["allow"]


def test_viterbi_takes_the_likeliest_words():
    counts = {"casino": 5, "win": 9, "cas": 1, "in": 40, "o": 2, "w": 1}
    total = sum(counts.values())

    def best(name):
        if not name:
            return 0.0, []
        ways = []
        for k in range(1, min(len(name), url_filter.LONGEST_WORD) + 1):
            w = name[:k]
            gain = math.log(counts[w] / total) if w in counts else -math.log(total) - k * math.log(10)
            rest, words = best(name[k:])
            ways.append((gain + rest, [w, *words]))
        return max(ways)

    for name in ("casinowin", "winin", "xyz", "wincas", "oowin"):
        known = [(i, len(w), n) for w, n in counts.items() for i in range(len(name)) if name.startswith(w, i)]
        got = url_filter.viterbi(name, known, total)
        assert "".join(got) == name

        def worth(words):
            return sum(math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10)
                       for w in words)

        assert math.isclose(worth(got), best(name)[0])


def topk_by_hand(rows, k, every):
    vectors = [(i, np.floor(np.array(v, float) * 64).astype(int)) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], set()
    for q, a in vectors:
        if q % every or q in asked:
            continue
        asked.add(q)
        found = sorted(((-int(sum(x * y for x, y in zip(a, v))), i) for i, v in vectors if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return out


def test_top_k_is_exact(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in r.normal(0, 0.2, 8)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]                       # many ties
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")]), (304, [float("inf")]),
             (305, [2.0] * 3), (None, [1.0] * 8), rows[7], rows[7], (-20, [0.5] * 8), (320, [30000.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("block", F.lit(1))
    got = [tuple(x) for x in pivot_topk.search_table(df, 20, 64, 20).collect()]
    assert sorted(got) == sorted(topk_by_hand(rows, 20, 20))
    few = df.where("vec_id < 5")
    assert sorted(tuple(x) for x in pivot_topk.search_table(few, 20, 64, 2).collect()) == sorted(
        topk_by_hand([x for x in rows if x[0] is not None and x[0] < 5], 20, 2))
    assert pivot_topk.search_table(df.where("false"), 20, 64, 20).count() == 0


def test_bounds_leave_most_candidates_out():
    """Clustered vectors: the pivots decide, few inner products are taken."""
    r = np.random.default_rng(1)
    centres = r.normal(0, 40, (20, 16))
    vectors = np.floor(centres[r.integers(0, 20, 2000)] + r.normal(0, 1, (2000, 16))).astype(np.int64)
    got = pivot_topk.search([0], vectors[:1], np.arange(2000), vectors, vectors[:32], 5)
    scores = vectors @ vectors[0]
    scores[0] = -10 ** 9
    assert [s for _, _, s in got] == sorted(scores.tolist(), reverse=True)[:5]
