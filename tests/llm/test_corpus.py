"""Operators 1, 3, 6, 7, 9 and the pipeline against brute force."""

import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm import golay_simhash, hmm_lm, line_dedup, line_quality, minimax_shards
from postlens.llm.common import read

from llm_help import SF_SMALL, WORD, awkward, by_row, none, same, texts_of  # noqa: F401


# -- line dedup -----------------------------------------------------------------

def dedup_by_hand(docs):
    """{(doc_id, text): text left}.  Rows that share an id are one document."""
    count, keeper = Counter(), {}
    for doc, text in docs:
        for _, _, chunk in line_dedup.repeatable(text):
            count[chunk] += 1
            rank = (doc is None, doc or 0)
            keeper[chunk] = min(keeper.get(chunk, rank), rank)
    out = {}
    for doc, text in docs:
        at = {a: c for a, _, c in line_dedup.repeatable(text)}
        lines, keep, seen, gone = text.split("\n"), [], set(), 0
        for a, b in line_dedup.chunks(text):
            c = at.get(a)
            lost = c is not None and count[c] > 1 and (keeper[c] != (doc is None, doc or 0) or c in seen)
            seen.add(c)
            gone += lost
            keep += [] if lost else lines[a:b]
        out[doc, text] = "\n".join(keep) if gone else text
    return out


def dedup_by_all_sets(docs):
    """{(doc_id, text): text left} by all boundary sets: the lines of repeated
    chunks go, but for those that a chunk which stays here has too."""
    found = {}
    for doc, text in set(docs):
        found[doc, text] = sorted({x for k in range(line_dedup.SETS) for x in line_dedup.repeatable(text, k)})
    count, keeper = Counter(), {}
    for (doc, _), chunks in found.items():
        for _, _, chunk in chunks:
            count[chunk] += 1
            keeper[chunk] = min(keeper.get(chunk, (True, 0)), (doc is None, doc or 0))
    out = {}
    for (doc, text), chunks in found.items():
        seen, lost, held = set(), set(), set()
        for a, b, chunk in chunks:
            if count[chunk] > 1:
                stays = keeper[chunk] == (doc is None, doc or 0) and chunk not in seen
                (held if stays else lost).update(range(a, b))
            seen.add(chunk)
        lines = text.split("\n")
        lost -= held
        out[doc, text] = "\n".join(x for i, x in enumerate(lines) if i not in lost) if lost else text
    return out


@pytest.mark.parametrize("sets", [1, line_dedup.SETS])
def test_line_dedup(awkward, none, sets):
    rows = line_dedup.dedup(awkward, sets)
    assert rows.columns == [*awkward.columns, "n_removed_chunks", "n_removed_lines"]
    docs = texts_of(awkward)
    want = dedup_by_hand(docs) if sets == 1 else dedup_by_all_sets(docs)
    same(texts_of(rows), ((d, want[d, t]) for d, t in docs))
    assert rows.agg(F.sum("n_removed_chunks")).first()[0] > 10
    assert awkward.where("text IS NULL").count() == rows.where("text IS NULL").count()
    assert line_dedup.dedup(none, sets).count() == 0


def test_chunk_boundaries_resist_shifts():
    lines = [f"line {i * 7919 % 1000} of the text" for i in range(200)]
    own = {tuple(lines[a:b]) for a, b in line_dedup.chunks("\n".join(lines))}
    moved = ["new", "lines", "in front", *lines]
    other = {tuple(moved[a:b]) for a, b in line_dedup.chunks("\n".join(moved))}
    assert len(own - other) <= 2 and len(own) > 20


def test_chunks_with_equal_hashes_are_compared(spark, monkeypatch):
    """All chunks share one hash: only what equals the chunk that stays goes."""
    found = line_dedup.occurrences
    monkeypatch.setattr(line_dedup, "occurrences",
                        lambda docs, sets: found(docs, sets).withColumn("chunk_hash", F.lit(bytearray(b"same"))))
    a, b = "one line here\nanother line", "quite other\nlines these"
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, b)], "doc_id bigint, text string")
    assert dict(texts_of(line_dedup.deduplicated(docs))) == {1: a, 2: b, 3: "", 4: b}


def shared_lines(docs):
    """{doc_id: lines of runs of two or more lines that another document with
    a smaller id has too}, by brute force over adjacent lines."""
    first = {}
    for d, t in sorted(docs):
        lines = t.split("\n")
        for pair in zip(lines, lines[1:]):
            first.setdefault(pair, d)
    out = {}
    for d, t in docs:
        lines = t.split("\n")
        out[d] = {i + k for i, pair in enumerate(zip(lines, lines[1:])) if first[pair] < d for k in (0, 1)}
    return out


def test_short_passages_between_own_lines_are_removed(spark):
    """Passages of 2 to 5 lines in two texts each, between lines of their own."""
    def own(d, k):
        return [f"line {d} {k} {i} of its own" for i in range(4)]

    rows = []
    for p in range(100):
        passage = [f"passage {p} line {i} which two texts share" for i in range(2 + p % 4)]
        rows += [(d, "\n".join([*own(d, 0), *passage, *own(d, 1)])) for d in (p, 1000 + p)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = dict(texts_of(line_dedup.deduplicated(docs)))
    want = shared_lines(rows)
    gone = {}
    for d, t in rows:
        stays = Counter(left[d].split("\n"))
        gone[d] = {i for i, x in enumerate(t.split("\n")) if not stays[x]}
        assert gone[d] <= want[d]
    assert all(left[d] == t for d, t in rows if d < 1000)
    assert sum(bool(x) for x in gone.values()) >= 95
    assert sum(map(len, gone.values())) >= 0.95 * sum(map(len, want.values()))


def test_each_repeated_chunk_stays_whole(spark):
    """Overlapping passages with different keepers, in random texts."""
    r = np.random.default_rng(3)
    pool = [f"shared line {i} of a long row of lines" for i in range(40)]
    rows = []
    for d in range(80):
        a = int(r.integers(0, 36))
        rows.append((d, "\n".join([f"own {d} a", *pool[a:a + int(r.integers(2, 8))], f"own {d} b"])))
    left = dict(texts_of(line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string"))))
    count, per_set = Counter(), defaultdict(set)
    for d, t in rows:
        for k in range(line_dedup.SETS):
            per_set[d] |= {(a, b, c) for a, b, c in line_dedup.repeatable(t, k)}
        count.update(c for _, _, c in per_set[d])
    whole = "\n\n".join(left.values())
    often = [c for c, n in count.items() if n > 1]
    assert len(often) > 50 and all(c in whole for c in often)
    assert sum(map(len, left.values())) < 0.8 * sum(len(t) for _, t in rows)


# -- sharding --------------------------------------------------------------------

def least_capacity(sizes, shards):
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for s in sizes:
            used, filled = (used + 1, s) if filled + s > middle else (used, filled + s)
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 8, 400])
def test_minimax_shards(spark, awkward, shards):
    rows = minimax_shards.assign(awkward, shards).collect()
    docs = texts_of(awkward)
    same(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows),
         ((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in docs))
    own = defaultdict(list)
    for r in rows:
        own[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in own.values()) and set(own) <= set(range(shards))
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(v) == 1 for v in where.values())
    hashes = {r["t"]: r["h"] for r in awkward.select(
        F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    group = Counter()
    for _, t in docs:
        group[t] += len(t.encode()) + 1
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) == least_capacity([group[t] for t in sorted(hashes, key=hashes.get)], shards)


def test_minimax_shards_of_nothing(none):
    assert minimax_shards.digests(none, 8).count() == 0


def test_sums_are_refined_to_single_groups(spark):
    """Many groups in a narrow hash range: the cuts need several splits."""
    r = np.random.default_rng(0)
    rows = [(int(h), int(s)) for h, s in zip(np.unique(r.integers(1 << 40, 1 << 41, 3000)), r.integers(1, 500, 3000))]
    groups = spark.createDataFrame(rows, "group_hash bigint, size bigint")
    capacity, cuts = minimax_shards.capacity_and_cuts(groups, 7)
    assert capacity == least_capacity([s for _, s in rows], 7) and len(cuts) <= 6


# -- quality rules ------------------------------------------------------------------

def quality_by_hand(rows):
    """The digest columns of op6 for (doc_id, text, host) rows."""
    def norm(line):
        return " ".join(re.findall(WORD, re.sub("[1-9]", "0", line.lower())))

    seen = defaultdict(set)
    for _, t, h in rows:
        for x in (t or "").split("\n"):
            seen[h, norm(x)].add(t or "")
    out = []
    for d, t, h in rows:
        t = t or ""
        w = re.findall(WORD, t)
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        count, cover = Counter(grams), set()
        for k, g in enumerate(grams):
            if count[g] > 1:
                cover.update(range(k, k + 8))
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        often = [x for x in lines if len(seen[h, norm(x)]) > line_quality.LINE_DOCUMENTS]
        left = len(w) - sum(len(re.findall(WORD, x)) for x in often)
        base = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        kept = not base and (not often or (left >= 20 and left >= line_quality.LEFT_SHARE * len(w)))
        out.append((d, len(w), sum(map(len, w)), sum(c in line_quality.SYMBOLS for c in t),
                    len(lines) - len(set(lines)), len(cover), base, kept))
    return out


def test_quality_rules(awkward, none, monkeypatch):
    monkeypatch.setattr(line_quality, "LINE_DOCUMENTS", 3)
    got = [tuple(r) for r in line_quality.digests(awkward).collect()]
    rows = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    want = quality_by_hand(rows)
    same(got, want)
    assert {x[-2:] for x in want} >= {(True, False), (False, True), (False, False)}
    assert line_quality.digests(none).count() == 0


def test_cleaned_texts(awkward, none, monkeypatch):
    monkeypatch.setattr(line_quality, "LINE_DOCUMENTS", 3)
    left = line_quality.cleaned(awkward)
    assert left.columns == awkward.columns
    verdict = Counter(r["doc_id"] for r in line_quality.digests(awkward).where("kept").collect())
    assert Counter(r["doc_id"] for r in left.collect()) == verdict
    assert left.where("source = 'src0' AND text LIKE '%All rights RESERVED%'").count() == 0
    assert line_quality.cleaned(none).count() == 0


def test_one_host_and_one_line_for_a_third_of_the_rows(spark):
    rows = [(i, f"the same line everywhere\n" + " ".join(f"w{i}x{k}" for k in range(30)),
             "big" if i % 3 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    same(map(tuple, line_quality.digests(docs).collect()), quality_by_hand(rows))


def test_the_line_limit_does_not_grow_with_the_host(spark):
    """30 documents with one line are 1 % of the large host, all of the small."""
    def text(h, i):
        own = " ".join(f"{h}{'x' * (i % 50)}y{'z' * (i // 50)}{chr(97 + k)}" for k in range(25))
        return own + "\nThis notice stands in thirty documents" * (i < 30)

    rows = [(100 * (h == "large") + i, text(h, i), h) for h, n in (("large", 3000), ("small", 30)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    same(map(tuple, line_quality.digests(docs).collect()), quality_by_hand(rows))
    assert sorted(r["host"] for r in line_quality.boilerplate(docs, "source").collect()) == ["=large", "=small"]
    assert line_quality.cleaned(docs).where("text LIKE '%notice%'").count() == 0
    assert line_quality.cleaned(docs).count() == len(rows)


# -- SimHash ----------------------------------------------------------------------------

def fingerprint_by_hand(text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if x]
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, bits):
    names = list(prints)
    root = {p: p for p in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(names, 2):
        if (a ^ b).bit_count() <= bits:
            root[find(a)] = find(b)
    return {p: find(p) for p in names}


def test_op7_components(awkward, none):
    docs = texts_of(awkward)
    prints = {t: fingerprint_by_hand(t) for _, t in docs}
    root = components_by_hand(set(prints.values()), 4)
    least = {}
    for d, t in docs:
        if d is not None:
            k = root[prints[t]]
            least[k] = min(d, least.get(k, d))
    want = [(d, f"{prints[t]:016x}", least.get(root[prints[t]])) for d, t in docs]
    same(map(tuple, golay_simhash.digests(awkward, 4, 4).collect()), want)
    assert golay_simhash.digests(none, 4, 4).count() == 0


def test_golay_keys_meet_within_two_bits():
    r = np.random.default_rng(0)
    for flips in (1, 2):
        words = r.integers(0, 1 << 23, 2000)
        other = words.copy()
        for i in range(len(words)):
            for b in r.choice(23, flips, replace=False):
                other[i] ^= 1 << int(b)
        a, b = golay_simhash.segment_keys(words), golay_simhash.segment_keys(other)
        assert all({x for x in p if x >= 0} & {x for x in q if x >= 0} for p, q in zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("bits", [3, 4, 5])
def test_links_of_planted_fingerprints(spark, bits):
    """Chains, a large cluster around one fingerprint, and noise."""
    r = np.random.default_rng(bits)
    centre = int(r.integers(0, 1 << 62))
    prints = {centre}
    while len(prints) < 300:
        p = centre
        for b in r.choice(64, 5, replace=False):
            p ^= 1 << int(b)
        prints.add(p)
    step = int(r.integers(0, 1 << 62))
    for _ in range(40):
        for b in r.choice(64, bits, replace=False):
            step ^= 1 << int(b)
        prints.add(step)
    prints |= {int(x) for x in r.integers(0, 1 << 62, 500)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    nodes = spark.createDataFrame(signed, "fingerprint bigint")
    forest = golay_simhash.star_forest(golay_simhash.links(golay_simhash.meeting_keys(nodes), bits))
    to = {r["u"] & (1 << 64) - 1: r["v"] & (1 << 64) - 1 for r in forest.collect()}
    want = components_by_hand(prints, bits)

    def parts(of):
        out = defaultdict(set)
        for p in prints:
            out[of(p)].add(p)
        return {frozenset(x) for x in out.values()}

    assert parts(lambda p: to.get(p, p)) == parts(want.get)


def test_representatives(awkward):
    kept = golay_simhash.representatives(awkward, 4, 4)
    assert kept.columns == awkward.columns
    found = golay_simhash.components(awkward, 4, 4).collect()
    want = {r["doc_id"] for r in found if r["doc_id"] is not None and r["doc_id"] == r["component_id"]}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(d for d in got if d is not None) == sorted(want)
    assert got.count(None) == awkward.where("doc_id IS NULL").count()


# -- language model -------------------------------------------------------------------

def test_forward_and_expected_counts():
    r = np.random.default_rng(1)
    m = hmm_lm.Model.first(r.random(hmm_lm.ALL) * 10)
    sequences = [r.integers(0, hmm_lm.ALL, n).astype(np.uint16) for n in (1, 5, 3000, 17, 2)]
    want, logs = np.zeros((hmm_lm.ALL + hmm_lm.STATES + 1, hmm_lm.STATES)), []
    for s in sequences:
        a, b, c = np.zeros((len(s), hmm_lm.STATES)), np.ones((len(s), hmm_lm.STATES)), np.zeros(len(s))
        for t in range(len(s)):
            a[t] = (a[t - 1] @ m.move if t else m.start) * m.emit[s[t]]
            c[t] = a[t].sum()
            a[t] /= c[t]
        for t in range(len(s) - 2, -1, -1):
            b[t] = m.move @ (m.emit[s[t + 1]] * b[t + 1]) / c[t + 1]
            want[hmm_lm.ALL:-1] += a[t][:, None] * m.move * (m.emit[s[t + 1]] * b[t + 1] / c[t + 1])
        np.add.at(want, s.astype(int), a * b)
        want[-1] += (a * b)[0]
        logs.append(np.log10(c).sum())
    assert np.allclose(hmm_lm.log10_likelihoods(m, sequences), logs, atol=1e-8)
    assert np.allclose(hmm_lm.expected_counts(m, sequences), want, atol=1e-8)


def test_op9_base_and_held_out(spark, awkward, none, monkeypatch):
    monkeypatch.setattr(hmm_lm, "HEAD", 40)
    monkeypatch.setattr(hmm_lm, "ITERATIONS", 1)
    rows = hmm_lm.score(awkward).collect()
    docs = [(d, re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t)) + ["\n"]) for d, t in texts_of(awkward)]
    held = {d: d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    c = Counter(w for d, ws in docs if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    want = by_row((d, held[d], len(ws), sum(c[w] > 0 for w in ws), n,
                   float(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))) for d, ws in docs)
    got = by_row((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                  r["base_score"]) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(r["score"] < 0 for r in rows)
    assert hmm_lm.score(none).count() == 0


def test_states_beat_frequencies_on_held_out_texts(spark):
    r = hmm_lm.score(read(spark, SF_SMALL, "documents")).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


# -- the pipeline ---------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = read(spark, SF_SMALL, "documents")
    columns, before = docs.columns, texts_of(docs)
    quality, dedup, near, pack = (f for _, f in corpus_pipeline.STAGES)
    kept = quality(spark, docs, SF_SMALL)
    want = {x[0] for x in quality_by_hand([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]) if x[-1]}
    assert kept.columns == columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == want
    assert 0.7 * len(before) < len(want) < len(before)
    kept = kept.checkpoint()
    less = dedup(spark, kept, SF_SMALL).checkpoint()
    by_hand = dedup_by_all_sets(texts_of(kept))
    assert less.columns == columns
    same(texts_of(less), ((d, by_hand[d, t]) for d, t in texts_of(kept)))
    assert less.where("n_chars != length(text)").count() == 0
    one = near(spark, less, SF_SMALL).checkpoint()
    prints = {t: fingerprint_by_hand(t) for _, t in texts_of(less)}
    root = components_by_hand(set(prints.values()), 4)
    least = {}
    for d, t in texts_of(less):
        least[root[prints[t]]] = min(d, least.get(root[prints[t]], d))
    assert one.columns == columns and sorted(d for d, _ in texts_of(one)) == sorted(least.values())
    packed = pack(spark, one, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == one.count()


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert rows.count() > 100
