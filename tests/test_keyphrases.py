"""Keyphrases against a plain Python version of the published method."""

import math
import random
import statistics
from collections import defaultdict

import numpy as np
import pytest
import regex

from postlens.functions import text as T
from postlens.operators import keyphrases as KP


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def by_hand(text):
    tokens = []
    sentences = [s for s in regex.split(r"[.!?\n]+", text or "") if regex.search(r"[\p{L}\p{N}]", s)]
    for s, sentence in enumerate(sentences):
        first = True
        for c, chunk in enumerate(regex.split(r"[^\p{L}\p{N}\s'’-]+", sentence)):
            for w in regex.findall(r"[\p{L}\p{N}][\p{L}\p{N}'’-]*", chunk):
                tokens.append((s, c, first, w, w.lower()))
                first = False
    stop = {t for *_, t in tokens if t in T.STOPWORDS or len(t) < 3 or regex.fullmatch(r"[0-9'’-]+", t)}
    at = defaultdict(list)
    for i, x in enumerate(tokens):
        at[x[4]].append(i)
    tfs = [len(v) for t, v in at.items() if t not in stop]
    score = {}
    for t, places in at.items():
        if t in stop:
            continue
        tf = len(places)
        words = [tokens[i] for i in places]
        upper = sum(w[3].upper() == w[3] and len(w[3]) > 1 for w in words)
        capital = sum(w[3][0].upper() == w[3][0] and not (w[3].upper() == w[3] and len(w[3]) > 1) and not w[2] for w in words)
        variety = 0
        for step in (-1, 1):
            near = [tokens[i + step][4] for i in places
                    if 0 <= i + step < len(tokens) and tokens[i + step][:2] == tokens[i][:2]]
            variety += len(set(near)) / max(len(near), 1)
        rel = 1 + variety * tf / max(tfs)
        case = max(upper, capital) / (1 + math.log(tf))
        place = math.log(math.log(3 + statistics.median(w[0] for w in words)))
        norm = tf / (statistics.mean(tfs) + statistics.pstdev(tfs))
        spread = len({w[0] for w in words}) / len(sentences)
        score[t] = rel * place / (case + norm / rel + spread / rel)
    found = defaultdict(list)
    for i in range(len(tokens)):
        for n in (1, 2, 3):
            part = tokens[i:i + n]
            if len(part) == n and all(x[:2] == part[0][:2] and x[4] in score for x in part):
                found[" ".join(x[4] for x in part)].append(i)
    ranked = []
    for phrase, places in found.items():
        parts = [score[t] for t in phrase.split(" ")]
        ranked.append((round(math.prod(parts) / (len(places) * (1 + sum(parts))), 9), places[0], phrase))
    kept = []
    for s, _, phrase in sorted(ranked):
        if len(kept) < 20 and not any(1 - distance(phrase, p) / max(len(phrase), len(p)) > 0.9 for p, _ in kept):
            kept.append((phrase, s))
    return kept[:15]


TEXTS = [
    "Google is acquiring Kaggle. Sources tell us that Google is acquiring Kaggle, a platform that hosts data science "
    "competitions. Details remain vague, but Kaggle was founded by Anthony Goldbloom in 2010!\nNASA and Google Cloud",
    "word word word word", "tie one, tie two, tie three", "the of and a", "", None, "  \n .. !", "12 34 5-6 ok no",
    "Ärger über Straßen; ärger über straßen. naïve café-bar don't don’t", "keyphrase extraction keyphrases extraction "
    "keyphrase extractions and keyphrase extraction", "x" * 3000, "Long text here. " * 300,
]


def test_keyphrases_match_the_plain_version(spark):
    rows = [(i % 7 if i % 3 else None, t) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = KP.keyphrases(df, "t")
    assert got.columns == ["id", "t", "keyphrases"] and got.count() == len(rows)
    for r in got.collect():
        want = by_hand(r["t"])
        assert [p["phrase"] for p in r["keyphrases"]] == [p for p, _ in want], r["t"]
        assert [p["score"] for p in r["keyphrases"]] == pytest.approx([s for _, s in want])
    best = by_hand(TEXTS[0])
    assert len(best) == 15 and any(p.startswith("google") for p, _ in best[:3])


def test_keyphrases_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in KP.keyphrases(docs, "text").collect():
        assert [p["phrase"] for p in r["keyphrases"]] == [p for p, _ in by_hand(r["text"])], r["doc_id"]


def test_no_rows(spark):
    assert KP.keyphrases(spark.createDataFrame([], "t string"), "t").count() == 0


def test_texts_are_worked_on_where_they_are(spark):
    df = spark.createDataFrame([(1, TEXTS[0])], "id long, t string")
    plan = KP.keyphrases(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in ("Exchange", "Window", "Generate", "Sort", "Join") if step in plan], plan


def test_texts_that_share_a_batch(spark):
    r = random.Random(3)
    words = ["data", "Data", "DATA", "the", "lake", "lakes", "spark-stream", "spark-streams", "don't", "’tis", "12", "of", "ΟΔΟΣ",
             "ΟΔΟΣ’", "σίγμας", "İstanbul", "Straße", "STRASSE", "ǅabc", "数据", "١٢٣", "½", "Ⅷth", "𐐀𐐨x", "É", "ét", "abcdefghijkl", "abcdefghijkm"]
    parts = [" "] * 9 + ["\t", "\r\n", ". ", "! ", ", ", " - ", "\x0b", "\u00ad", "\u0301", "_", ":", "\x00"]
    texts = ["".join(r.choice(words) + r.choice(parts) for _ in range(r.choice([0, 1, 4, 15, 60]))) for _ in range(3 * KP.STEP)]
    texts[7] = texts[8] = None
    texts[9] = "one long text of many words. " * (KP.STEP_BYTES // 25)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").coalesce(1)
    got = {x["id"]: x["keyphrases"] for x in KP.keyphrases(df, "t").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = by_hand(t)
        assert [p["phrase"] for p in got[i]] == [p for p, _ in want], t
        assert [p["score"] for p in got[i]] == pytest.approx([s for _, s in want])


def test_edits_within_a_bound():
    r = random.Random(5)
    for _ in range(3000):
        a = "".join(r.choice("abé𐐨") for _ in range(r.randint(1, 80)))
        b = list(a)
        for _ in range(r.randint(0, 8)):
            b[r.randrange(len(b) + 1):r.randrange(len(b) + 1)] = r.choice(["", "a", "x", "éb"])
        b = "".join(b) or "a"
        d, far = r.randint(1, 9), distance(a, b)
        assert KP._distance(a, b) == far
        assert abs(len(a) - len(b)) > d or KP._within(a, b, d) == (far <= d), (a, b, d)
    for dedup in (0.9, 0.5, 1.0, 0.0, -0.5):
        edits = KP._Edits(dedup)
        assert all((d <= edits[n]) == (1.0 - d / n > dedup) for n in range(1, 90) for d in range(n + 1))


def test_groups_and_rounding():
    keys = np.array([5, 2, 5, 2, 9, 5])
    for k in (keys, keys << 59):            # the second ones leave no bits for the places
        order, start, group = KP._groups(k)
        assert order.tolist() == [1, 3, 0, 2, 5, 4] and start.tolist() == [0, 2, 5] and group.tolist() == [1, 0, 1, 0, 2, 1]
    assert KP._rounded(np.array([2.0 ** -10, 0.1234567885, 0.1234567884, 3e-10])).tolist() == [0.000976563, 0.123456789, 0.123456788, 0.0]
