"""What the tests of this folder share."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in any column, empty and very long texts, ties,
    repeated rows, near copies, and extra columns whose names clash with
    those the operators use."""
    r = random.Random(5)
    vocab = ["".join(r.choice("aeinrst") for _ in range(r.randint(2, 7))) for _ in range(300)]

    def line(n):
        return " ".join(r.choice(vocab) for _ in range(n)).capitalize()

    shared = "\n".join(line(12) for _ in range(9))
    notice = "All rights RESERVED 2019 by nobody at all."
    rows = []
    for i in range(120):
        text = "\n".join(line(r.randint(4, 14)) for _ in range(r.randint(1, 8)))
        if i % 4 == 0:
            text += "\n" + notice
        if i % 10 == 3:
            text = f"{line(9)}\n{shared}\n{line(7)}"
        rows.append((i, text, "en", "src0" if i % 3 else f"src{i % 7}"))
    near = " ".join(r.choice(vocab) for _ in range(200))
    rows += [(200 + k, near + f" end{k}", "en", "src1") for k in range(12)]
    rows += [(300, None, None, None), (301, "", "en", None), (302, " \n\t \x0b", None, "src1"),
             (303, " ".join(r.choice(vocab) for _ in range(20000)), "fr", "src1"),
             (304, "x" * 70000, "en", "src0"), (305, "é漢字🙂́ \x1c\x85　a  b's 12 #*$|<>", "es", "src2"),
             (None, "A row without an id\nthat has two lines", "en", "src1"), (None, None, None, None),
             (306, notice, "en", "src0"), (307, f"{shared}\n{shared}", "en", "src0"),
             (308, "<|endoftext|> <|startoftext|> ~ | ^", "en", "src0")]
    rows += [rows[5], rows[5], rows[-2], rows[3]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.select("*", F.length("text").cast("bigint").alias("n_chars"), *[
        F.lit(7).alias(c) for c in ("ids", "host", "text_hash", "size", "line", "length", "key", "_h",
                                    "shard", "bucket", "n_words", "fingerprint", "rank", "wanted")]).repartition(5)


@pytest.fixture(scope="session")
def none(awkward):
    return awkward.where("false")


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def by_row(rows):
    """Sorted, nulls first, for comparing multisets of tuples."""
    return sorted(rows, key=lambda t: tuple((x is not None, x) for x in t))


def same(got, want):
    """The same rows, in any order; a short message if not (long texts make
    pytest's own comparison very slow)."""
    a, b = Counter(got), Counter(want)
    if a != b:
        pytest.fail(f"too many: {str(list((a - b).items())[:3])[:600]}\ntoo few: {str(list((b - a).items())[:3])[:600]}")
