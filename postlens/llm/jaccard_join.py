"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles, as 64-bit hashes.  In an
order of the shingles that all documents share, two sets that are similar
enough share at least one of their first ``n - ceil(t n) + 1`` shingles, and
at least m of them if both prefixes are longer by m - 1.  Each document takes
the length that its estimated cost makes best: a longer prefix meets more
documents, but fewer of them often enough to be compared.  Two documents are
compared if they share as many prefix shingles as the smaller of their two
demands asks for.

Order: first the rare shingles in the lowest quarter of the hash range, by the
number of rows that have them and then by hash; the quarter is counted over
all rows.  A document whose prefix this fills needs no other shingle.  The
others, which have few rare shingles there, are *open*: their other shingles
are counted among the open ones, and follow in the order, the rare ones
first.  Frequent shingles of both kinds come last.  A shingle that one row
alone has takes its place and is never put out.

Equal sets are one node.  Nodes meet first with one node per shingle, the
shingle's centre; the links found make components.  The first centre is the
node whose shingles are the commonest on average, which in a family of edited
copies is close to their original; later ones, several for a popular shingle,
are drawn by hash, while many pairs across components are left.  Then all nodes that meet and lie in
different components are compared, if the last shared place leaves room for
enough shared shingles.  The nodes of a popular shingle meet in pairs of
blocks of bounded size, where their whole prefixes are counted at once: a
group puts out the pairs to compare, never the meetings.  Comparisons inside a component are left out, since they cannot
change it: no link between components is lost.

Hashes stand for shingles: two different shingles of a compared pair count as
one with a probability of 2^-64.

Defined results: a null or blank text has no shingles, links with nothing and
is its own component; fewer words than a shingle has are one shingle; repeated
rows come back each with the same component; rows that share an id are rows of
their own, and a component's id is its smallest id, null if it has none; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_in_arrow, materialize, ship, texts
from .golay_simhash import star_forest

COUNTED = 1 << 62               # hashes below are counted over all rows: a quarter
RARE = 32                       # rows that a rare shingle has at most
MOST = 16                       # longest demand for shared prefix shingles
COMPARE = 16                    # a comparison costs one meeting per so many shingles
POPULAR = 64                    # nodes of a shingle that put out each of their meetings, at most
BLOCK = 512                     # nodes of a popular shingle compared with as many at once
COLUMNS = 1024                  # shingles, and pairs, looked at together in a block
ROUNDS = 4                      # rounds with centres before the rest, at most
FEW = 2                         # pairs per prefix row that need no more such rounds
GAIN = 0.9                      # nor if a round leaves more than this of the pairs
CENTRES = 16                    # centres of a shingle in later rounds; more nodes make it popular
WORDS = 200_000                 # memo of word hashes in a worker

FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


# -- sets ---------------------------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, words: int):
        if not 1 <= words <= len(FACTORS):
            raise ValueError(f"shingles of 1 to {len(FACTORS)} words")
        self.words, self.memo = words, {}

    def _word(self, word: bytes) -> int:
        import xxhash

        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= WORDS:
                self.memo.clear()
            found = self.memo[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, text: str) -> np.ndarray:
        import xxhash

        words = text.encode("utf-8", "surrogatepass").lower().split()
        if len(words) < self.words:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
        h = np.array([*map(self._word, words)], np.uint64)
        n = len(h) - self.words + 1
        total = h[:n] * FACTORS[0]
        for k in range(1, self.words):
            total += h[k:k + n] * FACTORS[k]
        return np.unique(_mixed(total))


def shared_least(n: int, percent: int) -> int:
    """The fewest shingles that a similar set must share with one of ``n``."""
    return -(-percent * n // 100)


def shingled(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: id, digest of the text, digest of the set (two
    longs), its size, and those of its hashes that are counted, ascending.
    ``row`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler = Shingler(words)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                made, n, ends, tokens = [], [], [0], []
                for t in texts(b.column("text")):
                    s = shingler.of(t)
                    tokens.append(s[:np.searchsorted(s, COUNTED)])
                    made.append(xxhash.xxh3_128_digest(s.tobytes()))
                    n.append(len(s))
                    ends.append(ends[-1] + len(tokens[-1]))
                digests = np.frombuffer(b"".join(made), "<i8").reshape(-1, 2)
                flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("text_key"), pa.array(digests[:, 0].copy()),
                     pa.array(digests[:, 1].copy()), pa.array(n, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["doc_id", "text_key", "a", "b", "n", "tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    made = map_in_arrow(rows, run, "doc_id bigint, text_key bigint, a bigint, b bigint, n int, tokens array<bigint>")
    return materialize(made.withColumn("row", F.monotonically_increasing_id()), "shingled")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """One row per distinct set: ``node`` (the first row's number), the row
    that has its text, and the smallest id."""
    first = F.min_by(F.struct("doc_id", "text_key"), "row")
    found = rows.where("n > 0").groupBy("a", "b").agg(
        F.min("row").alias("node"), first.alias("first"), F.min("doc_id").alias("least"),
        F.min("n").alias("n"), F.min(F.size("tokens")).alias("counted"))
    return materialize(found.select("a", "b", "node", "least", "n", "counted", F.col("first.doc_id").alias("doc_id"),
                                    F.col("first.text_key").alias("text_key")), "sets")


# -- prefixes -----------------------------------------------------------------------

def demand(n: int, places: np.ndarray, met: np.ndarray, known: int, percent: int) -> int:
    """How many shared prefix shingles to ask for: ``places`` in the set's
    order and rows met at them (``met``), with the first ``known`` places at
    hand.  The candidates are estimated as the meetings over the demand."""
    least = shared_least(n, percent)
    shortest = n - least + 1
    asked = np.arange(1, max(min(least, known - shortest + 1, MOST), 1) + 1)
    sums = np.r_[0, np.cumsum(met)]
    meetings = sums[np.searchsorted(places, shortest + asked - 1)]
    return int(asked[np.argmin(meetings * (1 + n / (COMPARE * asked)))])


def _placed(alone: int, rows: np.ndarray, tokens: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared shingles by rows and hash, with their places behind those that
    one row alone has."""
    order = np.lexsort((tokens, rows))
    return start + alone + np.arange(len(rows)), rows[order], tokens[order]


def _shared(put_out: DataFrame, key: str, into: str) -> DataFrame:
    """(key, into): the shingles that more than one row puts out, with the
    number of rows."""
    often = put_out.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1")
    return put_out.join(often, "token").groupBy(key).agg(F.collect_list(F.struct("rows", "token")).alias(into))


def _lists(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, tokens) of each row of an array of structs."""
    ends = np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
    rows, tokens = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in column.flatten().flatten())
    return [(rows[a:b], tokens[a:b]) for a, b in zip(ends, ends[1:])]


PREFIX_ROWS = "token bigint, node bigint, asked int, n int, at int, earlier int, weight double"


class _Prefixes:
    """Prefix rows gathered as columns."""

    def __init__(self):
        self.columns: list[list[np.ndarray]] = [[] for _ in range(7)]

    def add(self, node: int, n: int, known: int, weight: float, places, rows, tokens, percent: int) -> None:
        asked = demand(n, places, rows - 1, known, percent)
        m = int(np.searchsorted(places, n - shared_least(n, percent) + asked))
        for x, v in zip(self.columns, (tokens[:m], np.full(m, node), np.full(m, asked), np.full(m, n), places[:m],
                                       np.arange(m), np.full(m, weight))):
            x.append(v)

    def batch(self) -> pa.RecordBatch:
        kinds = (*[pa.int64()] * 2, *[pa.int32()] * 4, pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x) if x else np.zeros(0), kind) for x, kind in zip(self.columns, kinds)],
            names=["token", "node", "asked", "n", "at", "earlier", "weight"])


def _rare(counted: int, items: tuple[np.ndarray, np.ndarray]) -> int:
    """How many rare counted shingles a set has."""
    return counted - int((items[0] > RARE).sum())


def _weight(counted: int, rows: np.ndarray) -> float:
    """Mean number of rows of a set's counted shingles."""
    return (float(rows.sum()) + counted - len(rows)) / max(counted, 1)


def counted_sets(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Nodes with their shared counted shingles, and whether they are open;
    nodes that are neither open nor share any of the first places are left
    out."""
    shared = _shared(rows.select("row", F.explode("tokens").alias("token")), "row", "items")
    known = nodes.select(F.col("node").alias("row"), "n", "counted", "doc_id", "text_key").join(shared, "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            is_open, needed = [], []
            for n, c, items in zip(*(b.column(x).to_pylist() for x in ("n", "counted")), _lists(b.column("items"))):
                shortest = n - shared_least(n, percent) + 1
                is_open.append(_rare(c, items) < shortest)
                needed.append(is_open[-1] or (len(items[0]) > 0 and c - len(items[0]) < shortest + MOST - 1))
            yield b.append_column("open", pa.array(is_open, pa.bool_())).filter(pa.array(needed, pa.bool_()))

    schema = "row bigint, n int, counted int, doc_id bigint, text_key bigint, items array<struct<rows:bigint,token:bigint>>"
    made = map_in_arrow(known, run, schema + ", open boolean")
    return materialize(made.withColumnRenamed("row", "node"), "counted")


def closed_prefixes(counted: DataFrame, percent: int) -> DataFrame:
    """Prefixes of the nodes that are not open: rare counted shingles alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = _Prefixes()
            for node, n, c, (rows, tokens) in zip(*(b.column(x).to_pylist() for x in ("node", "n", "counted")),
                                                  _lists(b.column("items"))):
                few = rows <= RARE
                out.add(node, n, _rare(c, (rows, tokens)), _weight(c, rows),
                        *_placed(c - len(rows), rows[few], tokens[few], 0), percent)
            yield out.batch()

    return map_in_arrow(counted.where("NOT open").select("node", "n", "counted", "items"), run, PREFIX_ROWS)


def open_prefixes(counted: DataFrame, whole: DataFrame, words: int, percent: int) -> DataFrame:
    """Prefixes of the open nodes, whose other shingles are put out and
    counted among them."""

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 512):
                b = whole_batch.slice(at, 512)
                sets = [s[np.searchsorted(s, COUNTED):] for s in map(shingler.of, b.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(b.column("node").to_numpy(), [len(s) for s in sets])),
                     pa.array(np.concatenate(sets).view(np.int64))], names=["node", "token"])

    asked = counted.where("open").select("node", "n", "counted", "items")
    put_out = map_in_arrow(whole.where("open").select("node", "text"), others, "node bigint, token bigint")
    both = asked.join(_shared(put_out, "node", "others"), "node", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = _Prefixes()
            for node, n, c, (r, t), (r2, t2) in zip(*(b.column(x).to_pylist() for x in ("node", "n", "counted")),
                                                    _lists(b.column("items")), _lists(b.column("others"))):
                few, few2 = r <= RARE, r2 <= RARE
                first = _placed(c - len(r), r[few], t[few], 0)
                start = c - len(r) + len(first[0])
                then = _placed(n - c - len(r2), r2[few2], t2[few2], start)
                start += n - c - len(r2) + len(then[0])
                last = _placed(0, np.r_[r[~few], r2[~few2]], np.r_[t[~few], t2[~few2]], start)
                out.add(node, n, n, _weight(c, r), *(np.concatenate(x) for x in zip(first, then, last)), percent)
            yield out.batch()

    return map_in_arrow(both, run, PREFIX_ROWS)


# -- candidates -----------------------------------------------------------------------

PREFIX = ("node", "asked", "n", "at", "earlier", "root")


def _pairs(met: DataFrame, percent: int, every: bool) -> DataFrame:
    """Pairs (u, v), u > v, that meet as often as the lesser demand asks.  At
    each meeting the shingles put out before and all those behind must suffice
    for the similarity (two sets share no other before it); if ``met`` has every
    meeting, so must the meetings and the shingles behind the last one."""
    behind = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    enough = (F.least("earlier", "earlier2") + behind) * (100 + percent) >= (F.col("n") + F.col("n2")) * percent
    met = met.where(enough & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent))
    swap = F.col("node") < F.col("node2")

    def of(c: str, greater: bool):
        one, other = (f"{c}2", c) if greater else (c, f"{c}2")
        return F.when(swap, F.col(one)).otherwise(F.col(other))

    pair = met.select(
        of("node", True).alias("u"), of("node", False).alias("v"), F.least("asked", "asked2").alias("asked"),
        (of("n", True) - of("at", True) - 1).alias("left_u"), (of("n", False) - of("at", False) - 1).alias("left_v"),
        (F.col("n") + F.col("n2")).alias("both"))
    found = pair.groupBy("u", "v").agg(F.count("*").alias("k"), F.min("asked").alias("asked"), F.min("left_u").alias("left_u"),
                                       F.min("left_v").alias("left_v"), F.min("both").alias("both")).where("k >= asked")
    if every:
        most = F.col("k") + F.least("left_u", "left_v")
        found = found.where(most * (100 + percent) >= F.col("both") * percent)
    return found.select("u", "v")


def with_centres(rooted: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each node with the centres of its shingles."""
    order = [F.desc("weight") if turn == 0 else F.xxhash64("node", F.lit(turn)), F.col("node")]
    first = Window.partitionBy("token").orderBy(*order)
    centre = rooted.withColumn("turn", F.row_number().over(first)).where(
        F.col("turn") <= (CENTRES if turn else 1)).select("token", *[F.col(c).alias(f"{c}2") for c in PREFIX])
    return _pairs(rooted.join(centre, "token").where("node != node2 AND root != root2"), percent, every=False)


def across(rooted: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet often enough.  The shingles of
    few nodes put out every meeting; the nodes of a popular one meet in its
    groups, which put out the pairs alone."""
    size = rooted.groupBy("token").agg(F.count("*").alias("k"))
    sized = rooted.join(size, "token")
    few = sized.where(F.col("k") <= POPULAR)
    met = few.join(few.select("token", *[F.col(c).alias(f"{c}2") for c in PREFIX]), "token")
    alone = _pairs(met.where("root != root2 AND node < node2"), percent, every=True)
    return alone.unionByName(popular_pairs(sized, percent)).distinct()


def popular_pairs(sized: DataFrame, percent: int) -> DataFrame:
    """The pairs that meet often enough, and at a popular shingle.  Its nodes are
    dealt into blocks, and each pair of blocks is a group; a node comes with its
    whole prefix, so that a pair is counted once, at its first popular shingle."""
    whole = sized.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("asked", "n", "root")],
        F.collect_list(F.struct("token", "at", (F.col("k") > POPULAR).alias("popular"))).alias("met"),
        F.collect_list(F.when(F.col("k") > POPULAR, F.struct("token", "k"))).alias("meets"))
    dealt = whole.select("*", F.inline("meets")).withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node",
                        "asked", "n", "root", "met")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        token, x, y = (k.as_py() for k in key)
        one = _Block(group.filter(pc.equal(group["own"], x)))
        return _meeting(token, one, one if x == y else _Block(group.filter(pc.equal(group["own"], y))), percent)

    ship(sized.sparkSession)
    return rows.groupBy("token", "x", "y").applyInArrow(run, "u bigint, v bigint")


class _Block:
    """Nodes with their prefixes, as columns."""

    def __init__(self, rows: pa.Table):
        self.node, self.asked, self.n, self.root = (rows[c].to_numpy() for c in ("node", "asked", "n", "root"))
        met = rows["met"].combine_chunks()
        self.row = np.repeat(np.arange(len(rows)), met.value_lengths().to_numpy(zero_copy_only=False))
        self.token, self.at, self.popular = (c.to_numpy(zero_copy_only=False) for c in met.flatten().flatten())

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """A row per node, a column per token (ascending): its place from 1, or 0."""
        column = np.minimum(np.searchsorted(tokens, self.token), len(tokens) - 1)
        has = tokens[column] == self.token
        out = np.zeros((len(self.node), len(tokens)), np.int32)
        out[self.row[has], column[has]] = self.at[has] + 1
        return out


def _meeting(token: int, a: _Block, b: _Block, percent: int) -> pa.Table:
    """Pairs (u, v), u > v, of nodes of both blocks whose first popular shingle
    is ``token``, as in ``_pairs`` with every meeting."""
    common = np.intersect1d(a.token, b.token)
    hot = np.intersect1d(a.token[a.popular], b.token[b.popular])
    parts = [common[i:i + COLUMNS] for i in range(0, len(common), COLUMNS)]
    k, before = (np.zeros((len(a.node), len(b.node)), np.float32) for _ in range(2))
    for part in parts:
        p, q = ((x.places(part) > 0).astype(np.float32) for x in (a, b))
        k += p @ q.T
        sooner = np.isin(part, hot[hot < token])
        before += p[:, sooner] @ q[:, sooner].T
    n, n2 = a.n[:, None].astype(np.int64), b.n[None, :].astype(np.int64)
    fits = (k >= np.minimum(a.asked[:, None], b.asked[None, :])) & (before == 0) & (
        a.root[:, None] != b.root[None, :]) & (np.minimum(n, n2) * 100 >= np.maximum(n, n2) * percent)
    if a is b:
        fits = np.triu(fits, 1)
    i, j = np.nonzero(fits)
    last, last2 = (np.zeros(len(i), np.int32) for _ in range(2))
    for part in parts if len(i) else []:
        p, q = a.places(part), b.places(part)
        for at in range(0, len(i), COLUMNS):
            here = slice(at, at + COLUMNS)
            one, other = p[i[here]], q[j[here]]
            both = (one > 0) & (other > 0)
            last[here] = np.maximum(last[here], (one * both).max(axis=1))
            last2[here] = np.maximum(last2[here], (other * both).max(axis=1))
    most = k[i, j].astype(np.int64) + np.minimum(a.n[i] - last, b.n[j] - last2)
    kept = most * (100 + percent) >= (a.n[i].astype(np.int64) + b.n[j]) * percent
    u, v = a.node[i[kept]], b.node[j[kept]]
    return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})


def open_pairs(rooted: DataFrame) -> tuple[int, int]:
    """Meetings of nodes in different components, and prefix rows."""
    of_root = rooted.groupBy("token", "root").agg(F.count("*").cast("double").alias("k"))
    per_token = of_root.groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("own"))
    return tuple(per_token.agg(F.coalesce(F.sum((F.col("k") * F.col("k") - F.col("own")) / 2), F.lit(0.0)),
                               F.coalesce(F.sum("k"), F.lit(0.0))).first())


def similar(pairs: DataFrame, whole: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose texts (``whole``: node, text) are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        held: tuple[int | None, np.ndarray] = None, np.zeros(0, np.uint64)
        for b in batches:
            keep = []
            for v, s, t in zip(b.column("v").to_pylist(), b.column("text").to_pylist(), b.column("text2").to_pylist()):
                if held[0] != v:
                    held = v, shingler.of(t)
                mine, other = shingler.of(s), held[1]
                both = len(np.intersect1d(mine, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(mine) + len(other) - both))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(whole.select(F.col("node").alias("u"), "text"), "u")
    both = one.join(whole.select(F.col("node").alias("v"), F.col("text").alias("text2")), "v")
    return map_in_arrow(both.sortWithinPartitions("v"), run, "v bigint, u bigint").select("u", "v")


# -- components -------------------------------------------------------------------------

def _texts_of(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """(node, open, text) of the nodes that may have prefix shingles to put out.
    Texts are dealt once, by the columns that the join and the distinct rows
    share."""
    def keyed(df: DataFrame, *more) -> DataFrame:
        return df.select(F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), F.col("doc_id").isNull().alias("no_id"),
                         "text_key", *more)

    asked = keyed(counted, "node", "open")
    rows = keyed(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), "text")
    key = ["id", "no_id", "text_key"]
    return materialize(rows.join(asked, key).dropDuplicates([*key, "node"]).select("node", "open", "text"), "texts")


def prefixes(docs: DataFrame, rows: DataFrame, nodes: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(token, node, asked, n, at, earlier, weight): every node's prefix with
    the places in it, without the shingles that only one row has; and the texts
    of the nodes.  ``earlier`` counts the shingles before that are put out,
    ``weight`` is the mean number of rows of the node's counted
    shingles."""
    counted = counted_sets(rows, nodes, percent)
    whole = _texts_of(docs, counted)
    return materialize(closed_prefixes(counted, percent).unionByName(
        open_prefixes(counted, whole, words, percent)), "prefixes"), whole


def links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """A forest over the nodes: (u, v) names the smallest node of u's
    component."""
    prefix, whole = prefixes(docs, rows, nodes, words, percent)
    popular = prefix.groupBy("token").agg(F.count("*").alias("k")).where(F.col("k") > CENTRES)
    hot = prefix.join(popular, "token", "left_semi")
    found = forest = None
    before = float("inf")
    for turn in range(ROUNDS):
        hot = materialize(_undecided(_rooted(hot, forest)), "popular")
        pairs_left, rows_left = open_pairs(hot)
        if pairs_left <= FEW * rows_left or pairs_left > GAIN * before:
            break
        before = pairs_left
        found, forest = _linked(with_centres(hot, turn, percent), found, forest, whole, words, percent)
    rest = materialize(_undecided(_rooted(prefix, forest)), "rooted")
    return _linked(across(rest, percent), found, forest, whole, words, percent)[1]


def _rooted(prefix: DataFrame, forest: DataFrame | None) -> DataFrame:
    """``prefix`` with the root of each node's component."""
    if forest is None:
        return prefix.withColumn("root", F.col("node"))
    named = forest.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return prefix.drop("root").join(named, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _undecided(rooted: DataFrame) -> DataFrame:
    """Without the shingles all of whose nodes are in one component: they have
    nothing left to link, now or later."""
    mixed = rooted.groupBy("token").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p != q")
    return rooted.join(mixed, "token", "left_semi")


def _linked(pairs: DataFrame, found: DataFrame | None, forest: DataFrame | None, whole: DataFrame, words: int,
            percent: int) -> tuple[DataFrame, DataFrame]:
    """The links found so far and their forest, with those among ``pairs``."""
    new = similar(materialize(pairs, "pairs"), whole, words, percent)
    found = materialize(new if found is None else new.unionByName(forest), "found")
    return found, star_forest(found)


def components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id)."""
    rows = shingled(docs, words)
    nodes = distinct_sets(rows)
    forest = links(docs, rows, nodes, words, percent)
    rooted = nodes.join(forest.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "a", "b", "least", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("a", "b", "component_id")
    out = rows.where("n > 0").select("doc_id", "a", "b", F.col("n").cast("bigint").alias("n_shingles")).join(
        named, ["a", "b"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n = 0").select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"),
                                       F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)
