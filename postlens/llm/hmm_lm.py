"""Hidden Markov language model over whole texts.

Tokens are the lower-cased words of a text and an end token.  The model has
``STATES`` latent states that emit symbols: each of the ``SYMBOLS`` most
frequent tokens is a symbol of its own, the others share a symbol with the
words of their class (a hash of their last two bytes) and are drawn from the
class with smoothed frequencies.  So the probabilities of all words, and one
slot for unknown ones in each class, add up to one.

Baum-Welch trains the states: each partition computes the expected counts of
its sequences by scaled forward and backward recursions, and the partitions'
counts, whose size is that of the model, are added in a tree.  For training
only, sequences are cut into segments of ``SEGMENT`` tokens.  The score of a
text is its exact likelihood: the scaled forward recursion over all of it.

Token counts cover all training texts.  The ``HEAD`` most frequent tokens
(a fixed number, of bounded length) are broadcast; the other tokens of each
text meet their counts in a join.  The numpy code runs many sequences side
by side, one step of all of them at a time.

Defined results: a null text is the empty text and has the end token alone;
a null ``doc_id`` counts as the empty text where it is hashed, so the row is
held out; repeated rows are scored alike (and each counts in training);
without training texts every probability is that of an unknown token; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_in_arrow, materialize, texts

STATES = 8
SYMBOLS = 4096          # tokens with a symbol of their own
CLASSES = 512           # symbols for the others
HEAD = 1 << 18          # tokens whose counts are broadcast
HEAD_BYTES = 32         # longer tokens are never among them
ITERATIONS = 4
SEGMENT = 1024          # tokens of a training sequence
ALPHA = 0.1             # added to counts
END = b"\n"             # no word has white space
COUNTER_ENTRIES = 300_000
FOLDS = 10

ALL = SYMBOLS + CLASSES
KEY = ("doc_id", "text_hash")


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased; bytes split at the ASCII white space alone."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def class_of(word: bytes) -> int:
    return SYMBOLS + zlib.crc32(word[-2:]) % CLASSES


# -- counts ---------------------------------------------------------------------

def token_counts(training: DataFrame) -> DataFrame:
    """(word, n) of all training tokens.  Tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[bytes] = Counter()

        def held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())],
                names=["word", "n"])

        for b in batches:
            for text in texts(b.column("text")):
                count.update(words_of(text))
                count[END] += 1
                if len(count) > COUNTER_ENTRIES:
                    yield held()
                    count = Counter()
        if count:
            yield held()

    return map_in_arrow(training.select("text"), run, "word binary, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))


class Vocabulary:
    """What the tasks need of the counts: the head, and the classes' sizes."""

    def __init__(self, counts: DataFrame):
        row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        self.tokens, self.types = int(row[0]), int(row[1])
        top = counts.where(F.octet_length("word") <= HEAD_BYTES).where(F.col("word") != F.lit(END)) \
            .orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
        ends = counts.where(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.words = [END, *top.column("word").to_pylist()][:HEAD]
        n = np.array([ends, *top.column("n").to_pylist()][:HEAD], np.float64)
        self.symbol = np.array([i if i < SYMBOLS else class_of(w) for i, w in enumerate(self.words)], np.int32)
        # tokens and types of each class: of all its words, symbols not counted
        sums = np.zeros((ALL, 2))
        for r in _class_sums(counts, set(self.words[:SYMBOLS])).collect():   # CLASSES rows
            sums[r["symbol"]] = r["n"], r["types"]
        self.count = np.where(np.arange(ALL) < SYMBOLS, 0.0, sums[:, 0])
        own = min(SYMBOLS, len(self.words))
        self.count[:own] = n[:own]
        self.class_norm = np.log10(sums[:, 0] + ALPHA * (sums[:, 1] + 1))
        self.norm = float(np.log10(self.tokens + ALPHA * (self.types + 1)))
        self.base = np.log10(n + ALPHA) - self.norm
        self.inside = np.where(np.arange(len(n)) < SYMBOLS, 0.0,
                               np.log10(n + ALPHA) - self.class_norm[self.symbol])
        self.known = n > 0


def _class_sums(counts: DataFrame, symbols: set[bytes]) -> DataFrame:
    """(symbol, n, types) of the classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, types = np.zeros(ALL), np.zeros(ALL)
        for b in batches:
            for word, c in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
                if word not in symbols:
                    k = class_of(word)
                    n[k] += c
                    types[k] += 1
        at = np.flatnonzero(types)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(types[at])],
                                         names=["symbol", "n", "types"])

    return map_in_arrow(counts, run, "symbol int, n double, types double").groupBy("symbol").agg(
        F.sum("n").alias("n"), F.sum("types").alias("types"))


CODED = ("doc_id bigint, text_hash bigint, held_out boolean, n_tokens bigint, n_known bigint, "
         "base double, inside double, symbols binary, tail array<struct<word:binary,n:int>>")


def encode(docs: DataFrame, vocabulary) -> DataFrame:
    """Per text: what the head says of it, its symbols (little-endian
    unsigned 16 bits), and its tokens outside the head with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        if not hasattr(v, "place"):
            v.place = {w: i for i, w in enumerate(v.words)}
        get = v.place.get
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b, rows = whole.slice(at, 512), []
                for text in texts(b.column("text")):
                    words = words_of(text)
                    words.append(END)
                    place = np.array([get(w, -1) for w in words], np.int64)
                    tail = np.flatnonzero(place < 0)
                    head = place[place >= 0]
                    symbols = v.symbol[place]
                    count = Counter([words[i] for i in tail.tolist()])
                    symbols[tail] = [class_of(words[i]) for i in tail.tolist()]
                    rows.append((
                        len(words), int(v.known[head].sum()),
                        float(v.base[head].sum()) - len(tail) * v.norm,
                        float(v.inside[head].sum() - v.class_norm[symbols[tail]].sum()),
                        symbols.astype("<u2").tobytes(),
                        [{"word": w, "n": n} for w, n in count.items()]))
                cols = list(zip(*rows)) or [()] * 6
                types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(),
                         pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k) for k in ("doc_id", "text_hash", "held_out")),
                     *(pa.array(c, t) for c, t in zip(cols, types))],
                    names=[c.split()[0] for c in CODED.split(", ")])

    return map_in_arrow(docs, run, CODED)


# -- the model --------------------------------------------------------------------

class Model:
    """start (K), move (K x K), emit (symbols x K): probabilities."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, count: np.ndarray) -> Model:
        """Frequencies, disturbed by fixed pseudo-random factors, so that the
        states differ."""
        random = np.random.default_rng(0)
        emit = (count + ALPHA)[:, None] * np.exp(random.normal(0, 0.7, (len(count), STATES)))
        move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))

    def learned(self, counts: np.ndarray, frequency: np.ndarray) -> Model:
        """From expected counts: rows for symbols, then moves, then starts."""
        emit = counts[:ALL] + ALPHA * frequency[:, None] * len(frequency) / ALL + ALPHA / ALL
        move = counts[ALL:ALL + STATES] + ALPHA
        start = counts[ALL + STATES] + ALPHA
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Lanes:
    """Sequences side by side: each lane holds some of them, one after the
    other; lanes are sorted by length, so those still running at a step are
    the first ones."""

    def __init__(self, sequences: list[np.ndarray]):
        import heapq

        sizes = np.array([len(s) for s in sequences])
        steps = max(int(sizes.max()), SEGMENT)
        n = max(1, -(-int(sizes.sum()) // steps))
        heap = [(0, k) for k in range(n)]
        held: list[list[int]] = [[] for _ in range(n)]
        for i in np.argsort(-sizes, kind="stable").tolist():
            length, k = heapq.heappop(heap)
            held[k].append(i)
            heapq.heappush(heap, (length + int(sizes[i]), k))
        lengths = np.array([sizes[h].sum() for h in held])
        order = np.argsort(-lengths, kind="stable")
        self.steps = int(lengths.max())
        self.symbols = np.zeros((self.steps, n), np.int32)
        self.begins = np.zeros((self.steps + 1, n), bool)
        self.where = np.zeros((len(sequences), 2), np.int64)    # lane, first step
        for lane, k in enumerate(order.tolist()):
            at = 0
            for i in held[k]:
                self.symbols[at:at + sizes[i], lane] = sequences[i]
                self.begins[at, lane] = True
                self.where[i] = lane, at
                at += int(sizes[i])
        self.sizes = sizes
        # lanes running at each step
        self.running = np.searchsorted(-lengths[order], -np.arange(self.steps), "left")


def forward(model: Model, lanes: Lanes, keep: bool):
    """Scales of every step and lane; with ``keep`` also the scaled forward
    variables.  States are rows here, so that every operation runs along the
    lanes."""
    steps, n = lanes.symbols.shape
    scale = np.ones((steps, n))
    kept = np.zeros((steps, STATES, n)) if keep else None
    move, start = np.ascontiguousarray(model.move.T), model.start[:, None]
    emit = np.ascontiguousarray(model.emit.T)
    a = np.zeros((STATES, n))
    for t in range(steps):
        n = lanes.running[t]
        a = move @ a[:, :n]
        first = lanes.begins[t, :n]
        a *= ~first
        a += start * first
        a *= emit.take(lanes.symbols[t, :n], axis=1)
        s = a.sum(0)
        a /= s
        scale[t, :n] = s
        if keep:
            kept[t, :, :n] = a
    return scale, kept


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Of each whole sequence."""
    lanes = Lanes(sequences)
    logs = np.log10(forward(model, lanes, False)[0])
    return np.array([logs[a:a + n, k].sum() for (k, a), n in zip(lanes.where, lanes.sizes)])


def expected_counts(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Forward and backward: rows for symbols, moves and starts."""
    lanes = Lanes(sequences)
    scale, a = forward(model, lanes, True)
    emit = np.ascontiguousarray(model.emit.T)
    moves = np.zeros((STATES, STATES))
    b = np.ones((STATES, 0))
    for t in range(lanes.steps - 1, -1, -1):
        n, later = lanes.running[t], b.shape[1]
        here = np.ones((STATES, n))
        if later:
            goes_on = ~lanes.begins[t + 1, :later]
            ahead = emit.take(lanes.symbols[t + 1, :later], axis=1)
            ahead *= b
            ahead *= goes_on / scale[t + 1, :later]
            moves += a[t, :, :later] @ ahead.T
            here[:, :later] = model.move @ ahead
            here[:, :later] += ~goes_on
        b = here
        a[t, :, :n] *= b        # now the state probabilities
    out = np.zeros((ALL + STATES + 1, STATES))
    running = np.arange(lanes.symbols.shape[1]) < lanes.running[:, None]
    symbols = lanes.symbols[running]
    for k in range(STATES):
        state = a[:, k]
        out[:ALL, k] = np.bincount(symbols, state[running], ALL)
        out[ALL + STATES, k] = state[lanes.begins[:-1]].sum()
    out[ALL:ALL + STATES] = moves * model.move
    return out


def _sequences(b: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in b.column("symbols").to_pylist()]


def _batched(parts: Iterator, size, most: int) -> Iterator[list]:
    held, n = [], 0
    for x in parts:
        held.append(x)
        n += size(x)
        if n >= most:
            yield held
            held, n = [], 0
    if held:
        yield held


def _sum_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((ALL + STATES + 1) * STATES)
    for b in batches:
        for x in b.column("counts").to_pylist():
            total += np.frombuffer(x, np.float64)
    if total.any():
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])


def train(coded: DataFrame, count: np.ndarray) -> Model:
    """Baum-Welch over all training texts.  The driver sees tables of the
    model's size, at most 16 a round."""
    spark = coded.sparkSession
    training = coded.where("NOT held_out").select("symbols")
    frequency = (count + ALPHA) / (count + ALPHA).sum()
    model = Model.first(count)
    for _ in range(ITERATIONS):
        sent = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros((ALL + STATES + 1, STATES))
            segments = (s[i:i + SEGMENT] for b in batches for s in _sequences(b)
                        for i in range(0, len(s), SEGMENT))
            for part in _batched(segments, len, 500_000):
                total += expected_counts(sent.value, part)
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

        tables = map_in_arrow(training, run, "counts binary")
        parts = training.rdd.getNumPartitions()
        while parts > 16:
            parts = -(-parts // 16)
            tables = map_in_arrow(tables.repartition(parts), _sum_tables, "counts binary")
        counts = np.zeros((ALL + STATES + 1) * STATES)
        for r in tables.collect():
            counts += np.frombuffer(r["counts"], np.float64)
        model = model.learned(counts.reshape(-1, STATES), frequency)
        sent.unpersist()
    return model


def likelihoods(coded: DataFrame, model: Model) -> DataFrame:
    """``coded`` without symbols and tail, with ``chain``: the log10
    probability of the symbols."""
    sent = coded.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "text_hash", "held_out", "n_tokens", "n_known", "base", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64))
        for held in _batched(small, lambda b: b.column("symbols").nbytes // 2, 2_000_000):
            b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in names), pa.array(log10_likelihoods(sent.value, _sequences(b)))],
                names=[*names, "chain"])

    return map_in_arrow(coded.select(*names, "symbols"), run,
                        "doc_id bigint, text_hash bigint, held_out boolean, n_tokens bigint, "
                        "n_known bigint, base double, inside double, chain double")


def score(docs: DataFrame) -> DataFrame:
    """The scores of all texts, by models of those not held out."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % FOLDS
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64("text").alias("text_hash"), (fold == 0).alias("held_out"))
    counts = materialize(token_counts(docs.where("NOT held_out")), "token-counts")
    v = Vocabulary(counts)
    coded = materialize(encode(docs, docs.sparkSession.sparkContext.broadcast(v)), "coded")
    model = train(coded, v.count)

    # tokens outside the head: log10(count + ALPHA), and whether it is known.
    # Rows that repeat a key add up, and are divided by how many they are.
    tail = coded.select(*KEY, F.explode("tail").alias("t")).select(
        *KEY, F.col("t.word").alias("word"), F.col("t.n").alias("times"))
    met = tail.join(counts, "word", "left").select(
        *KEY, (F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + ALPHA)).alias("logs"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).cast("bigint").alias("found"),
        F.lit(0).cast("bigint").alias("rows"))
    each = coded.select(*KEY, F.lit(0.0).alias("logs"), F.lit(0).cast("bigint").alias("found"),
                        F.lit(1).cast("bigint").alias("rows"))
    rest = met.unionByName(each).groupBy(*KEY).agg(
        (F.sum("logs") / F.sum("rows")).alias("logs"),
        (F.sum("found") / F.sum("rows")).cast("bigint").alias("found")).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "logs", "found")
    return likelihoods(coded, model).join(
        rest, F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("text_hash").eqNullSafe(F.col("_hash"))).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("found")).alias("n_known"),
        F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("logs")).alias("base_score"),
        (F.col("chain") + F.col("inside") + F.col("logs")).alias("score"))
