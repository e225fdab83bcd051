"""Token-id files: frequency-ranked ids in byte-aligned variable-length code.

The ids of the documents, in ascending id order, are cut into blocks.  A
block ranks its own ids by frequency and stores, apart from each other,

* ``ranked``: the block's distinct ids, the most frequent first,
* ``control``: two bits per token, four tokens to a byte: how many bytes its
  rank takes (1 to 4), lowest bits first,
* ``data``: the ranks' bytes, little-endian, without the leading zeros,
* ``doc_ids`` and ``lengths``: the documents and how many tokens each has.

Since control and data are apart, a block is decoded without a loop: a table
turns each control byte into four lengths, their running sum says where each
rank begins, and ``ranked`` turns ranks back into ids.  The container is
Parquet (one row per block, in file ``file`` at place ``block``), so that
any store Spark reads and writes will do.

Documents are dealt to files by ranges of their id; equal ids at the border
of a range may go to either side.  A file is made in blocks of bounded size,
so no task holds more than one block.

Defined results: a null text is the empty text and has the end id alone; a
null document id sorts before all others; repeated rows are all kept; an
empty table gives no block; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .chunked import byte_level
from .common import map_in_arrow, texts

BLOCK_TOKENS = 1 << 21
TABLE_IDS = 1 << 22             # blocks whose ids are all below have a table over them
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1

BLOCK_SCHEMA = ("file int, block int, n_tokens bigint, doc_ids array<bigint>, "
                "lengths array<bigint>, ranked binary, control binary, data binary")
DOCUMENT_SCHEMA = "file int, block int, in_block bigint, doc_id bigint, ids binary"


def pack_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ranked, control, data) of one block of ids."""
    if ids.max(initial=0) < TABLE_IDS:         # counted in a table, without a sort of the ids
        count = np.bincount(ids)
        distinct, inverse = np.flatnonzero(count), ids
        count = count[distinct]
    else:
        distinct, inverse, count = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((distinct, -count))
    at = distinct if inverse is ids else np.arange(len(distinct))
    place = np.zeros(at.max(initial=0) + 1, "<u4")
    place[at[order]] = np.arange(len(order), dtype="<u4")
    ranks = place[inverse]
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    four[:len(code)] = code
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return distinct[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def unpack_ids(n: int, ranked: bytes, control: bytes, data: bytes) -> np.ndarray:
    """The ``n`` ids of a block."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begin = np.cumsum(length, dtype=np.int64) - length
    raw = np.frombuffer(data, np.uint8)
    ranks = raw[begin].astype("<u4")
    for k in (1, 2, 3):
        at = np.flatnonzero(length > k)
        if len(at):
            ranks[at] |= raw[begin[at] + k].astype("<u4") << np.uint32(8 * k)
    return np.frombuffer(ranked, "<u4")[ranks]


def _borders(docs: DataFrame, files: int) -> np.ndarray:
    """Ids that cut the documents into ``files`` ranges of like row counts."""
    if files < 2:
        return np.zeros(0, np.int64)
    cuts = docs.approxQuantile("doc_id", [k / files for k in range(1, files)], 0.25 / files)
    return np.asarray(cuts).astype(np.int64)


def encode(docs: DataFrame, vocab: str, end_id: int, files: int) -> DataFrame:
    """Rows (file, doc_id, ids): every whole text with the end id appended,
    and the file it goes to."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    borders = _borders(docs.select("doc_id"), files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = byte_level(vocab), np.asarray([end_id], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                ids = [x + end for x in coder(texts(b.column("text")))]
                doc = b.column("doc_id")
                key = doc.fill_null(np.iinfo(np.int64).min).to_numpy()
                low, high = np.searchsorted(borders, key), np.searchsorted(borders, key, "right")
                spread = np.array([zlib.crc32(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low + spread % (high - low + 1), pa.int32()), doc,
                     pa.array([_narrow(x) for x in ids], pa.binary())],
                    names=["file", "doc_id", "ids"])

    return map_in_arrow(docs, run, "file int, doc_id bigint, ids binary")


def _narrow(ids: bytes) -> bytes:
    """Ids on the way to their file: the first byte says how wide they are."""
    wide = np.frombuffer(ids, "<u4")
    return b"\2" + wide.astype("<u2").tobytes() if wide.max(initial=0) < 65536 else b"\4" + ids


def _wide(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if ids[0] == 2 else "<u4", offset=1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int | None, np.ndarray]] = []
    file, block, size = None, 0, 0

    def made() -> pa.RecordBatch:
        ids = np.concatenate([x for _, x in held])
        row = [file, block, len(ids), [d for d, _ in held], [len(x) for _, x in held],
               *pack_ids(ids)]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                 pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, types)],
            names=["file", "block", "n_tokens", "doc_ids", "lengths", "ranked", "control", "data"])

    for b in batches:
        for f, doc, ids in zip(*(b.column(k).to_pylist() for k in ("file", "doc_id", "ids"))):
            if held and (f != file or size >= BLOCK_TOKENS):
                yield made()
                block = block + 1 if f == file else 0
                held, size = [], 0
            file = f
            held.append((doc, _wide(ids)))
            size += len(held[-1][1])
    if held:
        yield made()


def write(docs: DataFrame, path: str, vocab: str, end_id: int, files: int | None = None) -> None:
    """Write the files under ``path``; ``files``: how many ranges of ids (by
    default as many as the session's shuffle partitions)."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = encode(docs, vocab, end_id, files).repartitionById(files, F.col("file"))
    ordered = dealt.sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), F.crc32("ids"))
    (map_in_arrow(ordered, _blocks, BLOCK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(path))


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, block, in_block, doc_id, ids): each document with its ids
    as little-endian unsigned 32-bit integers, and how many ids of its block
    stand before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = unpack_ids(row["n_tokens"], row["ranked"], row["control"], row["data"])
                raw, end = ids.tobytes(), np.cumsum(row["lengths"])
                begin = end - row["lengths"]
                for at in range(0, len(end), 4096):
                    part = slice(at, at + 4096)
                    n = len(end[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["file"]] * n, pa.int32()),
                         pa.array([row["block"]] * n, pa.int32()),
                         pa.array(begin[part], pa.int64()),
                         pa.array(row["doc_ids"][part], pa.int64()),
                         pa.array([raw[4 * i:4 * j] for i, j in zip(begin[part], end[part])],
                                  pa.binary())],
                        names=["file", "block", "in_block", "doc_id", "ids"])

    return map_in_arrow(spark.read.schema(BLOCK_SCHEMA).parquet(path), run, DOCUMENT_SCHEMA)


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, block_start): the ids of all blocks before each one,
    summed by file first, then over the files."""
    index = (spark.read.schema(BLOCK_SCHEMA).parquet(path)
             .select("file", "block", F.col("n_tokens").alias("n")))
    files = index.groupBy("file").agg(F.sum("n").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(
            Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return index.join(files, "file").select(
        "file", "block",
        (F.col("file_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("block_start"))


def digests(docs: DataFrame, vocab: str, end_id: int) -> DataFrame:
    """Write the files, read them back, and return per document: the ids of
    all documents before it, its own number of ids, and their checksum."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-file")
    write(docs, path, vocab, end_id)
    back = read_back(spark, path).select(
        "file", "block", "in_block", "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return back.join(block_starts(spark, path), ["file", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32")
