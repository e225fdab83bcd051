"""Operators 2, 8 and 10: encodings against the libraries, files, packing."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from postlens.llm import chunked, config_packing, prefix_bpe, token_file
from postlens.llm.common import read

from llm_help import SF_SMALL, awkward, by_row, none, texts_of  # noqa: F401

MULTI = "byte_bpe_multi_50k.tiktoken"
ODD = " \n\t\r\x1c\x85\xa0　abcé漢字🙂0129'sre!?.́​ÀßİΣς~^|K"


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.encoder(MULTI, P.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks.rank, special_tokens={})


def odd_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_prefix_encoding_is_the_librarys(encoder, library):
    texts = odd_texts(3000)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [
        library.encode_ordinary(t) for t in texts]


def test_edits_reencode_exactly(encoder, library):
    r = random.Random(2)
    for text in odd_texts(150, 3):
        own = prefix_bpe.EditableText(encoder, text)
        for _ in range(4):
            a = r.randint(0, len(text))
            b = r.randint(a, min(len(text), a + 5))
            new = "".join(r.choice(ODD) for _ in range(r.randint(0, 5)))
            text = text[:a] + new + text[b:]
            own.replace(a, b, new)
            assert own.tokens() == library.encode_ordinary(text)
        own.append("'s end")
        assert own.tokens() == library.encode_ordinary(text + "'s end")


def test_edit_near_the_middle_fills_few_entries(encoder):
    data = ("the quick brown fox jumps over " * 60).encode()
    table = prefix_bpe.Prefixes(encoder.ranks, data)
    filled = table.replace(900, 903, b"xyz")
    assert filled < 3 * encoder.ranks.longest < len(data)
    assert table.last == prefix_bpe.Prefixes(encoder.ranks, table.data).last


def test_op2_digests(awkward, none, library):
    rows = prefix_bpe.digests(awkward, MULTI, P.PATTERN).collect()
    want = []
    for doc, text in texts_of(awkward):
        ids = np.asarray(library.encode_ordinary(text), "<u4")
        want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert by_row(map(tuple, rows)) == by_row(want)
    assert prefix_bpe.digests(none, MULTI, P.PATTERN).count() == 0


def library_ids(file, texts, end):
    model = Tokenizer.from_file(P.path(file))
    model.encode_special_tokens = True
    return [np.asarray([*e.ids, end], "<u4") for e in model.encode_batch(texts, add_special_tokens=False)]


def test_blocks_of_small_ids_are_ranked_without_a_sort(monkeypatch):
    r = np.random.default_rng(4)
    blocks = [(r.zipf(1.3, 5000) % 50000).astype("<u4"), np.zeros(0, "<u4"), np.array([7], "<u2"),
              np.arange(300, dtype="<u4")]
    with monkeypatch.context() as m:
        m.setattr(token_file, "TABLE_IDS", 0)
        sorted_out = [token_file.pack_ids(ids) for ids in blocks]
    monkeypatch.delattr(np, "unique")
    assert [token_file.pack_ids(ids) for ids in blocks] == sorted_out


@pytest.mark.parametrize("file,make", [("byte_bpe_50k.json", chunked.byte_level),
                                       ("word_bpe_49k.json", chunked.word_level)])
def test_chunks_encode_as_whole_texts(file, make):
    texts = [*odd_texts(2000), "<|endoftext|> a", "", " ", "a  b \n c", "x" * 500, " ~ | ^ "]
    assert make(file)(texts) == [x[:-1].tobytes() for x in library_ids(file, texts, 0)]


def test_id_code_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 70000, 300000):
        ids = (r.pareto(0.6, n) * 10).astype(np.uint64).clip(0, (1 << 32) - 1).astype("<u4")
        packed = token_file.pack_ids(ids)
        assert (token_file.unpack_ids(n, *packed) == ids).all()


def test_op8_starts_and_checksums(spark, awkward, none, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_TOKENS", 3000)
    rows = token_file.digests(awkward, "byte_bpe_50k.json", 2).collect()
    docs = texts_of(awkward)
    want = Counter((d, len(i), zlib.crc32(i.tobytes())) for (d, _), i in
                   zip(docs, library_ids("byte_bpe_50k.json", [t for _, t in docs], 2)))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
    assert ids == sorted(ids)
    assert token_file.digests(none, "byte_bpe_50k.json", 2).count() == 0


def check_packing(rows, docs, capacity):
    want = []
    for (doc, _), ids in zip(docs, library_ids("word_bpe_49k.json", [t for _, t in docs], 0)):
        want += [(doc, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                 for k, s in enumerate(range(0, len(ids), capacity))]
    assert by_row(tuple(r)[:5] for r in rows) == by_row(want)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held), -(-sum(r["length"] for r in rows) // capacity)


def test_op10_packs_everything_once(spark, awkward, none):
    rows = config_packing.pack_documents(awkward, "word_bpe_49k.json", 0, 512).collect()
    used, least = check_packing(rows, texts_of(awkward), 512)
    assert used <= least + 1
    assert config_packing.pack_documents(none, "word_bpe_49k.json", 0, 512).count() == 0
    docs = read(spark, SF_SMALL, "documents")
    rows = config_packing.pack_documents(docs, "word_bpe_49k.json", 0, 2048).collect()
    used, least = check_packing(rows, texts_of(docs), 2048)
    assert used <= least * 1.01 + 1


def test_packed_sequences_hold_the_ids(awkward):
    small = awkward.where("doc_id < 40 OR doc_id IS NULL")
    parts = config_packing.pieces(small, "word_bpe_49k.json", 0, 256, keep_ids=True)
    packed = config_packing.pack_documents(small, "word_bpe_49k.json", 0, 256)
    made = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4")
            for r in config_packing.sequences(packed, parts).collect()}
    for r in packed.collect():
        ids = made[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("n,times", [(0, 1), (40, 1), (400, 1), (3000, 1), (3000, 50)])
def test_plan_is_whole_and_close_to_the_bound(n, times):
    r = np.random.default_rng(n)
    length = np.minimum(2048, np.maximum(1, r.lognormal(6, 1.2, n).astype(int)))
    count = {int(a): int(b) * times for a, b in zip(*np.unique(length, return_counts=True))}
    made = config_packing.plan(count, 2048)
    got = Counter()
    for config, uses in made:
        assert sum(a * b for a, b in config.items()) <= 2048
        for a, b in config.items():
            got[a] += b * uses
    assert got == Counter(count)
    least = -(-sum(a * b for a, b in count.items()) // 2048)
    assert sum(uses for _, uses in made) <= least * 1.01 + 2


def test_linear_program_is_feasible_and_tight():
    r = np.random.default_rng(1)
    length = np.minimum(2047, np.maximum(1, r.lognormal(6, 1, 50000).astype(int)))
    count = {int(a): int(b) for a, b in zip(*np.unique(length, return_counts=True))}
    uses = config_packing.linear_program(count, 2048)
    used = Counter()
    for config, x in uses:
        for a, b in config.items():
            used[a] += b * x
    assert all(used[a] <= count[a] * (1 + 1e-9) for a in used)
    covered = sum(a * x for a, x in used.items())
    assert sum(x for _, x in uses) <= covered / 2048 * 1.01


def test_what_is_met_again_is_not_encoded_anew_when_the_memo_is_full(monkeypatch):
    monkeypatch.setattr(prefix_bpe, "MEMO_ENTRIES", 50)
    encode = prefix_bpe.Encoder(prefix_bpe.Ranks(P.path(MULTI)),
                                P.PATTERN)
    filled, become = [], prefix_bpe.Prefixes.become

    def counting(self, data):
        filled.append(data)
        return become(self, data)

    monkeypatch.setattr(prefix_bpe.Prefixes, "become", counting)
    out = [encode([" ".join(["start", "qzxwvkjq", *(f"zq{i}xw{k}v" for k in range(80))])])[0] for i in range(6)]
    assert filled.count(b" qzxwvkjq") == 1
    assert len({ids[:ids.index(np.asarray(encode.piece(" qzxwvkjq"), "<u4").tobytes())] for ids in out}) == 1
    assert len(encode.memo.young) + len(encode.memo.old) < 400


def test_prefixes_filled_when_asked_for():
    ranks = prefix_bpe.Ranks(P.path(MULTI))
    table = prefix_bpe.Prefixes(ranks)
    for data in sorted([b"", b"th", b"thereinthe", b"thereintheand", b"zqzqther", b"a" * 300, b"a" * 300 + b"the"]):
        table.become(data)
        assert table.tokens() == prefix_bpe.Prefixes(ranks, data).tokens()
    table.become(b"thereintheandthere")
    table.tokens()
    assert None in table.last
    table.append(b"the")
    assert table.tokens() == prefix_bpe.Prefixes(ranks, b"thereintheandtherethe").tokens()
