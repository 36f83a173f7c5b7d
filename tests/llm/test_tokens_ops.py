"""Operators on tokens against the libraries, whole round trips and brute force."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from admart.llm import queries, records
from admart.llm.packing import differencing, pack, part
from admart.llm.pieces import PieceEncoder, encode_decode
from admart.llm.records import read_records, token_records, unframe, write_records
from admart.llm.token_counts import token_counts
from admart.llm.tokens import WordMemo
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PIECES = P.path("piece_bpe_32k.model")
ALPHABET = list("aabethsi nér.,'\n\t 1<▁日İΣ　") + ["  ", "<s>", "<|endoftext|>", "ß", "aaaa", "====", "́", "🎉", " the", "ing", "    ", "\x1c", "\x85", " "]
texts = st.lists(st.sampled_from(ALPHABET), max_size=50).map("".join)


def u32(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


_PIECE = []


@settings(max_examples=400, deadline=None)
@given(texts)
def test_piece_encoder_equals_the_library(text):
    if not _PIECE:
        _PIECE.append(PieceEncoder(PIECES))
    enc = _PIECE[0]
    library = enc.model.library
    assert np.frombuffer(enc.encode(text), dtype="<i4").tolist() == library.encode(text)
    counts = [len(library.encode("\n" + p)) - len(library.encode("\n")) for p in enc.model.pretokens(text)]
    assert sum(counts) == len(library.encode(text))


def test_piece_encoder_backtracks_on_hard_words(library):
    enc = PieceEncoder(PIECES)
    rng = random.Random(3)
    vocab = [library.id_to_piece(i) for i in range(300, 32000, 7)]
    for text in ["a" * 3000, "=" * 4000, "ab" * 3000, *("".join(rng.choices(vocab, k=rng.randint(1, 6))).replace("▁", " ") for _ in range(3000))]:
        assert np.frombuffer(enc.encode(text), dtype="<i4").tolist() == library.encode(text), text[:60]


_MEMO: dict[str, WordMemo] = {}


@settings(max_examples=400, deadline=None)
@given(texts, st.sampled_from(["byte_bpe_50k.json", "word_bpe_49k.json"]))
def test_word_memo_equals_the_library(text, name):
    if name not in _MEMO:
        _MEMO[name] = WordMemo(P.path(name), 2)
    memo = _MEMO[name]
    assert np.frombuffer(memo.encode(text), dtype="<u2").tolist() == memo.tokenizer.encode(text, add_special_tokens=False).ids


def test_op2_every_row(spark, make_docs, hard_rows, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), r.decoded) for r in encode_decode(make_docs(hard_rows), PIECES).collect())
    want = sorted((d is None, d or 0, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in hard_rows)
    assert got == want
    assert encode_decode(make_docs([]), PIECES).collect() == []


def test_op2_query_digests(spark, sf_small, library):
    texts_ = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in queries.op2_sentencepiece(spark, sf_small).collect():
        ids = library.encode(texts_[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


@pytest.mark.parametrize("dictionary", [0, 30, 200_000])
def test_op8_counts(spark, make_docs, hard_rows, library, dictionary):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit)
                 for r in token_counts(make_docs(hard_rows), PIECES, limit=100, dictionary=dictionary).collect())
    want = sorted((d is None, d or 0, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for d, t in hard_rows)
    assert got == want


def test_op8_empty_table(make_docs):
    assert token_counts(make_docs([]), PIECES).collect() == []


def plain_crc32c(data):
    reg = 0xFFFFFFFF
    for byte in data:
        reg ^= byte
        for _ in range(8):
            reg = (reg >> 1) ^ (0x82F63B78 if reg & 1 else 0)
    return reg ^ 0xFFFFFFFF


def test_crc32c_known_and_random():
    assert records.crc32c([b"123456789"]).tolist() == [0xE3069283]
    rng = random.Random(5)
    parts = [rng.randbytes(rng.choice([4, 5, 8, 511, 512, 513, 1024, 1500, 2999])) for _ in range(40)]
    assert records.crc32c(parts).tolist() == [plain_crc32c(p) for p in parts]



def test_op4_round_trip(spark, make_docs, hard_rows, tmp_path):
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = make_docs(hard_rows)
    manifest = write_records(docs, str(tmp_path / "r"), P.path("byte_bpe_50k.json"), end_id=2, shards=5)
    got = sorted(read_records(spark, str(tmp_path / "r"), manifest).collect(), key=lambda r: r.start)
    coded = [lib.encode(t or "", add_special_tokens=False).ids + [2] for _, t in hard_rows]
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids)) for r in got) == sorted((d is None, d or 0, u32(c)) for (d, _), c in zip(hard_rows, coded))
    at = 0
    for r in got:  # gapless, ascending, nulls first
        assert r.start == at and r.n_ids == len(r.ids) // 4
        at += r.n_ids
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert not list((tmp_path / "r").glob("_tmp*"))


def test_op4_shuffled_read_and_damage(spark, make_docs, hard_rows, tmp_path):
    write_records(make_docs(hard_rows), str(tmp_path / "r"), P.path("byte_bpe_50k.json"), end_id=2, shards=2).collect()
    path = sorted((tmp_path / "r").glob("*.rec"))[0]
    data = path.read_bytes()
    index = records.read_index(path.with_suffix(".idx").read_bytes())
    some = index["offset"][::-3].tolist()  # any order
    assert [records.parse_payload(p)[0] or 0 for p in unframe(memoryview(data), some, "x")] == index["doc_id"][::-3].tolist()
    size, = struct.unpack_from("<Q", data, 0)
    for at in (0, 9, 14, 12 + size):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            unframe(memoryview(bytes(bad)), [0], "x")


def test_op4_empty_table(make_docs):
    assert token_records(make_docs([]), P.path("byte_bpe_50k.json"), end_id=2).collect() == []


def test_op4_query(spark, sf_small):
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = sorted(spark.read.parquet(f"{sf_small}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = {r.doc_id: r for r in queries.op4_token_records(spark, sf_small).collect()}
    at = 0
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids + [2]
        assert (got[d.doc_id].start, got[d.doc_id].n_tokens, got[d.doc_id].ids_crc32) == (at, len(ids), zlib.crc32(u32(ids)))
        at += len(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(1, 20))
def test_differencing_is_a_partition(sizes, k):
    window = differencing(sizes, k)
    assert len(window) == len(sizes) and 0 <= window.min() and window.max() < k
    if k > 1 and len(sizes) > 3 * k:  # near-equal: no worse than one largest size apart
        sums = np.bincount(window, weights=sizes, minlength=k)
        assert sums.max() - sums.min() <= max(sizes)


def test_differencing_by_hand():
    # two windows: 8 and 7 differ by 1, 6 and 5 by 1, 4; then 4 - 1 = 3, 3 - 1 = 2
    sums = np.bincount(differencing([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])
    assert sorted(sums.tolist()) == [14, 16]


@given(st.lists(st.integers(1, 64), min_size=1, max_size=80))
@settings(max_examples=60, deadline=None)
def test_part_keeps_to_the_capacity(sizes):
    window, k = part(sizes, 64)
    assert np.bincount(window, weights=sizes, minlength=k).max() <= 64


def check_pieces(rows, docs, capacity):
    """Every id of every document once, sequences gapless and within the capacity; returns padding."""
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(lib.encode(t or "", add_special_tokens=False).ids + [1])
    assert set(of_doc) == set(want)
    for d, coded in want.items():
        if len(coded) == 1:
            pieces = sorted(of_doc[d], key=lambda r: r.start)
            assert b"".join(bytes(r.ids) for r in pieces) == u32(coded[0])
            assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
            assert {r.doc_tokens for r in pieces} == {len(coded[0])}
        else:
            assert sum(r.length for r in of_doc[d]) == sum(map(len, coded))
    for pieces in of_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert sum(r.length for r in pieces) <= capacity
    total = sum(r.length for r in rows)
    return 1 - total / (capacity * len(of_sequence))


def test_op10_pieces(make_docs, hard_rows):
    rows = pack(make_docs(hard_rows, parts=1), P.path("word_bpe_49k.json"), end_id=1, capacity=64, group_windows=40, small_piece=8).collect()
    assert check_pieces(rows, hard_rows, 64) < 0.1
    assert pack(make_docs([]), P.path("word_bpe_49k.json"), end_id=1).collect() == []


def test_op10_query_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs, P.path("word_bpe_49k.json"), end_id=1).collect()
    assert check_pieces(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048) < 0.01
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in queries.op10_packing(spark, "/root/testdata/sf0.01").collect()}
    assert crc == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}
