"""Token operators against the tokenizer libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from millrace.llm import bpe_codec, packing, token_counts, token_files
from millrace.llm.runtime import documents, ready
from millrace.llm.tokens import PIECE_BYTES, PieceIds, json_encoder, tokenizer_path
from millrace.session import scratch_path

JSON = tokenizer_path("byte_bpe_50k.json")
RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
PARTS = list("ab'st1 .!\n\t\r é") + [
    "\x1c", "\x85", " ", "　", "  ", "\n\n", " \n", "\n ", "'s", "don't", "中文", "१", "<|endoftext|>", "x" * 300,
]


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(800)]
    return ["", " ", "\n", "a\n", " a", "a  b", "a\n b", *made, "word " * 30_000]


@pytest.fixture(scope="module")
def small(spark, odd_texts):
    rows = [(k, t, "x", 1) for k, t in enumerate(odd_texts)]
    rows += [(None, "no id", "x", 1), (3, None, None, None), (5, "again", "y", 2), (5, "again", "y", 2)]
    ready(spark)
    columns = "doc_id bigint, text string, n_tokens string, length int"  # names the results use too
    return spark.createDataFrame(rows, columns).repartition(3, "doc_id")


def test_memo_equals_library(library, odd_texts):
    encoder = json_encoder(JSON)
    assert encoder.counts(odd_texts) == [len(e) for e in encoder(odd_texts)]
    for text, data in zip(odd_texts, encoder(odd_texts)):
        assert data.tolist() == library.encode(text, add_special_tokens=False).ids


def lengths_as_ids(pieces):
    """One id per piece, its length."""
    return np.array([len(p) for p in pieces], np.uint32), np.arange(len(pieces)), np.ones(len(pieces), np.int64)


def test_memo_forgets_and_takes_over():
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return lengths_as_ids(pieces)

    memo = PieceIds(encode, limit=2 * 3 * PIECE_BYTES, longest=5)
    for pieces in (["a", "bb", "ccc", "dddd"], ["bb", "e"], ["a", "fff", "toolong", "g", "toolong"], ["x", "toolong"]):
        got, length = memo(pieces)
        assert got.tolist() == [len(p) for p in pieces] and length.tolist() == [1] * len(pieces)
    assert asked.count("a") == asked.count("bb") == 1  # taken over from the older generation
    assert asked.count("toolong") == 2  # once a call
    assert "ccc" not in memo.young


def test_memory_of_long_pieces_is_bounded():
    import tracemalloc

    memo = PieceIds(lambda ps: (np.zeros(500 * len(ps), np.uint32), 500 * np.arange(len(ps)), np.full(len(ps), 500)), limit=4 << 20)
    rng = random.Random(1)
    words = lambda n: ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(n)) for _ in range(400)]
    memo(words(500))
    tracemalloc.start()
    for _ in range(20):
        memo(words(500))  # longer than what is remembered
        memo(words(40))
    assert tracemalloc.get_traced_memory()[0] < 16 << 20
    tracemalloc.stop()


def test_packing_heap_equals_search_of_all():
    rng = random.Random(3)
    for _ in range(60):
        sequence = rng.choice([8, 64, 2048])
        lengths = [rng.randint(0, rng.choice([3, sequence, 3 * sequence])) for _ in range(rng.randint(0, 120))]
        linear, quadratic = rng.choice([(1.0, 1 / sequence), (0.0, 1.0), (1.0, 0.0)])
        want, n = [], 0
        for doc, length in enumerate(lengths):
            for k in range(length // sequence):
                want.append((doc, k * sequence, sequence, n, 0))
                n += 1
        rests = [x % sequence for x in lengths]
        room = packing.capacities(sum(rests), sequence)
        used, cost = [0] * len(room), [0.0] * len(room)
        for doc in sorted((d for d, r in enumerate(rests) if r), key=lambda d: (-rests[d], d)):
            start, left = lengths[doc] - rests[doc], rests[doc]
            while left:
                fits = [k for k, r in enumerate(room) if r >= left] or [k for k, r in enumerate(room) if r]
                k = min(fits, key=lambda k: (cost[k], k))
                take = min(left, room[k])
                want.append((doc, start, take, n + k, used[k]))
                room[k], used[k] = room[k] - take, used[k] + take
                cost[k] += linear * take + quadratic * take * take
                start, left = start + take, left - take
        assert packing.pack(lengths, sequence, linear, quadratic) == want


def test_codec(spark, small, odd_texts):
    tokens = bpe_codec.read_ranks(RANKS)
    reference = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={}
    )
    got = bpe_codec.bpe_round_trip(small, RANKS, public_tokenizers.PATTERN).collect()
    rows = small.collect()
    assert len(got) == len(rows)
    want = sorted(
        (r.doc_id is None, r.doc_id or 0, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
         hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in rows for e in [reference.encode_ordinary(r.text or "")]
    )
    assert sorted((g[0] is None, g[0] or 0, *g[1:]) for g in got) == want


def test_every_token_is_reachable():
    tokens = bpe_codec.read_ranks(RANKS)
    own = bpe_codec.codec(RANKS, public_tokenizers.PATTERN)
    encoded = own.model.encode([bpe_codec._letters(t) for t in tokens])
    assert encoded == [[k] for k in range(len(tokens))]
    assert own.piece_bytes == tokens


def test_codec_columns(spark, small):
    encoded = bpe_codec.bpe_encode(small, RANKS, public_tokenizers.PATTERN)
    decoded = bpe_codec.bpe_decode(encoded, RANKS, public_tokenizers.PATTERN)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((d, bytes(t).decode()) for d, t in decoded.collect()), key=key) == sorted(
        ((r.doc_id, r.text or "") for r in small.collect()), key=key
    )


def test_counts(spark, small, library):
    got = token_counts.token_counts(small, JSON, limit=8, batch_bytes=64).collect()
    want = [
        (r.doc_id, len(t.encode()), n, n > 8)
        for r in small.collect() for t in [r.text or ""] for n in [len(library.encode(t, add_special_tokens=False).ids)]
    ]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_counts_by_sentencepiece(spark, small):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(small, path).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(model.encode(r.text or "")) for r in small.collect())


def test_counts_by_other_splitting(spark, small):
    path = tokenizer_path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    got = token_counts.token_counts(small, path).collect()
    want = [len(other.encode(r.text or "", add_special_tokens=False).ids) for r in small.collect()]
    assert sorted(r.n_tokens for r in got) == sorted(want)


def test_balanced_batches():
    items = [str(k) for k in range(10)]
    parts = list(token_counts.balanced(items, [5, 5, 1, 1, 20, 1, 1, 1, 1, 1], 10))
    assert [x for p in parts for x in p] == items
    assert parts == [["0", "1"], ["2", "3", "4"], ["5", "6", "7", "8", "9"]]


def check_packing(rows, docs, library, sequence):
    """Every token once, offsets without gaps, crc of the ids, next to no padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {d.doc_id for d in docs}
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= sequence
        padding += sequence - at if at & at - 1 else 0
    assert padding == 0
    encoded = {}
    for d in docs:
        encoded.setdefault(d.doc_id, []).append([*library.encode(d.text or "", add_special_tokens=False).ids, 1])
    for doc_id, pieces in by_doc.items():
        if len(encoded[doc_id]) > 1:
            assert sum(p.length for p in pieces) == sum(map(len, encoded[doc_id]))
            continue
        own, at = encoded[doc_id][0], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(own)
            assert p.ids_crc32 == zlib.crc32(np.array(own[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(own)


@pytest.mark.parametrize("window", [50, 4_000_000])
def test_packing(spark, small, library, window):
    rows = packing.pack_documents(small, JSON, sequence=64, window_tokens=window).collect()
    check_packing(rows, small.collect(), library, 64)


def test_packing_of_the_table(spark, sf_dir, library):
    docs = documents(spark, sf_dir).limit(150)
    check_packing(packing.pack_documents(docs, JSON).collect(), docs.collect(), library, packing.SEQUENCE)


def test_pack_is_balanced():
    pieces = packing.pack([100] * 8, sequence=400)
    assert sorted(sum(p[2] for p in pieces if p[3] == s) for s in (0, 1)) == [400, 400]
    assert packing.capacities(2048 + 13, 2048) == [2048, 8, 4, 1]
    assert packing.pack([]) == []


@pytest.mark.parametrize("percentile", [0, 50, 97, 100])
def test_blocks(percentile):
    rng = np.random.default_rng(3)
    for n in (0, 1, 127, 128, 129, 1000):
        for top in (1, 2, 50_257, 1 << 32):
            ids_ = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            ids_[::17] = 0
            data, sizes = token_files.encode_blocks(ids_, percentile)
            assert len(data) == sizes.sum()
            assert (token_files.decode_blocks(data, np.cumsum(sizes) - sizes) == ids_).all()


def test_token_files(spark, small, library, tmp_path):
    folder = scratch_path(spark, "files")
    manifest = token_files.write_token_files(small, JSON, folder)
    got = [tuple(r) for r in token_files.read_token_files(manifest).collect()]
    rows = [(r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in small.collect()]
    crc = {(d, len(e), zlib.crc32(np.array(e, "<u4").tobytes())) for d, e in rows}
    assert len(got) == len(rows) and {(d, n, c) for d, _, n, c in got} == crc
    at = 0
    for doc_id, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_long_documents_span_chunks(tmp_path):
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 50_257, n).astype("<u4") for n in (3, 400_000, 1, 0, 131_072, 70_000)]
    writer = token_files.TokenFileWriter(f"{tmp_path}/x.pfor")
    for k, d in enumerate(docs):
        writer.add(k if k != 2 else None, d)
    writer.close()
    for (doc_id, _, n, pieces), (k, d) in zip(token_files.read_documents(f"{tmp_path}/x.pfor"), enumerate(docs)):
        data = list(pieces)
        assert n == len(d) and doc_id == (k if k != 2 else None)
        assert (np.concatenate(data) == d).all() if data else not n


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    for df in (
        token_counts.token_counts(empty, JSON),
        bpe_codec.bpe_round_trip(empty, RANKS, public_tokenizers.PATTERN),
        packing.pack_documents(empty, JSON),
        token_files.token_file_round_trip(empty, JSON),
    ):
        assert df.collect() == []
