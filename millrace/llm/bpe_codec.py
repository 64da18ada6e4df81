"""Byte-level BPE through a sentencepiece model that is written from the vocabulary.

The ranks of a byte-level vocabulary are turned into a serialised sentencepiece model:
one piece per token in rank order, its bytes mapped to one character each, scored by
its negative rank, with identity normalisation. The library then merges the pair with
the lowest rank first, as the rank file asks for. Every match of the split pattern is
encoded on its own; decoding maps ids to pieces and pieces back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.runtime import id_and_text, texts
from millrace.llm.tokens import PieceIds, TextIds, _loaded, gather, literal

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

#: Where the 256 bytes are mapped to: letters that no normalisation or space rule touches.
FIRST_LETTER = 0x100
BYTE_TO_LETTER = {b: FIRST_LETTER + b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order. Ranks must run from 0 without gaps."""
    with open(path, "rb") as stream:
        pairs = [line.split() for line in stream if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if not all(tokens):
        raise ValueError("the ranks have gaps")
    return tokens


def _letters(data: bytes) -> str:
    return data.decode("latin-1").translate(BYTE_TO_LETTER)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model; piece ids equal ranks, the unknown piece comes last.

    Field numbers and enumeration values of the public model format: piece 1 with text 1,
    score 2, type 3 (1 normal, 2 unknown); trainer 2 with model type 3 (2 BPE), size 4,
    unknown id 40, begin 41, end 42, padding 43; normaliser 3 with name 1, prefix space 3,
    removal of spaces 4, escaping of spaces 5.
    """
    minus_one = (1 << 64) - 1
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = _field(1, _letters(token).encode()) + _field(2, float(-rank)) + _field(3, 1)
        out += _field(1, piece)
    unknown = _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)
    out += _field(1, unknown)
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    trainer += b"".join(_field(n, minus_one) for n in (41, 42, 43))
    out += _field(2, trainer)
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class Codec:
    """Encodes texts to id bytes and decodes them, by one rank file and split pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        tokens = read_ranks(ranks_path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        self.pattern = regex.compile(pattern)
        letter_to_byte = {letter: b for b, letter in BYTE_TO_LETTER.items()}
        self.piece_bytes = [
            self.model.id_to_piece(k).translate(letter_to_byte).encode("latin-1") for k in range(len(tokens))
        ]
        self.whole = {t: k for k, t in enumerate(tokens)}
        sizes = np.array([len(p) for p in self.piece_bytes])
        self.letters = np.frombuffer(b"".join(self.piece_bytes), np.uint8)
        self.letters_at, self.n_letters = np.cumsum(sizes) - sizes, sizes
        self.encode = TextIds(PieceIds(self._encode_pieces))

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each pattern match separately; a match that is a token is that token."""
        matches = [[m.encode() for m in self.pattern.findall(literal(p))] for p in pieces]
        ids = {m: [self.whole[m]] for group in matches for m in group if m in self.whole}
        rest = list({m for group in matches for m in group} - ids.keys())
        if rest:
            ids.update(zip(rest, self.model.encode([_letters(m) for m in rest], num_threads=1)))
        length = np.array([sum(len(ids[m]) for m in group) for group in matches])
        flat = np.fromiter((k for group in matches for m in group for k in ids[m]), np.uint32, int(length.sum()))
        return flat, np.cumsum(length) - length, length

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.letters, self.letters_at[ids], self.n_letters[ids]).tobytes()


def codec(ranks_path: str, pattern: str) -> Codec:
    key = ("codec", ranks_path, pattern)
    if key not in _loaded:
        _loaded[key] = Codec(ranks_path, pattern)
    return _loaded[key]


def bpe_encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` (array of int) per row; a null text gives an empty array."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            encoded = own.encode(texts(batch.column(1)))
            ends = np.cumsum([0, *map(len, encoded)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint32), *encoded]).view(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, "doc_id bigint, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (binary) of ``doc_id, ids``; null ids give empty bytes."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            data = [own.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, decoded binary")


def bpe_round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text, decode the ids, and return digests of both.

    One row per input row: ``doc_id, n_tokens, ids_sha256`` (ids as little-endian unsigned
    32-bit integers), ``decoded_sha256``. A null text counts as empty, repeated rows and
    null ids come back as they are, an empty table gives no rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            encoded = own.encode(texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(ids) for ids in encoded], pa.int64()),
                    pa.array([hashlib.sha256(ids.astype("<u4")).hexdigest() for ids in encoded]),
                    pa.array([hashlib.sha256(own.decode(ids)).hexdigest() for ids in encoded]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(digest, SCHEMA)
