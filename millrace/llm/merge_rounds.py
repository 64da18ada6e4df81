"""Sentencepiece BPE by vectorised merge rounds.

All symbols of many words lie in one flat array. A round finds the best pair of every word
(a segmented minimum over pair ranks), merges its occurrences from the left wherever they
do not overlap, and compacts the array; words without a pair leave it. Rounds go on until
no pair remains.

Words are what no piece of the vocabulary reaches across: a text is cut ahead of a blank
behind another character and around a line end, and inside a word wherever two characters
stand next to each other in no piece. A distinct word is merged once per worker while it
is remembered (``tokens.PieceIds``).

Merging all occurrences of the best pair at once equals merging them one by one, unless a
merged symbol makes a pair with a neighbour that ranks as well as its own merge or better.
Where that happens the word merges its leftmost occurrence only in that round.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.runtime import id_and_text, texts
from millrace.llm.tokens import SLICE, PieceIds, gather

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

#: Fixed values of the public model format: piece types, the model type BPE, the blank's stand-in.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
BPE = 2
BLANK = "▁"
#: The rank of what is no pair.
NO_PAIR = np.iinfo(np.int32).max
SPACED = re.compile(r" +[^ \n]*|\n[^ \n]*|[^ \n]+")


def _fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """Number and value of each protocol-buffer field."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 5:
            yield key >> 3, struct.unpack_from("<f", data, at)[0]
            at += 4
        elif key & 7 == 1:
            yield key >> 3, struct.unpack_from("<d", data, at)[0]
            at += 8
        else:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size


class PieceModel:
    """Pieces, scores and types of a sentencepiece file, checked for what this module can do."""

    def __init__(self, path: str):
        self.pieces: list[bytes] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer, normaliser = {}, {}
        with open(path, "rb") as stream:
            data = stream.read()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b""))
                self.scores.append(piece.get(2, 0.0))
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, 1) != BPE:
            raise ValueError("not a BPE model")
        if not trainer.get(35, 0) or self.types.count(BYTE) != 256:
            raise ValueError("the model has no byte fallback")
        if USER_DEFINED in self.types or UNUSED in self.types:
            raise ValueError("user-defined and unused pieces are not supported")
        plain = not normaliser.get(2, b"") and normaliser.get(5, 1) and not normaliser.get(4, 1)
        if not plain or not normaliser.get(3, 1) or trainer.get(24, 0):
            raise ValueError("only identity normalisation with a blank in front is supported")


class Merged(NamedTuple):
    """Symbols, their words and pair ranks, and per merge the best rank that it brought about."""

    symbol: np.ndarray
    word: np.ndarray
    rank: np.ndarray
    least: np.ndarray


class MergeRounds:
    """Encodes words and whole texts with one model."""

    def __init__(self, path: str):
        model = PieceModel(path)
        texts_of = {
            p.decode(): k for k, (p, t) in enumerate(zip(model.pieces, model.types)) if t == NORMAL
        }
        self.size = len(model.pieces)
        bytes_at = [k for k, t in enumerate(model.types) if t == BYTE]
        self.byte_ids = np.zeros(256, np.uint32)
        for k in bytes_at:
            self.byte_ids[int(model.pieces[k][3:-1], 16)] = k
        # equal scores are equal ranks: among them the leftmost pair comes first
        scores = np.array(model.scores)
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self._tables(texts_of)
        self._letters(model, bytes_at)
        self.crosses_words = any(re.search(f"[^{BLANK}]{BLANK}|\n.|.\n", p, re.S) for p in texts_of)
        self.memo = PieceIds(self.encode_words)

    def _tables(self, texts_of: dict[str, int]) -> None:
        """Characters to ids, pairs of ids to pieces, and which characters are neighbours in pieces."""
        symbols = {c: texts_of[c] for c in texts_of if len(c) == 1}
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, k in symbols.items():
            self.of_char[ord(c)] = k
        neighbours = {(ord(a), ord(b)) for p in texts_of for a, b in zip(p, p[1:])}
        self.neighbours = np.unique(np.array([a << 21 | b for a, b in neighbours] + [-1], np.int64))
        pairs = {}
        for piece, made in texts_of.items():
            for at in range(1, len(piece)):
                left, right = texts_of.get(piece[:at]), texts_of.get(piece[at:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = made
        keys = sorted(pairs)
        self.pair_keys = np.array(keys or [-1], np.int64)
        self.pair_made = np.array([pairs[k] for k in keys] or [0], np.int32)

    def _letters(self, model: PieceModel, bytes_at: list[int]) -> None:
        """The bytes that each id decodes to."""
        own = [p.replace(BLANK.encode(), b" ") if t == NORMAL else b"" for p, t in zip(model.pieces, model.types)]
        for k in bytes_at:
            own[k] = bytes([int(model.pieces[k][3:-1], 16)])
        self.n_letters = np.array([len(p) for p in own])
        self.letters_at = np.cumsum(self.n_letters) - self.n_letters
        self.letters = np.frombuffer(b"".join(own), np.uint8)
        self.decimals = np.frombuffer(b"".join(b"%d," % k for k in range(self.size)), np.uint8)
        self.n_decimals = np.array([len(str(k)) + 1 for k in range(self.size)])
        self.decimals_at = np.cumsum(self.n_decimals) - self.n_decimals

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = np.where((left < self.size) & (right < self.size), left * np.int64(self.size) + right, -2)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.rank[self.pair_made[at]], NO_PAIR)

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pair_made[np.searchsorted(self.pair_keys, left * np.int64(self.size) + right)]

    def merge(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words after all merges; ``word`` never falls.

        Symbols of ``size`` and above stand for characters without a piece.
        """
        symbol, word = symbol.astype(np.int64), word.astype(np.int64)
        done_symbols, done_words = [], []
        if not len(symbol):
            return symbol, word
        rank = np.full(len(symbol), NO_PAIR, np.int32)  # of a symbol and the next one
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self._pair_ranks(symbol[inside], symbol[inside + 1])
        while len(symbol):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            finished = best == NO_PAIR
            if finished.any():
                out = np.repeat(finished, sizes)
                done_symbols.append(symbol[out])
                done_words.append(word[out])
                symbol, word, rank = symbol[~out], word[~out], rank[~out]
                sizes, best = sizes[~finished], best[~finished]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # runs of occurrences that overlap: every second one, from the left
            fresh = np.append(True, np.diff(at) != 1)
            run = np.flatnonzero(fresh)
            in_run = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            taken = in_run % 2 == 0
            after = self._merged(symbol, word, rank, at[taken])
            limit = np.repeat(best, sizes)[at[taken]]
            hasty = after.least <= limit
            if hasty.any():  # those words merge one occurrence only
                first = np.append(True, np.diff(word[at]) != 0)
                taken &= first | ~np.isin(word[at], word[at[taken][hasty]])
                after = self._merged(symbol, word, rank, at[taken])
            symbol, word, rank = after.symbol, after.word, after.rank
        symbol, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _merged(self, symbol: np.ndarray, word: np.ndarray, rank: np.ndarray, at: np.ndarray) -> Merged:
        """The arrays after merging the symbols at ``at`` with their successors."""
        made = self._made(symbol[at], symbol[at + 1])
        new = symbol.copy()
        new[at] = made
        kept = np.ones(len(symbol), bool)
        kept[at + 1] = False
        moved = at - np.arange(len(at)) if len(at) else at  # every merge before takes one place away
        new, word_after, rank_after = new[kept], word[kept], rank[kept]

        def pair(k: np.ndarray) -> np.ndarray:
            ok = (k >= 0) & (k < len(new) - 1)
            k = np.where(ok, k, 0)
            ok &= word_after[k] == word_after[np.minimum(k + 1, len(new) - 1)]
            out = np.full(len(k), NO_PAIR, np.int32)
            out[ok] = self._pair_ranks(new[k[ok]], new[k[ok] + 1])
            return out

        behind, ahead = pair(moved), pair(moved - 1)
        rank_after[moved] = behind
        rank_after[np.maximum(moved - 1, 0)] = np.where(moved > 0, ahead, rank_after[0])
        least = np.minimum(behind, ahead)
        # the successor as it is while only the merges on the left have happened
        next_at = np.minimum(at + 2, len(symbol) - 1)
        waiting = (at + 2 < len(symbol)) & (word[next_at] == word[at])
        least[waiting] = np.minimum(least[waiting], self._pair_ranks(made[waiting], symbol[next_at[waiting]]))
        return Merged(new, word_after, rank_after, least)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat, start, length)`` of the ids of words of :func:`cut`."""
        whole = [w.replace(" ", BLANK) if w[:1] in (" ", "\n") else BLANK + w for w in words]
        sizes = np.array([len(w) for w in whole])
        chars = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        # words within words: nothing merges across two characters that are neighbours in no piece
        keys = chars[:-1] << 21 | chars[1:]
        near = np.minimum(np.searchsorted(self.neighbours, keys), len(self.neighbours) - 1)
        apart = (self.neighbours[near] != keys) | (word[1:] != word[:-1])
        part = np.append(0, np.cumsum(apart))[: len(chars)]
        word_of_part = word[np.flatnonzero(np.append(True, apart))[: len(word)]] if len(word) else word
        symbol = self.of_char[chars].astype(np.int64)
        symbol = np.where(symbol < 0, self.size + chars, symbol)
        symbol, part = self.merge(symbol, part)
        word = word_of_part[part] if len(part) else part
        return self._with_bytes(symbol, word, len(words))

    def _with_bytes(self, symbol: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters without a piece become the ids of their UTF-8 bytes."""
        missing = np.flatnonzero(symbol >= self.size)
        if len(missing):
            spelled = [chr(c).encode() for c in (symbol[missing] - self.size).tolist()]
            times = np.ones(len(symbol), np.int64)
            times[missing] = [len(b) for b in spelled]
            place = np.repeat(symbol >= self.size, times)
            symbol, word = np.repeat(symbol, times), np.repeat(word, times)
            symbol[place] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        length = np.bincount(word, minlength=n)
        return symbol.astype(np.uint32), np.cumsum(length) - length, length

    def cut(self, text: str) -> list[str]:
        """Words; one that begins with a blank or line end stands for itself, others follow a blank."""
        if not text:
            return []
        text = text.replace(BLANK, " ")
        if self.crosses_words:
            return [" " + text]
        if "  " in text or text[0] in " \n" or text[-1] == " " or " \n" in text or "\n " in text:
            return SPACED.findall(" " + text)
        return text.replace("\n", " \n").split(" ")

    def __call__(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the bounds of each text in them."""
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        at = 0
        while at < len(batch):
            words, n_words, held = [], [], 0
            while at < len(batch) and (held < SLICE or not held):
                own = self.cut(batch[at])
                words += own
                n_words.append(len(own))
                held += len(batch[at])
                at += 1
            ids, length = self.memo(words)
            flat.append(ids)
            ends = np.append(0, np.cumsum(length))[np.cumsum(n_words)]
            counts.append(np.diff(np.append(0, ends)))
        return np.concatenate(flat), np.cumsum(np.concatenate(counts))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of all texts end to end and their bounds; the blank in front is taken off.

        Bytes are joined as they are, which gives back what was encoded.
        """
        size = self.n_letters[ids]
        data = gather(self.letters, self.letters_at[ids], size)
        ends = np.append(0, np.cumsum(size))
        starts = ends[bounds]
        led = np.flatnonzero(np.diff(bounds) > 0)
        led = led[data[starts[led]] == ord(" ")]
        kept = np.ones(len(data), bool)
        kept[starts[led]] = False
        less = np.zeros(len(bounds), np.int64)
        less[led + 1] = 1
        return data[kept], starts - np.cumsum(less)

    def as_decimals(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Per text its ids as decimal numbers, joined by commas."""
        size = self.n_decimals[ids]
        data = gather(self.decimals, self.decimals_at[ids], size)
        at = np.append(0, np.cumsum(size))[bounds].tolist()
        return [data[a : max(a, b - 1)].tobytes() for a, b in zip(at, at[1:])]


_models: dict[str, MergeRounds] = {}


def merge_rounds(path: str) -> MergeRounds:
    """One per worker process and file."""
    if path not in _models:
        _models[path] = MergeRounds(path)
    return _models[path]


def piece_encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) per row; a null text gives an empty array."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = merge_rounds(model)
        for batch in batches:
            ids, bounds = rounds(texts(batch.column(1)))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(encode, "doc_id bigint, ids array<int>")


def piece_decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, decoded`` of ``doc_id, ids``; null ids give an empty text.

    Bytes that are no UTF-8, which no encoded text has, become replacement characters.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = merge_rounds(model)
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column(1).to_pylist()]
            bounds = np.cumsum([0, *map(len, lists)])
            data, at = rounds.decode(np.concatenate([np.zeros(0, np.int64), *lists]), bounds)
            decoded = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.string())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, decoded string")


def piece_round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both.

    One row per input row: ``doc_id, n_tokens, ids_sha256`` (decimal ids joined by commas),
    ``decoded_sha256`` (UTF-8). A null text counts as empty; repeated rows and null ids come
    back as they are; an empty table gives no rows. Other columns are not read.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = merge_rounds(model)
        for batch in batches:
            ids, bounds = rounds(texts(batch.column(1)))
            data, at = rounds.decode(ids, bounds)
            decoded = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())]
            spelled = [hashlib.sha256(s).hexdigest() for s in rounds.as_decimals(ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(bounds)), pa.array(spelled, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(digest, SCHEMA)
