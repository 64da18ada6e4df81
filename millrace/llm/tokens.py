"""Memoised encoding for byte-level BPE with the usual split pattern.

The pattern never matches a non-space followed by white space, and it starts a match
before the last blank ahead of a non-space. Both places are safe: what stands left and
right of them can be encoded apart. So a text is cut there, each distinct piece is
encoded once, and the results are laid end to end by one gather. A piece without any white
space stays whole however long it is.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from typing import Any

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space as Unicode defines it, which is what the tokenizer libraries go by.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space that does not stand alone between two non-spaces.
CLOSE = re.compile(rf"[ \n][{WHITE}]|[{WHITE}][ \n]|\A[{WHITE}]|[ \n]\Z")
PIECE = re.compile(rf"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: No white space but a leading blank, so that line ends can divide such pieces.
PLAIN = re.compile(rf" ?[^{WHITE}]+")
STARTS_WHITE = re.compile(rf"[{WHITE}]").match

#: White space that is rare in texts; those with any are examined more closely.
RARE = ["\t", "\r", "\v", "\f", "\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B))]
RARE += ["\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]
DOUBLED = ["  ", " \n", "\n ", "\n\n"]

#: Bytes of remembered pieces in a worker, two generations together.
REMEMBERED_BYTES = 256 << 20
#: What a piece takes besides its letters and ids: its string, its number, its dictionary entry.
PIECE_BYTES = 170
#: Longer pieces are encoded where they occur and not remembered.
LONGEST = 64
#: Pieces encoded by one call.
CALL = 4_000
#: Characters of text that are cut and looked up at a time.
SLICE = 1 << 20


def spaced_out(text: str) -> bool:
    """Whether some white space does not stand alone between two non-spaces."""
    if not text:
        return False
    if any(map(text.__contains__, RARE)):
        return CLOSE.search(text) is not None
    return text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, DOUBLED))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Generation(dict):
    """Pieces to numbers; an unknown piece gets the next number, or one below zero if it is long."""

    def __init__(self, longest: int):
        self.longest, self.fresh, self.once = longest, [], []
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used, self.bytes = np.zeros(4096, np.uint32), 0, 0

    def __missing__(self, piece: str) -> int:
        if len(piece) > self.longest:
            self.once.append(piece)
            return -len(self.once)
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number

    def reserve(self, numbers: int, ids: int) -> None:
        for name, wanted in (("start", numbers), ("length", numbers), ("flat", ids)):
            array = getattr(self, name)
            if wanted > len(array):
                grown = np.zeros(max(wanted, 3 * len(array) // 2), array.dtype)
                grown[: len(array)] = array
                setattr(self, name, grown)


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` laid end to end."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - length), length) + np.arange(total)]


class PieceIds:
    """Ids of pieces, each distinct piece encoded once while it is remembered.

    ``encode`` gets distinct pieces and returns ``(flat, start, length)``: the ids of piece
    ``k`` are ``length[k]`` of them from ``start[k]``. All known ids lie in one growing array.
    When the pieces exceed half of ``limit`` bytes they become the older generation, out of which
    a piece in use is taken over; what the generation before it held is forgotten. With
    ``lengths_only`` no ids are kept.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]],
        limit: int = REMEMBERED_BYTES,
        longest: int = LONGEST,
        lengths_only: bool = False,
    ):
        self.encode, self.limit, self.longest, self.lengths_only = encode, limit, longest, lengths_only
        self.young, self.old = _Generation(longest), _Generation(longest)

    def _place(self, at: int, numbers: np.ndarray, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> int:
        """Store stretches of ``flat`` under ``numbers`` from position ``at``; the position behind them."""
        young, total = self.young, 0 if self.lengths_only else int(length.sum())
        young.reserve(int(numbers.max()) + 1, at + total)
        if not self.lengths_only:
            young.start[numbers] = at + np.cumsum(length) - length
            young.flat[at : at + total] = gather(flat, start, length)
        young.length[numbers] = length
        return at + total

    def _learn(self, pieces: list[str], numbers: np.ndarray, at: int) -> int:
        for k in range(0, len(pieces), CALL):
            at = self._place(at, numbers[k : k + CALL], *self.encode(pieces[k : k + CALL]))
        return at

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        young, old = self.young, self.old
        if young.bytes > self.limit // 2:
            self.old, self.young = young, _Generation(self.longest)
            young, old = self.young, self.old
        numbers = np.fromiter(map(young.__getitem__, pieces), np.int64, len(pieces))
        fresh, once = young.fresh, young.once
        if fresh:
            first = len(young) - len(fresh)
            before = np.fromiter((dict.get(old, p, -1) for p in fresh), np.int64, len(fresh)) if old else None
            unknown = np.flatnonzero(before < 0) if old else np.arange(len(fresh))
            if len(unknown) < len(fresh):
                known = np.flatnonzero(before >= 0)
                old_at = before[known]
                young.used = self._place(young.used, first + known, old.flat, old.start[old_at], old.length[old_at])
            young.used = self._learn([fresh[k] for k in unknown.tolist()], first + unknown, young.used)
            young.bytes = len(young) * PIECE_BYTES + 4 * young.used
            young.fresh = []
        if once:  # behind everything that is known, to be written over next time
            distinct = {p: k for k, p in enumerate(dict.fromkeys(once))}
            places = len(young) + np.fromiter((distinct[p] for p in once), np.int64, len(once))
            self._learn(list(distinct), len(young) + np.arange(len(distinct)), young.used)
            numbers[numbers < 0] = places
            young.once = []
        return numbers

    def lengths(self, pieces: list[str]) -> np.ndarray:
        """The number of ids of each piece."""
        if not pieces:
            return np.zeros(0, np.int64)
        numbers = self._numbers(pieces)
        return self.young.length[numbers]

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces end to end, and the number of each piece's."""
        if not pieces:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        numbers = self._numbers(pieces)
        young = self.young
        length = young.length[numbers]
        return gather(young.flat, young.start[numbers], length), length


def cut(text: str) -> tuple[list[str], bool]:
    """The pieces of a text, and whether a line end was put ahead of it.

    A piece that begins with white space stands for itself, any other for itself behind a blank.
    """
    if not spaced_out(text):
        return ("\n" + text).replace("\n", " \n").split(" ")[1:], True
    pieces = PIECE.findall(text)
    led = not STARTS_WHITE(pieces[0])
    if led:
        pieces[0] = "\n" + pieces[0]
    return pieces, led


def literal(piece: str) -> str:
    """What a piece of :func:`cut` stands for."""
    return piece if STARTS_WHITE(piece) else " " + piece


class TextIds:
    """Whole texts to ids through their pieces. A line end has to be one id of its own."""

    def __init__(self, memo: PieceIds):
        self.memo = memo

    def _slices(self, texts: list[str]):
        pieces, counts, led, held = [], [], [], 0
        for text in texts:
            own, first = cut(text)
            pieces += own
            counts.append(len(own))
            led.append(first)
            held += len(text)
            if held >= SLICE:
                yield pieces, np.array(counts), np.array(led, np.int64)
                pieces, counts, led, held = [], [], [], 0
        if counts:
            yield pieces, np.array(counts), np.array(led, np.int64)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out = []
        for pieces, counts, led in self._slices(texts):
            ids, length = self.memo(pieces)
            ends = np.cumsum(length)[np.cumsum(counts) - 1]
            starts = np.append(0, ends[:-1]) + led
            out += [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        return out

    def counts(self, texts: list[str]) -> list[int]:
        """The number of ids of each text."""
        out = []
        for pieces, counts, led in self._slices(texts):
            total = np.append(0, np.cumsum(self.memo.lengths(pieces)))[np.append(0, np.cumsum(counts))]
            out += (np.diff(total) - led).tolist()
        return out


def encode_by_line_ends(
    pieces: list[str], encode_texts: Callable[[list[str]], list[list[int]]], line_end: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(flat, start, length)`` of the ids of pieces, many pieces in one text.

    Pieces are joined by line ends. A line end is a token of its own there and occurs in
    no plain piece, so its id divides the result, and it serves a piece that begins with it;
    other pieces are encoded one by one.
    """
    whole = [literal(p) for p in pieces]
    led = np.array([p[0] == "\n" for p in whole])
    body = [p[1:] if p[0] == "\n" else p for p in whole]
    plain = np.array([PLAIN.fullmatch(p) is not None for p in body])
    start, length = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    at = np.flatnonzero(plain)
    joined = "\n" + "\n".join([body[k] for k in at.tolist()])
    rest = np.flatnonzero(~plain)
    encoded = encode_texts([joined, *(whole[k] for k in rest.tolist())])
    flat = np.array(encoded[0], np.uint32)
    if len(at):
        ends = np.flatnonzero(flat == line_end)
        assert len(ends) == len(at)
        start[at] = ends + 1 - led[at]
        length[at] = np.append(ends[1:], len(flat)) - start[at]
    if len(rest):
        sizes = np.array([len(e) for e in encoded[1:]])
        start[rest], length[rest] = len(flat) + np.cumsum(sizes) - sizes, sizes
        flat = np.concatenate([flat, *(np.array(e, np.uint32) for e in encoded[1:])])
    return flat, start, length


#: Letters whose class every Unicode version agrees on, without a need for tables.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
#: Pieces of such letters, digits and ASCII marks, which :data:`MATCH` divides as the library does.
SIMPLE = re.compile(rf"[ \n]?[{LETTERS}!-@\[-`{{-~]+")
MATCH = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\n")


def byte_letters() -> dict[int, str]:
    """The public byte alphabet: visible Latin-1 characters stand for themselves, others move up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(moved)}


class ByteLevel:
    """Ids of texts by a ``tokenizers`` file with the usual split pattern over bytes.

    Simple pieces are divided here and their matches handed to the library's model; whatever
    else a text holds, added tokens included, goes through the whole library.
    """

    def __init__(self, library):
        self.library, self.tokenize = library, library.model.tokenize
        self.letters = byte_letters()
        added = [t.content for t in library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.words_are_plain = not any(re.fullmatch("[A-Za-z.,;:!?]*", t) for t in added)
        (self.line_end,) = self.encode_texts(["\n"])[0]

    def encode_texts(self, batch: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(batch, add_special_tokens=False)]

    def matches(self, piece: str) -> list[str] | None:
        """The matches of a simple piece in the byte alphabet, None for other pieces."""
        if self.words_are_plain and piece.isascii():
            if piece.isalpha():
                return ["\u0120" + piece]
            if piece[-1] in ".,;:!?" and piece[:-1].isalpha():
                return ["\u0120" + piece[:-1], piece[-1]]
        whole = literal(piece)
        if not SIMPLE.fullmatch(whole) or self.added.search(whole):
            return None
        return [m.encode().decode("latin-1").translate(self.letters) for m in MATCH.findall(whole)]

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokenize = self.tokenize
        ids: list[int] = []
        ends, rest, at = [], [], []
        for k, piece in enumerate(pieces):
            matches = self.matches(piece)
            if matches is None:
                rest.append(k)
                continue
            for match in matches:
                ids += [t.id for t in tokenize(match)]
            at.append(k)
            ends.append(len(ids))
        start, length = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        ends = np.array(ends, np.int64)
        start[at] = np.append(0, ends)[: len(ends)]
        length[at] = ends - start[at]
        flat = np.array(ids, np.uint32)
        if rest:
            more, begin, size = encode_by_line_ends([pieces[k] for k in rest], self.encode_texts, self.line_end)
            start[rest], length[rest] = begin + len(flat), size
            flat = np.append(flat, more)
        return flat, start, length


class WholeTexts:
    """Ids of texts by a ``tokenizers`` file with other rules, each text as a whole."""

    def __init__(self, library):
        self.library = library

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


_loaded: dict[tuple, Any] = {}


def json_encoder(
    path: str, lengths_only: bool = False, remembered: int = REMEMBERED_BYTES
) -> TextIds | WholeTexts:
    """Texts to ids by the ``tokenizers`` library, one memo of ``remembered`` bytes per worker process."""
    key = ("ids", path, lengths_only, remembered)
    if key not in _loaded:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as stream:
            layout = json.load(stream)
        split = layout.get("pre_tokenizer") or {}
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if usual and layout["model"]["type"] == "BPE" and not layout.get("normalizer"):
            _loaded[key] = TextIds(PieceIds(ByteLevel(library), remembered, lengths_only=lengths_only))
        else:
            _loaded[key] = WholeTexts(library)
    return _loaded[key]
