"""Cost-balanced packing of documents into sequences of a fixed length.

The cost of a piece is ``linear * n + quadratic * n * n``, the attention estimate of its
length. Each input partition packs its documents by itself, a window of tokens at a time,
so nothing is shuffled and a task holds one window. Within a window, stretches of the full
length become sequences of their own; the remainders go, longest first, to the sequence
with the lowest cost that has room. When none has room for all of it, the remainder is cut
over the cheapest ones. There are as many sequences as the tokens fill; what is left of a
window fills sequences whose lengths are powers of two, so nothing is padded.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.runtime import id_and_text, texts
from millrace.llm.tokens import REMEMBERED_BYTES, json_encoder

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
SEQUENCE = 2048
WINDOW_TOKENS = 4_000_000
#: Sequence ids carry the partition in the bits above these.
WINDOW_BITS = 40


def capacities(tokens: int, sequence: int) -> list[int]:
    """Full sequences, then powers of two for the rest."""
    rest = tokens % sequence
    return [sequence] * (tokens // sequence) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class OpenSequences:
    """Sequences with room, the cheapest one that fits first.

    Those that turned out too short for a remainder wait by their room until a remainder as
    short as that comes; remainders come longest first, so few wait twice.
    """

    def __init__(self, room: list[int], sequence: int):
        self.room, self.used, self.cost = room, [0] * len(room), [0.0] * len(room)
        self.fitting = [(0.0, k) for k in range(len(room))]
        self.waiting: list[list[int]] = [[] for _ in range(sequence + 1)]
        self.waits = [False] * len(room)
        self.short: list[tuple[float, int]] = []  # all that wait, and outdated entries
        self.level = sequence + 1  # whatever waits has less room than this

    def take_cheapest(self, left: int) -> int:
        """The cheapest sequence with room for ``left`` tokens, else the cheapest one."""
        while self.level > left:
            self.level -= 1
            for k in self.waiting[self.level]:
                if self.waits[k]:
                    self.waits[k] = False
                    heapq.heappush(self.fitting, (self.cost[k], k))
            self.waiting[self.level].clear()
        while self.fitting and self.room[self.fitting[0][1]] < left:
            entry = heapq.heappop(self.fitting)
            k = entry[1]
            self.waits[k] = True
            self.waiting[self.room[k]].append(k)
            heapq.heappush(self.short, entry)
            self.level = max(self.level, self.room[k] + 1)
        if self.fitting:
            return heapq.heappop(self.fitting)[1]
        while True:
            cost, k = heapq.heappop(self.short)
            if self.waits[k] and cost == self.cost[k]:
                self.waits[k] = False
                return k

    def fill(self, k: int, take: int, cost: float) -> None:
        self.room[k] -= take
        self.used[k] += take
        self.cost[k] += cost
        if self.room[k]:
            heapq.heappush(self.fitting, (self.cost[k], k))


def pack(
    lengths: list[int], sequence: int = SEQUENCE, linear: float = 1.0, quadratic: float = 1 / SEQUENCE
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` that cover all tokens once.

    Ties go to the earlier document and the earlier sequence.
    """
    pieces, n = [], 0
    for doc, length in enumerate(lengths):
        for k in range(length // sequence):
            pieces.append((doc, k * sequence, sequence, n, 0))
            n += 1
    rests = [length % sequence for length in lengths]
    open_ones = OpenSequences(capacities(sum(rests), sequence), sequence)
    for doc in sorted((d for d, r in enumerate(rests) if r), key=lambda d: (-rests[d], d)):
        start, left = lengths[doc] - rests[doc], rests[doc]
        while left:
            k = open_ones.take_cheapest(left)
            take = min(left, open_ones.room[k])
            pieces.append((doc, start, take, n + k, open_ones.used[k]))
            open_ones.fill(k, take, linear * take + quadratic * take * take)
            start, left = start + take, left - take
    return pieces


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = SEQUENCE,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / SEQUENCE,
    window_tokens: int = WINDOW_TOKENS,
    remembered: int = REMEMBERED_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's tokens are the ids of its text, special tokens not added, and ``end_id``;
    a null text has the end id only. Each token lies in exactly one piece, offsets in a
    sequence run gapless from 0. Repeated rows are packed as documents of their own; an
    empty table gives no rows. The same split of the input gives the same result. A worker
    remembers the ids of pieces of text in ``remembered`` bytes, also beyond the end of a task.
    """
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = json_encoder(tokenizer, remembered=remembered)
        first = TaskContext.get().partitionId() << WINDOW_BITS
        ids, held, tokens = [], [], 0

        def packed() -> pa.RecordBatch:
            nonlocal first
            lengths = [len(ids_of) for ids_of in held]
            pieces = pack(lengths, sequence, linear, quadratic)
            doc, start, length, seq, offset = map(list, zip(*pieces))
            crc = [zlib.crc32(held[d][s : s + n]) for d, s, n in zip(doc, start, length)]
            seq = np.array(seq, np.int64) + first
            first = int(seq.max()) + 1
            columns = [[ids[d] for d in doc], start, length, crc, [lengths[d] for d in doc], seq, offset]
            ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), encoder(texts(batch.column(1)))):
                ids.append(doc_id)
                held.append(np.append(data, end))
                tokens += len(data) + 1
                if tokens >= window_tokens:
                    yield packed()
                    tokens = 0
        if held:
            yield packed()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
