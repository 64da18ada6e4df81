"""Token ids in patched frame-of-reference files, written and read by tasks.

A file holds a run of documents in ascending id order. Its ids form blocks of 128 values:
the block minimum is subtracted, the differences are packed at the bit width that a given
percentile of them needs, and the wider ones go whole to an exception list of the block.
The file ends with the start of every block, the documents with their first position, and
a trailer that says where these lists are.

Documents are dealt out by ranges of their id, one shuffle of the texts. A manifest of the
finished files, a row each, gives every file the number of ids ahead of it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.files import PendingFile, open_input
from millrace.llm.runtime import id_and_text, texts
from millrace.llm.tokens import json_encoder
from millrace.session import scratch_path

BLOCK = 128
PERCENTILE = 97
#: Ids that a writer gathers, and about as many that a reader unpacks, at a time.
CHUNK = 1 << 17
MAGIC = b"PFOR"
#: Block head: minimum, values, bit width, exceptions.
HEAD = np.dtype([("low", "<u4"), ("n", "u1"), ("width", "u1"), ("patches", "u1"), ("zero", "u1")])
#: Per document: its id, whether it has one, the position of its first token.
DOC = np.dtype([("id", "<i8"), ("known", "u1"), ("first", "<u8")])
#: Trailer: where the block starts and the documents lie, how many there are, all ids.
TRAILER = struct.Struct("<QQQQQ4s")

MANIFEST = "part bigint, path string, n_docs bigint, n_ids bigint, n_bytes bigint"
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """The blocks end to end and the bytes of each; only the last block may be short."""
    n = len(ids)
    if not n:
        return b"", np.zeros(0, np.int64)
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, ids[-1], np.uint32)
    grid[:n] = ids
    grid = grid.reshape(rows, BLOCK)
    low = grid.min(axis=1)
    gap = grid - low[:, None]
    bits = np.frexp(gap.astype(np.float64))[1].astype(np.uint8)
    nth = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    width = np.partition(bits, nth, axis=1)[:, nth]
    heads = np.zeros(rows, HEAD)
    heads["low"], heads["n"], heads["width"] = low, BLOCK, width
    heads["n"][-1] = n - (rows - 1) * BLOCK
    wide = bits > width[:, None]
    patches = wide.sum(axis=1)
    heads["patches"] = patches
    # where the parts of each block go: head, packed differences, places and values of exceptions
    packed_at = HEAD.itemsize
    spans = width.astype(np.int64) * (BLOCK // 8)
    sizes = packed_at + spans + 5 * patches
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(packed_at)] = heads.view(np.uint8).reshape(rows, -1)
    for w in np.unique(width[width > 0]).tolist():
        at = np.flatnonzero(width == w)
        low_bytes = gap[at].astype("<u4").view(np.uint8).reshape(-1, 4)[:, : (w + 7) // 8]
        raw = np.unpackbits(low_bytes, axis=1, bitorder="little", count=w)
        packed = np.packbits(raw.reshape(len(at), -1), axis=1, bitorder="little")
        out[(starts[at] + packed_at)[:, None] + np.arange(spans[at[0]])] = packed
    block, place = np.nonzero(wide)
    nth_patch = np.arange(len(block)) - np.repeat(np.cumsum(patches) - patches, patches)
    places_at = starts[block] + packed_at + spans[block]
    out[places_at + nth_patch] = place
    values = gap[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(places_at + patches[block] + 4 * nth_patch)[:, None] + np.arange(4)] = values
    return out.tobytes(), sizes


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    heads = raw[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD).reshape(-1)
    grid = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(heads["width"]).tolist():
        at = np.flatnonzero(heads["width"] == w)
        if w:
            span = BLOCK * w // 8
            packed = raw[(starts[at] + HEAD.itemsize)[:, None] + np.arange(span)]
            bits = np.zeros((len(at) * BLOCK, 32), np.uint8)
            bits[:, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(-1, w)
            grid[at] = np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(len(at), BLOCK)
    patches = heads["patches"].astype(np.int64)
    if patches.any():
        block = np.repeat(np.arange(len(starts)), patches)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(patches) - patches, patches)
        places_at = (starts + HEAD.itemsize + BLOCK // 8 * heads["width"].astype(np.int64))[block]
        values_at = places_at + patches[block] + 4 * nth
        values = raw[values_at[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
        grid[block, raw[places_at + nth]] = values
    grid += heads["low"][:, None]
    return grid.reshape(-1)[: (len(starts) - 1) * BLOCK + int(heads["n"][-1])]


class TokenFileWriter:
    """Appends documents to one file; ``close`` writes the lists and commits."""

    def __init__(self, uri: str, percentile: float = PERCENTILE):
        self.file, self.percentile = PendingFile(uri), percentile
        self.docs: list[tuple[int, int, int]] = []
        self.starts: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, self.n_ids))
        self.waiting.append(ids)
        self.n_ids += len(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= CHUNK:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, whole, CHUNK):
            data, sizes = encode_blocks(ids[at : min(at + CHUNK, whole)], self.percentile)
            self.starts.append(self.file.size + np.cumsum(sizes) - sizes)
            self.file.write(data)
        self.waiting = [ids[whole:]]
        self.n_waiting = len(ids) - whole

    def close(self) -> None:
        self._flush(last=True)
        blocks_at = self.file.size
        starts = np.concatenate([np.zeros(0, "<u8"), *self.starts]).astype("<u8")
        self.file.write(starts.tobytes())
        docs_at = self.file.size
        self.file.write(np.array(self.docs, DOC).tobytes())
        self.file.write(TRAILER.pack(blocks_at, len(starts), docs_at, len(self.docs), self.n_ids, MAGIC))
        self.file.commit()


def read_documents(uri: str) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
    """``(doc_id, first position, number of ids, pieces of the ids)`` in file order.

    The pieces of a document must be used up before the next one is asked for.
    """
    stream = open_input(uri)
    size = stream.size()
    blocks_at, n_blocks, docs_at, n_docs, n_ids, magic = TRAILER.unpack(
        stream.read_at(TRAILER.size, size - TRAILER.size)
    )
    if magic != MAGIC:
        raise ValueError(f"{uri} is not a token file")
    starts = np.frombuffer(stream.read_at(8 * n_blocks, blocks_at), "<u8").astype(np.int64)
    docs = np.frombuffer(stream.read_at(DOC.itemsize * n_docs, docs_at), DOC)
    ends = np.append(starts, blocks_at)
    step = CHUNK // BLOCK
    loaded, first_loaded = np.zeros(0, np.uint32), 0

    def pieces(first: int, last: int) -> Iterator[np.ndarray]:
        nonlocal loaded, first_loaded
        while first < last:
            if not first_loaded <= first < first_loaded + len(loaded):
                block = first // BLOCK
                until = min(block + step, n_blocks)
                at = int(ends[block])
                loaded = decode_blocks(stream.read_at(int(ends[until]) - at, at), starts[block:until] - at)
                first_loaded = block * BLOCK
            upto = min(last, first_loaded + len(loaded))
            yield loaded[first - first_loaded : upto - first_loaded]
            first = upto

    bounds = np.append(docs["first"], n_ids).astype(np.int64).tolist()
    for k, (doc_id, known) in enumerate(zip(docs["id"].tolist(), docs["known"].tolist())):
        yield doc_id if known else None, bounds[k], bounds[k + 1] - bounds[k], pieces(bounds[k], bounds[k + 1])


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 2,
    percentile: float = PERCENTILE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode ``docs`` into files below ``folder``; the manifest, written there too, comes back.

    Every document ends with ``end_id``. Files follow each other in ascending id order
    (nulls first), rows with equal ids in the order of a hash of their text. A null text
    has the end id only. An empty table writes no file.
    """
    end = np.array([end_id], np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, writer = json_encoder(tokenizer), None
        path = f"{folder}/ids-{part:08d}.pfor"
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(texts(batch.column(1)))):
                writer = writer or TokenFileWriter(path, percentile)
                writer.add(doc_id, np.append(ids, end))
        if writer:
            writer.close()
            row = [part, path, len(writer.docs), writer.n_ids, writer.file.size]
            yield pa.RecordBatch.from_pydict(
                dict(zip(("part", "path", "n_docs", "n_ids", "n_bytes"), ([x] for x in row)))
            )

    order = ["doc_id", "tie"]
    dealt = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select("doc_id", "text").mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of ``folder`` with the number of ids ahead of each, one row per file."""
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32``, from the files; a task a file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc_id, first, n, pieces in read_documents(path):
                    crc = 0
                    for piece in pieces:
                        crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, base + first, n, crc))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n_files = max(1, manifest.count())
    dealt = manifest.select("path", "base", "part").repartitionByRange(n_files, "part")
    return dealt.select("path", "base").mapInArrow(read, RESULT)


def token_file_round_trip(
    docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the token files below the scratch folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, folder, end_id, id_col=id_col, text_col=text_col))
