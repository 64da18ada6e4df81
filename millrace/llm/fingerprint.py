"""Document fingerprints from improbable features, kept in chained Bloom filters.

A feature is a window of 32 bytes. Windows are ranked by the entropy of their bytes: how
often each entropy occurs is counted over all texts of the table, and the rarer it is, the
lower its rank. In every run of 32 windows the lowest rank wins a point, leftmost first; windows
that win a quarter of the runs they can are the features. As a short text has few of them,
windows of 8 bytes are features as well, all of them in texts of up to 200 bytes and a share
that falls with the square of the size in larger ones, chosen by hash, so that texts of nearly
one size keep nearly the same. Features go in order into Bloom filters of 2048 bits, the next
filter being opened when one has taken its share. Two fingerprints are compared filter by filter by the
bits they have in common, normalised between the overlap that chance gives and the largest one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import id_and_text, utf8
from millrace.llm.words import mix
from millrace.operators.ranges import cut_points, range_number
from millrace.session import staged

SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
WINDOW = 32
RUN = 32
#: All windows of 8 bytes are features in texts of up to so many bytes.
SMALL_TEXT, SMALL_WINDOW = 200, 8
BITS = 2048
HASHES = 5
PER_FILTER = 160
#: Overlap beyond chance that still counts as none, as a share of the largest one.
MARGIN = 0.05
#: Entropies are told apart in this many steps from 0 to the largest one, log2 of the window.
STEPS = 1000
#: Entropies below this share of the largest one, runs of the same byte, say nothing about a text and rank last.
DULL = 0.15
#: Bytes that are ranked at once.
STRETCH = 1 << 16
#: Bytes of text that one task takes, and rows where texts are short.
PART_BYTES = 16 << 20
PART_ROWS = 10_000

_count = np.arange(WINDOW + 1)
#: count * log2(count) in whole numbers, so that sums do not depend on where they start, and what one more of a byte adds
_WEIGHT = np.round(np.where(_count > 0, _count * np.log2(np.maximum(_count, 1)), 0.0) * (1 << 16)).astype(np.int32)
_GAIN = np.diff(_WEIGHT, prepend=0).astype(np.int32)
_COEFFICIENTS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def window_steps(data: np.ndarray) -> np.ndarray:
    """The entropy of every window of ``data``, in steps."""
    pieces = [_stretch_steps(data[at : at + STRETCH + WINDOW - 1]) for at in range(0, len(data) - WINDOW + 1, STRETCH)]
    return np.concatenate([np.zeros(0, np.uint16), *pieces])


def _stretch_steps(data: np.ndarray) -> np.ndarray:
    n = len(data)
    # how often a byte occurs among the 31 before it, and among the 31 behind it, itself included
    before, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        behind[:-d] += same
    added = _GAIN[before]
    weight = np.empty(n - WINDOW + 1, np.int32)
    weight[0] = added[:WINDOW].sum()
    np.cumsum(added[WINDOW:] - _GAIN[behind[:-WINDOW]], out=weight[1:])
    weight[1:] += weight[0]
    most = _WEIGHT[WINDOW]
    return np.rint((most - weight) * (STEPS / most)).astype(np.uint16)


def step_counts(docs: DataFrame) -> tuple[np.ndarray, int, int]:
    """How many windows of all texts have each entropy, the texts' number and their bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(STEPS + 1, np.int64)
        rows = size = 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            rows, size = rows + batch.num_rows, size + len(data)
            steps = window_steps(data)
            whole = np.ones(len(steps) + 1, bool)
            for back in range(1, WINDOW):  # windows that reach from one text into the next
                ends = offsets[1:] - back
                whole[np.clip(np.where(ends >= offsets[:-1], ends, len(steps)), 0, len(steps))] = False
            counts += np.bincount(steps[whole[: len(steps)]], minlength=STEPS + 1)
        seen = np.append(counts, [rows, size])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], names=["step", "n"])

    found = docs.select("text").mapInArrow(count, "step bigint, n bigint").groupBy("step").agg(F.sum("n").alias("n"))
    counts = np.zeros(STEPS + 3, np.int64)
    for row in found.collect():  # a row a step
        counts[row.step] = row.n
    return counts[: STEPS + 1], int(counts[STEPS + 1]), int(counts[STEPS + 2])


def rarity_table(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy step: the rarer, the lower; of equals the smaller step. Dull ones come last."""
    step = np.arange(STEPS + 1)
    dull = step < DULL * STEPS
    ranks = np.empty(STEPS + 1, np.uint16)
    ranks[np.lexsort((step, counts, dull))] = step
    return ranks


def chosen(ranks: np.ndarray) -> np.ndarray:
    """Starts of the windows that win a quarter of the runs they lie in, one at least."""
    n = len(ranks)
    if n <= RUN:
        return np.array([int(np.argmin(ranks))]) if n else np.zeros(0, np.int64)
    best = ranks.astype(np.int64) * (1 << 40) + np.arange(n)
    span = 1
    while span < RUN:  # the least of 2, 4, ... windows from each start
        best = np.minimum(best[: len(best) - span], best[span:])
        span *= 2
    points = np.bincount(best & ((1 << 40) - 1), minlength=n)
    picked = np.flatnonzero(points >= RUN // 4)
    return picked if len(picked) else np.array([int(np.argmax(points))])


def _hashed(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(starts), 4096):
        rows = data[starts[at : at + 4096, None] + np.arange(WINDOW)].astype(np.uint64)
        out.append(mix((rows * _COEFFICIENTS).sum(axis=1, dtype=np.uint64) + np.uint64(WINDOW)))
    return np.concatenate(out)


def _short_windows(data: np.ndarray) -> np.ndarray:
    """Hashes of the short windows that a text of this size keeps, in order."""
    share = min(1.0, (SMALL_TEXT / len(data)) ** 2)
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(data) - SMALL_WINDOW + 1, STRETCH):
        piece = data[at : at + STRETCH + SMALL_WINDOW - 1]
        values = np.lib.stride_tricks.sliding_window_view(piece, SMALL_WINDOW).copy().view("<u8")[:, 0]
        hashes = mix(values + np.uint64(SMALL_WINDOW))
        out.append(hashes[hashes <= limit])
    return np.concatenate(out)


def features(data: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Hashes of the chosen windows in order, then those of the short windows.

    ``ranks`` has the rank of every window. A text below the short window is one feature, an
    empty one has none.
    """
    if not len(data):
        return np.zeros(0, np.uint64)
    if len(data) < SMALL_WINDOW:
        return np.frombuffer(hashlib.sha256(data.tobytes()).digest()[:8], "<u8").astype(np.uint64)
    return np.concatenate([_hashed(data, chosen(ranks)), _short_windows(data)])


class Fingerprint:
    """Chained filters as rows of bits, and the features each has taken."""

    def __init__(self, hashes: np.ndarray):
        n = -(-len(hashes) // PER_FILTER)
        self.bits = np.zeros((n, BITS), bool)
        if n:
            row = np.arange(len(hashes)) // PER_FILTER
            for k in range(HASHES):
                self.bits[row, ((hashes >> np.uint64(11 * k)) % np.uint64(BITS)).astype(np.int64)] = True
        self.taken = np.minimum(PER_FILTER, len(hashes) - PER_FILTER * np.arange(n))
        self.weight = self.bits.sum(axis=1)

    def text(self) -> str:
        """``features:filters`` with the filters in base 64."""
        data = np.packbits(self.bits, axis=1, bitorder="little").tobytes()
        return f"{int(self.taken.sum())}:{base64.b64encode(data).decode()}"


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1. Every filter of the fingerprint with fewer filters meets its best partner.

    Equal fingerprints have 1, an empty one has 0 with any other. Symmetric.
    """
    if a.bits.shape == b.bits.shape and (a.bits == b.bits).all():
        return 1.0
    if not len(a.bits) or not len(b.bits):
        return 0.0
    if len(a.bits) == len(b.bits):
        return (_one_way(a, b) + _one_way(b, a)) / 2
    return _one_way(a, b) if len(a.bits) < len(b.bits) else _one_way(b, a)


def _one_way(a: Fingerprint, b: Fingerprint) -> float:
    total = 0.0
    other = b.bits.astype(np.float32)
    for at in range(0, len(a.bits), 256):
        own, weight = a.bits[at : at + 256].astype(np.float32), a.weight[at : at + 256]
        shared = own @ other.T
        chance = weight[:, None] * b.weight[None, :] / BITS
        most = np.minimum(weight[:, None], b.weight[None, :])
        # a margin over chance, so that unrelated filters score 0
        floor = chance + MARGIN * (most - chance)
        score = np.clip((shared - floor) / np.maximum(most - floor, 1e-9), 0, 1)
        total += float((score.max(axis=1) * a.taken[at : at + 256]).sum())
    return total / float(a.taken.sum())


class Ranked:
    """A text, its bytes and the ranks of their windows."""

    def __init__(self, text: str, data: np.ndarray, ranks: np.ndarray):
        self.text, self.data, self.ranks = text, data, ranks

    def fingerprint(self) -> Fingerprint:
        return Fingerprint(features(self.data, self.ranks))


def ranked(text: str, table: np.ndarray) -> Ranked:
    data = np.frombuffer(text.encode(), np.uint8)
    return Ranked(text, data, table[window_steps(data)])


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as many first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def ranked_edited(own: Ranked, following: Ranked, table: np.ndarray) -> Ranked:
    """The edited text; only windows across its seam are ranked anew."""
    changed = edited(own.text, following.text)
    data = np.frombuffer(changed.encode(), np.uint8)
    seam = len(own.text[: len(own.text) - len(own.text) // 2].encode())
    across = data[max(0, seam - WINDOW + 1) : seam + WINDOW - 1]
    parts = [
        own.ranks[: max(0, seam - WINDOW + 1)],
        table[window_steps(across)],
        following.ranks[: max(0, len(data) - seam - WINDOW + 1)],
    ]
    return Ranked(changed, data, np.concatenate(parts))


def _with_neighbours(docs: DataFrame, rows: int) -> DataFrame:
    """Rows dealt by ranges of id and text hash, sorted; the row after a range closes it as ``ahead``.

    Ranges are of about ``rows`` rows; an id that many rows share, or rows without one, fill
    several, only copies of one row do not. The first document of every range is sent to the
    range before it as well, the first of all to the last, so no text travels twice but these.
    """
    place = F.struct(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0)), F.xxhash64("text"))
    keyed = docs.withColumn("place", place)
    cuts = cut_points(keyed.select("place"), [], "place", rows)
    n_parts = 1 + max(0, cuts.select(F.size("_cuts")).first()[0])
    keyed = keyed.withColumn("cuts", cuts.scalar())
    keyed = keyed.withColumn("part", range_number(F.col("cuts"), F.col("place"))).drop("cuts")
    by_part = Window.orderBy("part")  # a row a range
    firsts = staged(keyed.groupBy("part").agg(F.min("place").alias("first")), "first-rows")
    last = F.max("part").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ahead = staged(
        firsts.select("first", F.coalesce(F.lag("part").over(by_part), last).alias("before")), "rows-ahead"
    )
    copies = (
        keyed.join(ahead, F.col("place") == F.col("first"))
        .select("doc_id", "text", "place", F.col("before").alias("part"), F.lit(True).alias("ahead"))
        .dropDuplicates(["part"])
    )
    rows_once = keyed.withColumn("ahead", F.lit(False))
    dealt = rows_once.unionByName(copies).repartitionById(n_parts, "part")
    return dealt.sortWithinPartitions("part", "ahead", "place").select("part", "ahead", "doc_id", "text")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and what they have in common.

    One row per input row: ``doc_id, n_chars`` (code points), ``edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``. The next document goes by ascending id,
    nulls first, equal ids by a hash of the text; the last one is followed by the first, a
    single one by itself. A null text counts as empty. An empty table gives no rows.

    Ranks come from the texts of ``docs``, so fingerprints of different tables compare only where
    their entropies are spread alike.
    """
    docs = id_and_text(docs, id_col, text_col)
    counts, n_rows, size = step_counts(docs)
    table = rarity_table(counts)
    rows = min(PART_ROWS, max(1, n_rows * part_bytes // max(1, size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            out = []
            data, offsets = utf8(batch.column("text"))
            ranks = table[window_steps(data)]
            columns = [batch.column(n).to_pylist() for n in ("part", "ahead", "doc_id", "text")]
            for k, (part, ahead, doc_id, text) in enumerate(zip(*columns)):
                start, end = offsets[k], offsets[k + 1]
                text = Ranked(text or "", data[start:end], ranks[start : max(start, end - WINDOW + 1)])
                own = text.fingerprint()
                if held is not None and held[0] == part:
                    _, old_id, old_text, old = held
                    changed = ranked_edited(old_text, text, table)
                    other = changed.fingerprint()
                    digest = hashlib.sha256(changed.data.tobytes()).hexdigest()
                    out.append(
                        (old_id, len(old_text.text), digest, old.text(), other.text(),
                         likeness(old, other), likeness(old, own))
                    )
                held = None if ahead else (part, doc_id, text, own)
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                names = [f.split()[0] for f in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return _with_neighbours(docs, rows).mapInArrow(run, SCHEMA)
