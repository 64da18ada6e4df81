"""Resampling documents towards the distribution of a target collection.

Texts are lower-cased in A to Z and divided by an untrained ``Split`` pre-tokeniser of the
tokenizers library, which gives words with their offsets. Features are windows of one to
``longest`` consecutive words; a window's CRC goes on from the one that is a word shorter. Each
feature falls into a CRC bucket. Histograms over all documents and over the whole target
give each bucket a gain, the log ratio of its smoothed shares, and a document weighs the sum of
its features' gains. Noise by a hash of the id turns the weights into scores (the Gumbel trick), so
that the highest scores are a sample without replacement.

The texts are read once: per document the buckets are written, two bytes a feature. Both
histograms are partial aggregates of at most ``buckets`` rows a task. Ranks come from ranges of
scores that are counted first; only ranges that reach into the draw are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import id_and_text, texts
from millrace.llm.tokens import SLICE, PieceIds
from millrace.operators.ranges import cut_points, range_number
from millrace.session import staged

#: A word, the number of buckets, the seed of the noise, who takes part and the share drawn.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Rows of a range of scores: at least these, more where there would be very many ranges.
RANGE_ROWS = 10_000

FEATURES = "doc_id bigint, n_words bigint, n_features bigint, buckets binary"


class WordSplitter:
    """Words of texts with their offsets, and the CRC buckets of their windows."""

    def __init__(self, longest: int, buckets: int):
        from tokenizers import Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.longest, self.buckets = longest, buckets
        self.known = PieceIds(self._checksums)

    @staticmethod
    def _checksums(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sums = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words))
        return sums, np.arange(len(words)), np.ones(len(words), np.int64)

    def words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        """``(word, (start, end))`` in code points; of bytes, lower-casing changes A to Z only."""
        return self.split.pre_tokenize_str(text.encode().lower().decode()) if text else []

    def __call__(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The buckets of all texts end to end, and the number of words and features of each."""
        flat, n_words = [np.zeros(0, np.int64)], []
        at = 0
        while at < len(batch):
            held: list[list[str]] = []
            size = 0
            while at < len(batch) and (size < SLICE or not size):
                held.append([word for word, _ in self.words(batch[at])])
                size += len(batch[at])
                at += 1
            n_words += map(len, held)
            if self.longest == 1:
                flat.append(self.known([w for own in held for w in own])[0] % self.buckets)
            else:
                flat += [self._windows(own) for own in held]
        n_words = np.array(n_words, np.int64)
        n_features = sum(np.maximum(n_words - k, 0) for k in range(self.longest))
        return np.concatenate(flat), n_words, n_features

    def _windows(self, words: list[str]) -> np.ndarray:
        """Buckets of all windows of a text, the windows of one word first."""
        sums = self.known(words)[0].tolist()
        out = [sums]
        tails = [b" " + w.encode() for w in words]
        for n in range(1, self.longest):
            sums = [zlib.crc32(tail, before) for before, tail in zip(sums, tails[n:])]
            out.append(sums)
        return np.array([c for level in out for c in level], np.int64) % self.buckets


def text_features(
    docs: DataFrame, longest: int = 1, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_features, buckets`` per row, written to the scratch folder.

    ``buckets`` holds one unsigned number a feature, of 16 bits up to 65,536 buckets and of 32
    above. A null text has no features.
    """
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = WordSplitter(longest, buckets)
        for batch in batches:
            flat, n_words, n_features = splitter(texts(batch.column(1)))
            data = flat.astype(kind).tobytes()
            ends = np.append(0, np.cumsum(n_features)) * kind.itemsize
            held = pa.array([data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), held],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

    return staged(id_and_text(docs, id_col, text_col).mapInArrow(extract, FEATURES), "features")


def _numbers(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column end to end, and the bounds of its rows."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    held = column.to_pylist()
    bounds = np.cumsum([0, *map(len, held)]) // kind.itemsize
    return np.frombuffer(b"".join(held), kind).astype(np.int64), bounds


def histogram(features: DataFrame, buckets: int = BUCKETS, name: str = "n") -> DataFrame:
    """``(bucket, n)`` over all rows; empty buckets have no line."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    partial = features.select("buckets").mapInArrow(count, "bucket bigint, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` for every bucket: how much more of the target than of the source falls into it.

    ``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))`` with the counts ``s`` and ``t``
    of the bucket and ``S`` and ``T`` of all features.
    """
    s, t = histogram(source, buckets, "s"), histogram(target, buckets, "t")
    counts = (
        source.sparkSession.range(buckets)
        .select(F.col("id").alias("bucket"))
        .join(s, "bucket", "left")
        .join(t, "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    counts = staged(counts, "histograms")
    totals = counts.agg(F.struct(F.sum("s").alias("s"), F.sum("t").alias("t")).alias("all")).scalar()
    of_target = (F.col("t") + 1) * (totals["s"] + buckets)
    of_source = (F.col("s") + 1) * (totals["t"] + buckets)
    return counts.select("bucket", F.floor(1000 * F.log(of_target / of_source)).alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """``floor(-1000 * ln(-ln(u)))`` with ``u`` from the first 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32))))


def importance_scores(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` per row of ``docs``, written to the scratch folder."""
    source = text_features(docs, longest, buckets, id_col, text_col)
    goal = text_features(target.select(F.lit(0).alias("doc_id"), F.col(f"`{target_text}`").alias("text")), longest, buckets)
    # as many numbers as there are buckets, whatever the size of the tables
    gain_of = np.zeros(buckets, np.int64)
    for row in bucket_gains(source, goal, buckets).collect():
        gain_of[row["bucket"]] = row["gain"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = _numbers(batch.column(3), buckets)
            sums = np.append(0, np.cumsum(gain_of[flat]))[bounds]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(sums))], names=["doc_id", "n_words", "n_features", "weight"]
            )

    weights = source.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    return staged(weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")


def rank_drawn(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with ``rank``, 1, 2, 3... for the drawn rows, else null.

    Drawn are the highest ``floor(percent * N / 100)`` of the ``N`` rows with enough words,
    ties to the smaller id, missing ids last. The rows are cut into ranges of their order, which are
    counted; a rank is the number of rows in better ranges and the place in the own one.
    """
    in_order = F.struct(
        (-F.col("score")).alias("s"),
        F.col("doc_id").isNull().alias("none"),
        F.col("doc_id").alias("id"),
        F.col("n_features").alias("n"),
        F.col("weight").alias("w"),
    )
    # one and the same key for all rows, though the planner does not see it: an equi-join meets the cuts
    one_key = F.pmod(F.hash("doc_id"), F.lit(1))
    eligible = scores.where(F.col("n_words") >= least_words).select("*", in_order.alias("_order"), one_key.alias("_key"))
    n = eligible.count()
    rows = max(RANGE_ROWS, 10 * math.isqrt(n))
    cuts = cut_points(eligible, ["_key"], "_order", rows)
    placed = eligible.join(cuts, "_key", "left").withColumn("_range", range_number(F.col("_cuts"), F.col("_order")))
    placed = placed.drop("_cuts", "_key")
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ranges = staged(
        ranges.select(F.col("_range").alias("_r"), F.coalesce(before, F.lit(0)).alias("_before")), "score-ranges"
    )
    drawn = n * percent // 100
    placed = placed.join(ranges, F.col("_range") == F.col("_r"))
    reached = F.col("_before") < drawn
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_order")) + F.col("_before")
    ranked = placed.where(reached).withColumn("_place", place)
    ranked = ranked.withColumn("rank", F.when(F.col("_place") <= drawn, F.col("_place")).cast("bigint"))
    rest = placed.where(~reached).select(*scores.columns).unionAll(scores.where(F.col("n_words") < least_words))
    return ranked.select(*scores.columns, "rank").unionAll(rest.withColumn("rank", F.lit(None).cast("bigint")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_features, weight, score, rank``, the last null where not drawn.

    A null text has no features and weight 0; a missing id takes its noise from an empty id. Repeated
    rows each take part, equal ones in any order. An empty target gives gains by the source alone; an
    empty table gives no rows. Other columns are not read.
    """
    scores = importance_scores(docs, target, longest, buckets, seed, id_col, text_col, target_text)
    return rank_drawn(scores, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, ranked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn, all columns unchanged."""
    drawn = ranked.where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn"))
    return docs.join(drawn, F.col(f"`{id_col}`").cast("bigint") == F.col("_drawn"), "left_semi")
