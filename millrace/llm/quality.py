"""Quality rules: gradient-boosted trees over document statistics.

Fixed rules come first (too few words, too many repeated ones). Documents that pass them
are judged by trees that are grown here in numpy from labelled documents: histogram
splits on quantile bins, logistic loss, and a monotonic constraint per feature, so that
more symbols, repeats or doubled lines never raise a score. The trees are flattened into
arrays of nodes and all documents of a batch walk down a level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import id_and_text, keep_rows, texts, utf8
from millrace.llm.words import IN_WORD, WINDOW, window_hashes, word_hashes

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean"
)

# Base rules: fixed values
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"

#: Labelled documents used for fitting, at most about this many.
SAMPLE = 20_000
#: Score from which a document is kept.
KEEP = 0.5

#: Features and the direction in which the score may move with them.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "upper_share": -1,
    "digit_share": -1,
    "mark_share": -1,
    "other_words": 0,
    "words_per_line": 0,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


#: One column per class of bytes; code points are counted by their first byte.
_CLASSES = np.stack(
    [
        np.array([int(IN_WORD[b] and b & 0xC0 != 0x80) for b in range(256)]),
        _table(SYMBOLS),
        _table(bytes(range(ord("A"), ord("Z") + 1))),
        _table(b"0123456789"),
        _table(b"!?\"'()+-/=@[]\\^_`{}~;:"),
    ],
    axis=1,
)


def repeated(windows: np.ndarray, n: int = WINDOW) -> int:
    """Words that lie in a window found twice or more."""
    if len(windows) < 2:
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    edges = np.zeros(len(windows) + n, np.int64)
    edges[again] += 1
    np.subtract.at(edges, again + n, 1)
    return int((np.cumsum(edges) > 0).sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those among them that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text the five counts (integers) and the features."""
    data, offsets = utf8(column)
    words, bounds = word_hashes(data, offsets)
    windows = window_hashes(words)
    counts = np.zeros((len(column), len(COUNTS)), np.int64)
    features = np.zeros((len(column), len(FEATURES)))
    for k, text in enumerate(texts(column)):
        low, high = int(bounds[k]), int(bounds[k + 1])
        n = high - low
        own = data[offsets[k] : offsets[k + 1]]
        chars, symbols, upper, digits, marks = (np.bincount(own, minlength=256) @ _CLASSES).tolist()
        n_lines, doubled = duplicate_lines(text)
        again = repeated(windows[low : high - WINDOW + 1]) if n > WINDOW else 0
        counts[k] = n, chars, symbols, doubled, again
        distinct = len(np.unique(words[low:high]))
        some, some_chars = max(n, 1), max(chars, 1)
        features[k] = (
            np.log1p(n), chars / some, symbols / some, doubled / max(n_lines, 1), again / some,
            upper / some_chars, digits / some_chars, marks / some_chars, distinct / some, n / max(n_lines, 1),
        )
    return counts, features


@dataclass
class Trees:
    """Flattened trees: per node the feature, threshold and first child; leaves point to themselves."""

    base: float = 0.0
    roots: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    child: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    depth: int = 0

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of good quality per row."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                right = rows[every, self.feature[at]] > self.threshold[at]
                inner = self.child[at] > at
                at = np.where(inner, self.child[at] + right, at)
            total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_trees(
    rows: np.ndarray,
    good: np.ndarray,
    directions: list[int],
    n_trees: int = 80,
    depth: int = 3,
    rate: float = 0.15,
    n_bins: int = 64,
    ridge: float = 1.0,
    least: int = 10,
) -> Trees:
    """Boosted trees for ``good`` (0 or 1). One class only, or no rows, gives a constant.

    ``directions`` holds 1, -1 or 0 per feature. A split that orders its children against
    the direction is not taken, and the middle of two children bounds what lies below them.
    """
    if not len(good) or good.min() == good.max():
        return Trees(base=-40.0 if len(good) and not good.max() else 40.0)
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) for f in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    rate_good = good.mean()
    base = float(np.log(rate_good / (1 - rate_good)))
    logit = np.full(len(good), base)
    feature, threshold, child, value, roots = [], [], [], [], []

    def node() -> int:
        for column, start in ((feature, 0), (threshold, 0.0), (child, -1), (value, 0.0)):
            column.append(start)
        return len(feature) - 1

    def weight(g: np.ndarray | float, h: np.ndarray | float) -> np.ndarray | float:
        return -g / (h + ridge)

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = p - good, np.maximum(p * (1 - p), 1e-9)
        root = node()
        roots.append(root)
        open_nodes = [(root, np.arange(len(good)), -np.inf, np.inf, 0)]
        while open_nodes:
            k, own, low, high, level = open_nodes.pop()
            g, h = float(grad[own].sum()), float(hess[own].sum())
            best = (1e-6, None)
            for f in range(rows.shape[1]) if level < depth and len(own) >= 2 * least else ():
                size = len(edges[f]) + 1
                gl = np.cumsum(np.bincount(bins[own, f], grad[own], size))[:-1]
                hl = np.cumsum(np.bincount(bins[own, f], hess[own], size))[:-1]
                nl = np.cumsum(np.bincount(bins[own, f], minlength=size))[:-1]
                wl, wr = np.clip(weight(gl, hl), low, high), np.clip(weight(g - gl, h - hl), low, high)
                gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
                ok = (nl >= least) & (len(own) - nl >= least) & (directions[f] * (wr - wl) >= 0)
                gain = np.where(ok, gain, -np.inf)
                if len(gain) and gain.max() > best[0]:
                    cut = int(np.argmax(gain))
                    best = (float(gain[cut]), (f, cut, float(wl[cut]), float(wr[cut])))
            if best[1] is None:
                value[k] = rate * float(np.clip(weight(g, h), low, high))
                child[k] = k
                logit[own] += value[k]
                continue
            f, cut, wl, wr = best[1]
            left = node()
            right = node()
            feature[k], threshold[k], child[k] = f, float(edges[f][cut]), left
            middle = (wl + wr) / 2
            lows, highs = [low, low], [high, high]
            if directions[f] > 0:
                highs[0], lows[1] = middle, middle
            elif directions[f] < 0:
                lows[0], highs[1] = middle, middle
            on_left = bins[own, f] <= cut
            open_nodes.append((left, own[on_left], lows[0], highs[0], level + 1))
            open_nodes.append((right, own[~on_left], lows[1], highs[1], level + 1))
    return Trees(
        base, roots, np.array(feature, np.int32), np.array(threshold), np.array(child, np.int32), np.array(value), depth
    )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Trees:
    """Trees from documents with a ``quality`` label, about ``sample`` of them at most.

    The sample goes by a hash of the id. A document with several labels counts as bad if one
    says so; labels without id or quality, and labels of unknown documents, are left out.
    Documents that the base rules reject do not take part.
    """
    own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    own = own.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, sample / max(1, own.count()))
    own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    names = [f"f{k}" for k in range(len(FEATURES))]
    # the sample is bounded, so is the broadcast side
    picked = id_and_text(docs, id_col, text_col).join(F.broadcast(own), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = statistics(batch.column(1))
            fine = ~base_failed(counts)
            columns = [batch.column(0), batch.column(2), *(pa.array(c) for c in features.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", *names]).filter(pa.array(fine))

    schema = "doc_id bigint, quality int, " + ", ".join(f"{n} double" for n in names)
    table = picked.mapInArrow(measure, schema).toPandas().sort_values(["doc_id", *names])
    good = (table["quality"].to_numpy() > 0).astype(float)
    return fit_trees(table[names].to_numpy(float), good, list(FEATURES.values()))


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def judge(column: pa.Array, trees: Trees, keep: float = KEEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, the base rules' failures, and the verdict per text."""
    counts, features = statistics(column)
    failed = base_failed(counts)
    return counts, failed, ~failed & (trees.score(features) >= keep)


def quality_report(
    docs: DataFrame, trees: Trees, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: the five counts, ``base_failed`` and ``kept``.

    A null text has no words and fails the base rules; repeated rows and null ids come back
    as they are; an empty table gives no rows.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, failed, kept = judge(batch.column(1), trees, keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts.T), pa.array(failed), pa.array(kept)],
                names=["doc_id", *COUNTS, "base_failed", "kept"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(report, SCHEMA)


def keep_good(docs: DataFrame, trees: Trees, keep: float = KEEP, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that are kept, with all their columns."""
    at = docs.columns.index(text_col)
    return keep_rows(docs, lambda batch: judge(batch.column(at).cast(pa.string()), trees, keep)[2])
