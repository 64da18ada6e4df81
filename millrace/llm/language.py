"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that follows from its code point. A letter
n-gram binds the vectors of its letters, each permuted (rotated) by its place; a text
bundles the vectors of its n-grams, a language those of its training texts. A text is
given the language whose profile has the highest cosine with it. Bundles are sums of
whole numbers, so they do not depend on the order in which tasks finish.

A text in none of the languages has a best language too. What a text must reach to be kept
is learned from the training texts, per language and number of distinct n-grams: their
cosine with their own language, without their own part in it, against the best cosine that
they have with the other languages, which stand for languages that were not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import keep_rows, texts
from millrace.llm.words import mix

SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"
SIZE = 1024
GRAM = 3
#: Training texts of one language, at most about this many.
SAMPLE = 4_000
UNKNOWN = "und"
#: Share of the training texts that lies below the least score before room is left under it.
LOW = 0.01
#: Training texts of a size that a least score is learned from, at least: of one language, of all.
LEAST_OWN, LEAST_ALL = 100, 20
#: Sizes are powers of two of distinct n-grams.
SIZES = 48
#: Characters that are profiled together, and the longest stretch taken at once.
GROUP_CHARS = 300_000
#: Up to so many distinct n-grams, and counts of them in all texts, a matrix of counts is multiplied; beyond
#: that, as in scripts with many letters, the n-grams that occur are added up so many at a time.
DENSE_GRAMS, DENSE_COUNTS, SPARSE_GRAMS = 16_384, 1 << 23, 4_096


def letter_vector(code: int, size: int = SIZE) -> np.ndarray:
    """+1 and -1 for a code point; the same in every process."""
    words = np.arange(-(-size // 64), dtype=np.uint64) + np.uint64(code) * np.uint64(1 << 20) + np.uint64(1)
    bits = np.unpackbits(mix(mix(words)).astype("<u8").view(np.uint8), bitorder="little")[:size]
    return bits.astype(np.int8) * 2 - 1


class Alphabet:
    """Letters met so far; number 0 is the gap between words."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.number = np.full(0x110000, -1, np.int32)
        self.vectors = letter_vector(0, size)[None]

    def numbers(self, text: str) -> np.ndarray:
        """Letters of the lower-cased text, runs of other characters as one 0."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
        out = self.number[codes]
        if len(out) and out.min() < 0:
            new = np.unique(codes[out < 0])
            fresh = [c for c in new.tolist() if chr(c).isalpha()]
            self.number[new] = 0
            self.number[fresh] = np.arange(len(fresh)) + len(self.vectors)
            if fresh:
                self.vectors = np.vstack([self.vectors, *(letter_vector(c, self.size)[None] for c in fresh)])
            out = self.number[codes]
        gap = out == 0
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        return out[keep]


def _stretches(text: str) -> Iterator[str]:
    for at in range(0, len(text), GROUP_CHARS):
        yield text[at : at + GROUP_CHARS + GRAM - 1]


def measured(batch: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vectors of the texts (whole numbers) and how many n-grams differ in each.

    Of a text of several stretches, the number is that of the richest one; without a letter
    it is 0.
    """
    out = np.zeros((len(batch), alphabet.size))
    distinct = np.zeros(len(batch), np.int64)
    group: list[tuple[int, np.ndarray]] = []

    def gram_vectors(grams: np.ndarray, base: int) -> np.ndarray:
        """The first two letters' vectors permuted, and all three bound."""
        vectors = alphabet.vectors[grams % base]
        for shift, letters in ((1, grams // base % base), (2, grams // (base * base))):
            vectors *= np.roll(alphabet.vectors[letters], shift, axis=1)
        return vectors.astype(np.float32)

    def flush() -> None:
        if not group:
            return
        base = len(alphabet.vectors)
        codes = [((n[:-2].astype(np.int64) * base) + n[1:-1]) * base + n[2:] for _, n in group]
        every = np.concatenate(codes)
        if base**3 <= 1 << 22:
            seen = np.zeros(base**3, bool)
            seen[every] = True
            grams = np.flatnonzero(seen)
            place = (np.cumsum(seen) - 1)[every]
        else:
            grams, place = np.unique(every, return_inverse=True)
        row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        if len(grams) <= DENSE_GRAMS and len(codes) * len(grams) <= DENSE_COUNTS:
            counts = np.bincount(row * len(grams) + place, minlength=len(codes) * len(grams))
            counts = counts.reshape(len(codes), len(grams)).astype(np.float32)
            sums = counts @ gram_vectors(grams, base)
            for (k, _), own, n in zip(group, sums, np.count_nonzero(counts, axis=1)):
                out[k] += own
                distinct[k] = max(distinct[k], n)
        else:
            pairs, counts = np.unique(row * len(grams) + place, return_counts=True)
            row, place = pairs // len(grams), pairs % len(grams)
            text = np.array([k for k, _ in group])
            np.maximum.at(distinct, text, np.bincount(row, minlength=len(codes)))
            for at in range(0, len(pairs), SPARSE_GRAMS):
                part = slice(at, at + SPARSE_GRAMS)
                vectors = gram_vectors(grams[place[part]], base) * counts[part, None].astype(np.float32)
                starts = np.flatnonzero(np.append(True, np.diff(row[part]) != 0))
                np.add.at(out, text[row[part][starts]], np.add.reduceat(vectors, starts, axis=0))
        group.clear()

    held = 0
    for k, text in enumerate(batch):
        for stretch in _stretches(text):
            numbers = alphabet.numbers(stretch)
            if not numbers.any():
                continue
            # words are bounded by gaps, so that short texts have n-grams too
            padded = np.concatenate([np.zeros(2, np.int32), numbers, np.zeros(2, np.int32)])
            group.append((k, padded))
            held += len(padded)
            if held >= GROUP_CHARS:
                flush()
                held = 0
    flush()
    return out, distinct


def bundles(batch: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vectors of the texts (whole numbers) and whether each has a letter."""
    out, distinct = measured(batch, alphabet)
    return out, distinct > 0


def size_class(distinct: np.ndarray) -> np.ndarray:
    """The power of two above a number of distinct n-grams."""
    return np.minimum(np.frexp(distinct.astype(float))[1], SIZES - 1)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)


@dataclass
class Profiles:
    """Languages in order and their bundled vectors."""

    languages: list[str]
    vectors: np.ndarray
    alphabet: Alphabet | None = None

    def __getstate__(self):
        return {"languages": self.languages, "vectors": self.vectors, "alphabet": None}

    def compare(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' vectors, their cosines with every language, their distinct n-grams."""
        if self.alphabet is None:
            self.alphabet = Alphabet(self.vectors.shape[1])
        own, distinct = measured(batch, self.alphabet)
        unit = self.vectors / _lengths(self.vectors)[:, None]
        return own, own @ unit.T / _lengths(own)[:, None], distinct

    def best(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of the best language of every text, its score and the distinct n-grams."""
        _, cosine, distinct = self.compare(batch)
        best = np.argmax(cosine, axis=1)
        return best, np.where(distinct > 0, np.clip(cosine[np.arange(len(batch)), best], 0, 1), 0.0), distinct

    def predict(self, batch: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of every text and its cosine, 0 where that is negative.

        Ties go to the language that comes first by name. A text without a letter, and every
        text if no language was learned, is ``und`` with score 0.
        """
        if not self.languages:
            return [UNKNOWN] * len(batch), np.zeros(len(batch))
        best, score, distinct = self.best(batch)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, distinct)], score


def held_out(doc_id: str = "doc_id"):
    """Documents that no profile is learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def _training(docs: DataFrame, sample: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``text, lang, picked`` of the documents that may be learned from; profiles are of the picked ones."""
    own = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    own = own.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    counts = {r.lang: r.n for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = F.lit(0)
    for lang, n in counts.items():
        bound = F.when(F.col("lang") == lang, int(min(1.0, sample / n) * (1 << 30))).otherwise(bound)
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < bound
    return own.select("text", "lang", picked.alias("picked"))


def fit_profiles(
    docs: DataFrame,
    sample: int = SAMPLE,
    size: int = SIZE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Profiles:
    """Profiles from documents that are not held out and have a text, an id and a language.

    Of each language about ``sample`` documents at most take part, chosen by a hash of the
    id. Sums are taken per task, then per language in a shuffle; the driver gets one vector
    per language.
    """
    picked = _training(docs, sample, id_col, text_col, lang_col).where("picked")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet(size)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            vectors, _ = bundles(texts(batch.column(0)), alphabet)
            for lang, vector in zip(batch.column(1).to_pylist(), vectors):
                sums[lang] = sums.get(lang, 0) + vector.astype(np.int64)
        if sums:
            rows = [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(rows, names=["lang", "vector"])

    parts = picked.select("text", "lang").mapInArrow(bundle, "lang string, vector array<bigint>")
    summed = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("v"))
    rows = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("vector")).collect()
    rows.sort(key=lambda r: r.lang)
    vectors = np.array([[x.v for x in r.vector] for r in rows], float).reshape(len(rows), size)
    return Profiles([r.lang for r in rows], vectors)


def identify(
    docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    Only the text enters a prediction. A null text, or one without a letter, is ``und``. Null
    ids are not held out; repeated rows come back as they are; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(held_out(f"`{id_col}`"), F.lit(False)).alias("held_out"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, score = profiles.predict(texts(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(languages, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(predict, SCHEMA)


def least_scores(
    docs: DataFrame,
    profiles: Profiles,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> np.ndarray:
    """The score that a text must exceed, by the place of its language and its size class.

    ``docs`` and ``sample`` are those of the profiles; all training texts take part, not only
    the sample. The least score lies two thirds of the way from the low end of the texts' scores
    in their own language to the middle of their best scores in another one, but below that low
    end by twice the spread of cosines of unrelated vectors at least, so that short texts, which
    cannot be told from other languages, stay. A class with too few texts of a language uses those of
    all languages, or else the class below. The driver gets one row per language and class.
    """
    languages = {lang: k for k, lang in enumerate(profiles.languages)}
    least = np.zeros((len(languages), SIZES))
    if not languages:
        return least

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.array([languages.get(x, -1) for x in batch.column(1).to_pylist()], int)
            vectors, cosine, distinct = profiles.compare(texts(batch.column(0)))
            row = np.arange(len(place))
            # without the text's own part, as a text that was not learned from
            rest = profiles.vectors[place] - vectors * batch.column(2).to_numpy(zero_copy_only=False)[:, None]
            own = (vectors * rest).sum(axis=1) / _lengths(vectors) / _lengths(rest)
            cosine[row, place] = -1
            other = cosine.max(axis=1) if len(languages) > 1 else np.zeros(len(row))
            fine = (place >= 0) & (distinct > 0) & rest.any(axis=1)
            columns = [place.astype(np.int32), size_class(distinct).astype(np.int32), own.round(3), other.round(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c[fine]) for c in columns], names=["place", "size", "own", "other"])

    training = _training(docs, sample, id_col, text_col, lang_col)
    scores = training.mapInArrow(compare, "place int, size int, own double, other double")
    # scores are rounded, so an exact percentile holds few values
    learned = scores.rollup("size", "place").agg(
        F.count(F.lit(1)).alias("n"), F.percentile("own", F.lit(LOW)).alias("low"), F.percentile("other", F.lit(0.5)).alias("other")
    )
    spread = profiles.vectors.shape[1] ** -0.5
    found = {
        (r.place, r.size): max(0.0, r.low - max((r.low - r.other) * 2 / 3, 2 * spread))
        for r in learned.where("size is not null").collect()
        if r.n >= (LEAST_ALL if r.place is None else LEAST_OWN)
    }
    for size in range(1, SIZES):
        for place in range(len(languages)):
            least[place, size] = found.get((place, size), found.get((None, size), least[place, size - 1]))
    return least


def keep_identified(
    docs: DataFrame,
    profiles: Profiles,
    text_col: str = "text",
    least: np.ndarray | None = None,
    id_col: str = "doc_id",
    lang_col: str = "lang",
) -> DataFrame:
    """Rows of ``docs`` in one of the languages, all columns unchanged.

    A row stays if its score is above the least one of its language and size class; these are
    learned from ``docs`` unless given. Rows without a letter go.
    """
    at = docs.columns.index(text_col)
    if least is None:
        least = least_scores(docs, profiles, id_col=id_col, text_col=text_col, lang_col=lang_col)

    def verdict(batch: pa.RecordBatch) -> np.ndarray:
        if not profiles.languages:
            return np.zeros(batch.num_rows, bool)
        best, score, distinct = profiles.best(texts(batch.column(at).cast(pa.string())))
        return (distinct > 0) & (score > least[best, size_class(distinct)])

    return keep_rows(docs, verdict)
