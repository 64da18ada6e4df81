"""Fingerprints: ranks by definition, order of documents, likeness."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fingerprint as fp
from millrace.llm.runtime import documents, ready


def step(window: bytes) -> int:
    counts = np.bincount(np.frombuffer(window, np.uint8))
    weight = sum(round(int(c) * math.log2(c) * 65536) for c in counts[counts > 0])
    most = round(fp.WINDOW * math.log2(fp.WINDOW) * 65536)
    return round((most - weight) * (fp.STEPS / most))


def steps_of(text: str) -> list[int]:
    data = text.encode()
    return [step(data[k : k + fp.WINDOW]) for k in range(len(data) - fp.WINDOW + 1)]


def table_of(texts) -> np.ndarray:
    """Ranks by sorting: dull entropies last, the rarest first, the smaller of equals first."""
    seen = Counter(s for t in texts for s in steps_of(t or ""))
    order = sorted(range(fp.STEPS + 1), key=lambda s: (s < fp.DULL * fp.STEPS, seen[s], s))
    ranks = np.zeros(fp.STEPS + 1, np.uint16)
    ranks[order] = np.arange(fp.STEPS + 1)
    return ranks


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    common = words(0, 400).split()
    return " ".join(rng.choice(common) for _ in range(n))


TABLE = table_of([words(0, 300)])


def mark(text: str) -> fp.Fingerprint:
    return fp.ranked(text, TABLE).fingerprint()


def test_steps_by_definition():
    text = words(1, 60) + "\x00" * 50 + "é中" * 20
    assert fp.window_steps(np.frombuffer(text.encode(), np.uint8)).tolist() == steps_of(text)


def test_rarity_is_counted_over_all_texts(spark):
    ready(spark)
    texts = [words(k, 5 * k) for k in range(12)] + ["", None, "a" * 31, "b" * 32, "é" * 40, "x"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    counts, n, size = fp.step_counts(docs)
    assert (n, size) == (len(texts), sum(len((t or "").encode()) for t in texts))
    assert {s: c for s, c in enumerate(counts.tolist()) if c} == Counter(s for t in texts for s in steps_of(t or ""))
    assert fp.rarity_table(counts).tolist() == table_of(texts).tolist()


@pytest.mark.parametrize("n", [1, 8, 9, 40, 128, 129, 500])
def test_choice_by_definition(n):
    ranks = np.random.default_rng(n).integers(0, 50, n).astype(np.uint16)
    points = np.zeros(n, int)
    for start in range(n - fp.RUN + 1):
        points[start + int(np.argmin(ranks[start : start + fp.RUN]))] += 1
    want = np.flatnonzero(points >= fp.RUN // 4).tolist() if n > fp.RUN else [int(np.argmin(ranks))]
    assert fp.chosen(ranks).tolist() == (want or [int(np.argmax(points))])


def test_stretches_do_not_show(monkeypatch):
    data = np.frombuffer(words(2, 3000).encode(), np.uint8)
    steps, whole = fp.window_steps(data), fp.features(data, TABLE[fp.window_steps(data)])
    monkeypatch.setattr(fp, "STRETCH", 100)
    assert (fp.window_steps(data) == steps).all()
    assert (fp.features(data, TABLE[steps]) == whole).all()


@pytest.mark.parametrize("sizes", [(0, 50), (1, 1), (9, 9), (40, 3), (70, 64), (64, 400), (333, 0)])
def test_edited_text_is_ranked_as_a_text_of_its_own(sizes):
    own, following = (fp.ranked(words(k, 120)[:n] + "é" * (n % 2), TABLE) for k, n in enumerate(sizes))
    changed = fp.ranked_edited(own, following, TABLE)
    assert changed.text == fp.edited(own.text, following.text)
    assert changed.ranks.tolist() == fp.ranked(changed.text, TABLE).ranks.tolist()


def test_likeness():
    a, b = words(3, 900), words(4, 900)
    one, other = mark(a), mark(b)
    assert fp.likeness(one, mark(a)) == 1
    assert fp.likeness(one, other) < 0.05 and fp.likeness(one, other) == fp.likeness(other, one)
    half = fp.likeness(one, mark(fp.edited(a, b)))
    assert 0.35 < half < 0.65
    near = fp.likeness(one, mark(a.replace(a[300:320], "x", 1)))
    assert near > 0.85
    empty = mark("")
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, one) == 0
    assert empty.text() == "0:"
    assert fp.likeness(mark("That it is."), mark("That it was.")) > 0
    assert fp.likeness(mark("ab"), mark("ab")) == 1


@pytest.mark.parametrize("size", [150, 190, 198, 199, 200, 201, 210, 400, 1000])
def test_no_size_stands_out(size):
    scores = [fp.likeness(mark(t[:size]), mark(t[: size + 4])) for t in (words(k, 400) for k in range(20))]
    assert min(scores) > 0.9


@pytest.mark.parametrize("n", [30, 80, 300])
def test_likeness_of_prose(n):
    pairs = [(prose(k, n), prose(k + 1000, n)) for k in range(20)]
    apart = [fp.likeness(mark(a), mark(b)) for a, b in pairs]
    halves = [fp.likeness(mark(a), mark(fp.edited(a, b))) for a, b in pairs]
    assert np.mean(apart) < 0.05 and max(apart) < 0.2
    assert 0.3 < np.mean(halves) < 0.7


def test_filters_are_chained():
    chained = fp.Fingerprint(np.arange(fp.PER_FILTER * 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert chained.bits.shape == (3, fp.BITS) and chained.taken.tolist() == [fp.PER_FILTER, fp.PER_FILTER, 1]


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    table, out = table_of(text for _, text in rows), []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, other, following = (fp.ranked(t, table).fingerprint() for t in (text, changed, after))
        out.append(
            (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.text(), other.text(),
             fp.likeness(own, other), fp.likeness(own, following))
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [1, 700, 4000, 1 << 20])
def test_order_over_ranges(spark, part_bytes):
    ready(spark)
    rng = random.Random(7)
    rows = [(k * 3 - 20, words(k, rng.choice([0, 1, 5, 60, 200]))) for k in range(40)]
    rows += [(None, "no id é"), (500, None), (501, ""), (502, "é" * 31)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id bigint, text string, part string, near_next double")
    got = fp.fingerprints(df.repartition(4), part_bytes=part_bytes).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_small_tables(spark):
    schema = "doc_id bigint, text string"
    assert fp.fingerprints(spark.createDataFrame([], schema)).collect() == []
    (one,) = fp.fingerprints(spark.createDataFrame([(1, "alone in here")], schema)).collect()
    assert one.near_next == 1 and one.n_chars == 13
    same = spark.createDataFrame([(1, "twice")] * 3, schema)
    assert len(fp.fingerprints(same, part_bytes=4).collect()) == 3


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_are_spread(spark, doc_id):
    ready(spark)
    docs = spark.createDataFrame([(doc_id, words(k, 20)) for k in range(300)], "doc_id bigint, text string")
    dealt = fp._with_neighbours(docs, 20).where("NOT ahead").groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in dealt.collect()]
    assert sum(sizes) == 300 and max(sizes) <= 40


def test_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in documents(ready(spark), sf_dir).collect()]
    some = rows[:120]
    df = spark.createDataFrame(some, "doc_id bigint, text string").repartition(5)
    assert sorted(map(tuple, fp.fingerprints(df).collect()), key=str) == expected(some)
