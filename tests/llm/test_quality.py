"""Quality rules: counts by brute force, trees, constraints, held-out labels."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality
from millrace.llm.runtime import documents, ready, utf8
from millrace.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PARTS = ["a", "b", "Aé", "#", "|x", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "中", "\x1c", "\x85"]


def by_hand(text: str) -> list[int]:
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if counts[w] > 1 for d in range(5)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered)]


@pytest.fixture(scope="module")
def made():
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 90))) for _ in range(600)]
    return [*texts, "", "x", "a b c d e a b c d e", "w " * 20_000]


def test_counts(made):
    counts, features = quality.statistics(pa.array([*made, None]))
    assert counts.tolist() == [by_hand(t) for t in [*made, ""]]
    assert np.isfinite(features).all()


def test_ranges_do_not_show(made):
    data, offsets = utf8(pa.array(made))
    whole, parts = word_hashes(data, offsets), word_hashes(data, offsets, size=7)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert len(set(whole[0].tolist())) == len({w for t in made for w in WORD.findall(t)})


def walk(trees, row):
    total = trees.base
    for at in trees.roots:
        while trees.child[at] > at:
            at = trees.child[at] + (row[trees.feature[at]] > trees.threshold[at])
        total += trees.value[at]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_and_constraints():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(1500, 3))
    good = ((rows[:, 0] - rows[:, 1] + rng.normal(size=1500) * 0.4) > 0).astype(float)
    trees = quality.fit_trees(rows, good, [1, -1, 0])
    scores = trees.score(rows)
    assert np.allclose(scores[:40], [walk(trees, r) for r in rows[:40]])
    assert ((scores > 0.5) == good).mean() > 0.85
    grid = np.linspace(-4, 4, 200)
    for at in rng.normal(size=(20, 3)):
        line = np.repeat(at[None], 200, axis=0)
        for f, sign in ((0, 1), (1, -1)):
            moved = line.copy()
            moved[:, f] = grid
            assert (np.diff(trees.score(moved)) * sign >= -1e-12).all()
    # a constraint against the data leaves nothing to split on
    assert np.ptp(quality.fit_trees(rows[:, :1], good, [-1]).score(rows[:, :1])) < 0.05


def test_one_class():
    rows = np.zeros((5, 2))
    assert (quality.fit_trees(rows, np.ones(5), [0, 0]).score(rows) > 0.99).all()
    assert (quality.fit_trees(rows, np.zeros(5), [0, 0]).score(rows) < 0.01).all()
    assert (quality.fit_trees(rows[:0], np.zeros(0), [0, 0]).score(rows) > 0.99).all()


def test_labels_not_seen(spark, sf_dir):
    docs = documents(ready(spark), sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality.fit_quality(docs, labels.where("doc_id % 2 = 0"))
    kept = {r.doc_id: r.kept for r in quality.quality_report(docs, trees).collect()}
    truth = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").groupBy("doc_id").min("quality").toDF("doc_id", "quality").collect()}
    bad, good = ([d for d, q in truth.items() if q == v] for v in (0, 1))
    assert sum(not kept[d] for d in bad) >= 0.9 * len(bad)
    assert sum(kept[d] for d in good) >= 0.93 * len(good)


def test_report(spark, made):
    ready(spark)
    rows = [(k, t, 0) for k, t in enumerate(made)] + [(None, None, 0), (5, made[5], 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept int").repartition(3)
    trees = quality.fit_trees(np.zeros((0, len(quality.FEATURES))), np.zeros(0), list(quality.FEATURES.values()))
    got = quality.quality_report(df, trees).collect()
    want = []
    for doc_id, text, _ in rows:
        counts = by_hand(text or "")
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        want.append((doc_id, *counts, failed, not failed))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = quality.keep_good(df, trees)
    assert kept.columns == df.columns and kept.count() == sum(w[-1] for w in want)


def test_odd_labels(spark):
    ready(spark)
    docs = spark.createDataFrame([(1, "word " * 12), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 0), (2, 0)], "doc_id bigint, quality int")
    trees = quality.fit_quality(docs, labels)
    assert quality.quality_report(docs, trees).count() == 2
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.quality_report(empty, quality.fit_quality(empty, labels)).collect() == []
