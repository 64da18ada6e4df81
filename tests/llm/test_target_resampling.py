"""Resampling against plain Python and SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from compare import compare, duck
from millrace.llm import target_resampling, workload
from millrace.llm.runtime import ready

SCHEMA = "doc_id bigint, text string, n_words string, rank int"
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text, longest, n):
    own = words(text)
    runs = [" ".join(own[i : i + k]) for k in range(1, longest + 1) for i in range(len(own) - k + 1)]
    return [zlib.crc32(r.encode()) % n for r in runs]


def plain(docs, target, longest=1, n=10_000, seed=2024, percent=10, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text, longest, n))
    for text in target:
        t.update(buckets(text, longest, n))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (s_all + n)) / ((s[b] + 1) * (t_all + n))))
    out = []
    for doc_id, text in docs:
        own = buckets(text, longest, n)
        weight = sum(map(gain, own))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None, len(words(text))])
    takers = sorted((r for r in out if r[-1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(takers[: percent * len(takers) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=key)


def key(r):
    return (r[0] is None, r[0] or 0, r[4] is None, r[4] or 0)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(6)
    vocabulary = ["alpha", "Beta", "gamma1", "été", "中文", "x", "don't", "a-b", "Ünder", "1999", "<|endoftext|>", "　"]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 19, 25, 60])))) for k in range(600)]
    docs += [(None, "alpha " * 30), (7, None), (8, ""), (9, "again " * 25), (9, "again " * 25), (700, "ALPHA\x00\n" * 4000)]
    return docs, ["alpha beta 中文 " * 20, "ÉTÉ été", None, ""]


@pytest.mark.parametrize("longest,n,percent,least", [(1, 10_000, 10, 20), (3, 70_000, 37, 0), (2, 50, 100, 20)])
def test_against_plain_python(spark, made, monkeypatch, longest, n, percent, least):
    monkeypatch.setattr(target_resampling, "RANGE_ROWS", 40)  # many ranges
    docs, target = made
    df = ready(spark).createDataFrame([(*d, "x", 1) for d in docs], SCHEMA).repartition(4)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = target_resampling.resample(df, goal, longest, n, percent=percent, least_words=least)
    assert sorted(map(tuple, got.collect()), key=key) == plain(docs, target, longest, n, 2024, percent, least)
    drawn = {r.doc_id for r in got.collect() if r.rank}
    assert {r.doc_id for r in target_resampling.drawn_documents(df, got).collect()} == drawn - {None}


def test_words_have_offsets():
    splitter = target_resampling.WordSplitter(1, 10)
    text = "Été, l'AN 中文-x9\x7f!"
    lowered = text.encode().lower().decode()
    found = splitter.words(text)
    assert [w for w, _ in found] == words(text) and all(lowered[a:b] == w for w, (a, b) in found)


def test_hot_scores_are_ranked_in_many_ranges(spark, monkeypatch):
    """A third of the rows have one score; ranks stay gapless and unique."""
    monkeypatch.setattr(target_resampling, "RANGE_ROWS", 100)
    n = 5000
    scores = spark.range(n).selectExpr(
        "id AS doc_id", "30L AS n_words", "30L AS n_features", "0L AS weight", "IF(id % 3 = 0, 500L, id * 7919 % 1000) AS score"
    )
    ranked = target_resampling.rank_drawn(scores, percent=60).where("rank IS NOT NULL").orderBy("rank").collect()
    want = sorted((-(500 if i % 3 == 0 else i * 7919 % 1000), i) for i in range(n))[: n * 60 // 100]
    assert [r.rank for r in ranked] == list(range(1, len(want) + 1))
    assert [(-r.score, r.doc_id) for r in ranked] == want


def test_against_sql(spark, sf_dir):
    name = "op12_resampling"
    count, problems = compare(workload.queries()[name](spark, sf_dir), duck(sf_dir), workload.oracle_sql()[name])
    assert problems == [] and count


def test_empty(spark):
    empty = ready(spark).createDataFrame([], "doc_id bigint, text string")
    assert target_resampling.resample(empty, empty).collect() == []
    one = spark.createDataFrame([(1, "word " * 30)], "doc_id bigint, text string")
    assert [r.rank for r in target_resampling.resample(one, empty, percent=100).collect()] == [1]
