"""Jaccard links and components against all pairs by brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.components import components
from millrace.llm.runtime import documents, ready


def shingles(text: str | None) -> frozenset:
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def by_hand(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return sorted(
        ((d, len(sets[k]), least.get(find(k)) if sets[k] else d) for k, (d, _) in enumerate(rows)), key=str
    )


def made(seed: int, n: int) -> list[tuple]:
    """Chains of edits, short texts, shared passages, exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.5:  # an edit of an earlier text
            words = rng.choice(texts[-8:]).split(" ")
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: -rng.randint(1, 3)] or words
            texts.append(" ".join(words))
        elif kind < 0.6:
            texts.append(" ".join(rng.choice("ABc") for _ in range(rng.randint(1, 6))))
        else:
            own = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80)))
            texts.append(own + " " + passage if rng.random() < 0.5 else own)
    rows = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    return [*rows, (2000, None), (2001, ""), (2002, " \n"), (3, texts[0]), (3, texts[0]), (None, texts[1]), (None, "only one without id here")]


@pytest.mark.parametrize("block_tokens", [40, 2_000_000])
def test_components(spark, block_tokens, monkeypatch):
    ready(spark)
    monkeypatch.setattr(jaccard, "HOT_BUCKET", 3)  # salts as well
    monkeypatch.setattr(jaccard, "GROUP_SETS", 5)  # and blocks
    rows = made(block_tokens, 260)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, component_id int").repartition(5)
    got = jaccard.jaccard_components(df, block_tokens=block_tokens).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows)


def test_shuffled_members(spark, monkeypatch):
    """The way for long lists of members: no broadcast."""
    monkeypatch.setattr(jaccard, "BROADCAST_NODES", 0)
    rows = made(9, 120)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str) == by_hand(rows)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_tree_loses_no_link(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(250):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.6 else rng.integers(0, 1 << 63, rng.integers(1, 60), dtype=np.uint64)
        cut = base[rng.random(len(base)) > 0.08] if rng.random() < 0.8 else base
        sets.append(np.unique(np.append(cut, rng.integers(0, 1 << 63, rng.integers(0, 3), dtype=np.uint64))))
        if not len(sets[-1]):
            sets.pop()
    want = jaccard.Links(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            if jaccard.linked(sets[i], sets[j], percent):
                want.join(i, j)
    got = jaccard.Links(len(sets))
    for a, b in jaccard.link_sets(sets, percent):
        assert jaccard.linked(sets[a], sets[b], percent)
        got.join(a, b)
    assert (got.labels() == want.labels()).all()


def test_tree_prunes():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64)) for _ in range(600)]
    sizes = np.array([len(s) for s in sets])
    tree, links = jaccard.SignatureTree([jaccard.signature(s) for s in sets], sizes), jaccard.Links(len(sets))
    assert sum(len(a) for a, _ in tree.candidates(links, 80)) == 0


def test_link_is_exact_at_the_border():
    a = np.arange(9, dtype=np.uint64)
    assert jaccard.linked(a, a[:8], 80) and jaccard.linked(np.arange(5, dtype=np.uint64), np.arange(4, dtype=np.uint64), 80)
    assert not jaccard.linked(np.arange(9, dtype=np.uint64), np.arange(7, dtype=np.uint64), 80)


def test_graph_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    links = jaccard.Links(300)
    for a, b in edges:
        links.join(a, b)
    labels = links.labels()
    assert got == {n: labels[n] for e in edges for n in e if e[0] != e[1]} | {n: got[n] for n in got if n not in labels}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_keep_first(spark):
    rows = made(5, 150)
    df = spark.createDataFrame([(*r, k % 3) for k, r in enumerate(rows)], "doc_id bigint, text string, source int")
    kept = jaccard.keep_first(df)
    found = {}
    for doc_id, _, component in by_hand(rows):
        found.setdefault(doc_id, []).append(component)
    want = {d for d, c in found.items() if any(x == d for x in c)}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.jaccard_components(empty).collect() == []
    assert jaccard.keep_first(empty).collect() == []


def test_table_by_sql(spark, sf_dir):
    import compare

    from millrace.llm import workload

    for name, sql in workload.oracle_sql().items():
        rows, problems = compare.compare(workload.queries()[name](spark, sf_dir), compare.duck(sf_dir), sql)
        assert rows and not problems, (name, problems)


def test_keep_first_with_clashing_names_and_maps(spark):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [
        (1, words, {"a": 1}, True, 7), (2, words + " x", {"a": 1}, True, 7), (3, "other words here", None, False, 1),
        (3, "other words here", None, False, 1), (3, "other words here", {"b": 2}, False, 1), (None, None, None, None, None),
    ]
    schema = "doc_id bigint, text string, __listed_id map<string,int>, _gone_ boolean, _nth_ int"
    kept = jaccard.keep_first(ready(spark).createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "__listed_id", "_gone_", "_nth_"]
    assert sorted(((r.doc_id, r["__listed_id"]) for r in kept.collect()), key=str) == [
        (1, {"a": 1}), (3, None), (3, {"b": 2}), (None, None),
    ]
