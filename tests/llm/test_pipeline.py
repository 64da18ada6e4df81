"""The corpus pipeline, stage by stage against plain Python, and its contract."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pyarrow as pa
import pytest
from test_jaccard import by_hand as components_by_hand
from test_quality import by_hand as counts_by_hand
from test_quality import walk
from test_secret_scan import by_hand as spans_by_hand
from test_tokens import JSON, check_packing

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm import quality
from millrace.llm.runtime import documents, ready

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Every stage's rows, each stage fed with what the one before wrote."""
    docs = documents(ready(spark), SMALL)
    odd = [(10_000, None, "en", "s", 0), (10_001, "", "en", "s", 0), (10_002, "123 ... !!", None, "s", 10),
           (10_003, docs.first().text, "en", "s", 1), (None, docs.first().text, "en", "s", 1)]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs.unionAll(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        found.append(docs.collect())
    return SimpleNamespace(rows=found, folder=folder)


def key(rows):
    return sorted(map(tuple, rows), key=str)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality rules", "n-gram Jaccard join", "secret scans", "packing",
    ]
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_language(results):
    kept = [r for r in results.rows[0] if any(c.isalpha() for c in r.text or "")]
    assert key(results.rows[1]) == key(kept) and len(kept) < len(results.rows[0])


def test_quality(spark, results):
    labels = spark.read.parquet(f"{results.folder}/labels.parquet")
    docs = spark.createDataFrame(results.rows[1], documents(spark, SMALL).schema)
    trees = quality.fit_quality(docs, labels)
    kept = []
    for r in results.rows[1]:
        n, _, _, _, again = counts_by_hand(r.text)
        _, features = quality.statistics(pa.array([r.text]))
        if n >= 10 and 100 * again <= 20 * n and walk(trees, features[0]) >= 0.5:
            kept.append(r)
    assert key(results.rows[2]) == key(kept)
    good = {r.doc_id for r in labels.where("quality = 1").collect()} & {r.doc_id for r in results.rows[1]}
    assert len(good & {r.doc_id for r in kept}) >= 0.93 * len(good)


def test_near_copies(results):
    rows = results.rows[2]
    own = {d for d, _, component in components_by_hand([(r.doc_id, r.text) for r in rows]) if d == component}
    assert {r.doc_id for r in results.rows[3]} == own
    assert len(results.rows[3]) == len(own) < len(rows)


def test_secrets(results):
    before = {r.doc_id: r for r in results.rows[3]}
    assert before.keys() == {r.doc_id for r in results.rows[4]}
    hits = 0
    for r in results.rows[4]:
        old = before[r.doc_id]
        spans = spans_by_hand(old.text)
        assert spans_by_hand(r.text) == []
        if spans:
            hits += 1
            assert "[SECRET]" in r.text and r.n_chars == len(r.text)
        pieces = re.split(re.escape("[SECRET]"), r.text)
        assert old.text.startswith(pieces[0]) and old.text.endswith(pieces[-1])
        if len(pieces) == 1:
            assert r == old
    assert hits


def test_packing(results):
    from tokenizers import Tokenizer

    check_packing(results.rows[5], results.rows[4], Tokenizer.from_file(JSON), 2048)


def test_run(spark, results):
    run = corpus_pipeline.run(spark, results.folder).collect()
    assert key(r[:5] for r in run) == key(r[:5] for r in results.rows[5])
