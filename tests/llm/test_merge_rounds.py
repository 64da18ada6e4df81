"""Merge rounds against the sentencepiece library and against merging one pair at a time."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from millrace.llm import merge_rounds
from millrace.llm.runtime import documents, ready
from millrace.llm.tokens import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
PARTS = list("abzAZ019 .,;:!?'\"<|>-_\n\t\r\x0b\x1c\x00\x85\xa0éßñ中文१😀") + [
    "▁", "　", "̀", "<s>", "</s>", "<unk>", "<0x0A>", "  ", "\n\n", "word ", "Word, ", "end.\n", " the", "aaaa", "    ", "ing",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def rounds():
    return merge_rounds.MergeRounds(MODEL)


def odd_texts():
    rng = random.Random(8)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 24))) for _ in range(6000)]
    long = ["a" * 1001, "ab" * 777, " " * 100, "=-" * 300, "thequickbrownfox" * 4000, "word " * 60_000]
    base64 = "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(100_000))
    return ["", " ", "\n", *made, *long, base64, "中文" * 20_000]


def test_equal_to_the_library(library, rounds):
    batch = odd_texts()
    ids, bounds = rounds(batch)
    data, at = rounds.decode(ids, bounds)
    for k, text in enumerate(batch):
        own = ids[bounds[k] : bounds[k + 1]].tolist()
        assert own == library.encode(text), repr(text[:80])
        assert data[at[k] : at[k + 1]].tobytes().decode() == library.decode(own)


def test_random_vocabularies(rounds, monkeypatch):
    """Vocabularies in which a merged piece may pair better than its parts did."""
    rng = random.Random(2)
    for _ in range(150):
        letters = "abc"
        pieces = list(letters) + list({"".join(rng.choice(letters) for _ in range(rng.randint(2, 5))) for _ in range(12)})
        own = merge_rounds.MergeRounds.__new__(merge_rounds.MergeRounds)
        own.size = len(pieces)
        own.rank = np.array([rng.randint(0, 8) for _ in pieces], np.int32)
        own._tables({p: k for k, p in enumerate(pieces)})
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(40)]
        symbol = np.array([pieces.index(c) for w in words for c in w])
        got, word = own.merge(symbol, np.repeat(np.arange(len(words)), [len(w) for w in words]))
        for k, w in enumerate(words):
            parts = list(w)
            while True:
                pairs = [(own.rank[pieces.index(a + b)], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in pieces]
                if not pairs:
                    break
                _, i = min(pairs)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert [pieces[s] for s in got[word == k]] == parts


def test_round_trip(spark, sf_dir, library):
    rows = [(k, t, "x", 1) for k, t in enumerate(odd_texts()[:500])]
    rows += [(None, "no id", "x", 1), (3, None, None, None), (5, "again", "y", 2), (5, "again", "y", 2)]
    odd = ready(spark).createDataFrame(rows, "doc_id bigint, text string, n_tokens string, ids int").repartition(3)
    for df in (odd, documents(spark, sf_dir).limit(200)):
        want = []
        for r in df.select("doc_id", "text").collect():
            ids = library.encode(r.text or "")
            spelled = ",".join(map(str, ids)).encode()
            want.append((r.doc_id, len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(map(tuple, merge_rounds.piece_round_trip(df, MODEL).collect()), key=key) == sorted(want, key=key)


def test_columns(spark, library):
    df = ready(spark).createDataFrame([(1, "One  two\nthree ▁ 中"), (2, None), (None, "x")], "doc_id bigint, text string")
    encoded = merge_rounds.piece_encode(df, MODEL)
    assert {(r.doc_id, tuple(r.ids)) for r in encoded.collect()} == {
        (1, tuple(library.encode("One  two\nthree ▁ 中"))), (2, ()), (None, tuple(library.encode("x"))),
    }
    decoded = merge_rounds.piece_decode(encoded, MODEL).collect()
    assert {tuple(r) for r in decoded} == {(1, "One  two\nthree   中"), (2, ""), (None, "x")}


def test_empty_table_and_other_models(spark, tmp_path):
    empty = ready(spark).createDataFrame([], "doc_id bigint, text string")
    assert merge_rounds.piece_round_trip(empty, MODEL).collect() == []
    (tmp_path / "x.model").write_bytes(b"")
    with pytest.raises(ValueError, match="BPE"):
        merge_rounds.MergeRounds(str(tmp_path / "x.model"))
