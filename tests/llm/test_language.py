"""Language profiles: bundles by definition, held-out accuracy, odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from millrace.llm import language
from millrace.llm.runtime import documents, ready


def bundle_by_hand(text: str, size: int) -> np.ndarray:
    letters = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    squeezed = [c for k, c in enumerate(letters) if c or not k or letters[k - 1]]
    padded = [0, 0, *squeezed, 0, 0]
    total = np.zeros(size)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        one, two, three = (language.letter_vector(x, size) for x in (a, b, c))
        total += np.roll(one, 2) * np.roll(two, 1) * three
    return total


def test_bundles_by_definition(monkeypatch):
    batch = ["Der einé, 12 Baum!", "", "...", "中文 text", "ab" * 40, "ЖЖ x"]
    want = [bundle_by_hand(t, 128) if any(c.isalpha() for c in t) else np.zeros(128) for t in batch]
    got, lettered = language.bundles(batch, language.Alphabet(128))
    assert (got == np.array(want)).all()
    assert lettered.tolist() == [True, False, False, True, True, True]


def test_vectors_are_nearly_orthogonal():
    vectors = np.array([language.letter_vector(c) for c in range(97, 123)], float)
    dots = vectors @ vectors.T / language.SIZE
    assert np.abs(dots - np.eye(26)).max() < 0.2


def test_held_out_accuracy(spark, sf_dir):
    docs = documents(ready(spark), sf_dir)
    profiles = language.fit_profiles(docs)
    rows = {r.doc_id: r for r in language.identify(docs, profiles).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert rows.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    unseen = [d for d, r in rows.items() if r.held_out]
    assert sum(rows[d].lang_pred == truth[d] for d in unseen) >= 0.98 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_profiles_do_not_depend_on_partitions(spark, sf_dir):
    docs = documents(ready(spark), sf_dir).limit(200)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    one, other = (language.fit_profiles(docs.repartition(n)) for n in (1, 5))
    assert one.languages == other.languages and (one.vectors == other.vectors).all()


def test_sample_is_bounded_per_language(spark):
    ready(spark)
    rows = [(k, "wort haus baum", "de") for k in range(3000)] + [(k, "mot arbre", "fr") for k in range(5000, 5010)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    profiles = language.fit_profiles(docs, sample=100)
    assert profiles.languages == ["de", "fr"]
    norms = np.linalg.norm(profiles.vectors, axis=1) / [
        np.linalg.norm(bundle_by_hand(t, language.SIZE)) for t in ("wort haus baum", "mot arbre")
    ]
    assert 50 < norms[0] < 170 and 1 <= norms[1] <= 10


def test_odd_input(spark):
    ready(spark)
    rows = [(0, "der baum und das haus", "de", "a"), (3, "l'arbre et la maison", "fr", "b"), (4, None, "fr", "c"),
            (None, "der", "de", "d"), (6, "123 !!", None, "e"), (7, "", "de", "f"), (8, "haus " * 200_000, None, "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    profiles = language.fit_profiles(docs)
    got = {r.doc_id: r for r in language.identify(docs, profiles).collect()}
    assert len(got) == 7 and got[4].lang_pred == got[6].lang_pred == got[7].lang_pred == "und"
    assert got[4].score == 0 and got[8].lang_pred == "de" and got[None].held_out is False
    assert language.keep_identified(docs, profiles).columns == docs.columns
    assert {r.doc_id for r in language.keep_identified(docs, profiles).collect()} == {0, 3, None, 8}


def test_nothing_to_learn(spark):
    ready(spark)
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    profiles = language.fit_profiles(empty)
    assert language.identify(empty, profiles).collect() == []
    one = spark.createDataFrame([(1, "text")], "doc_id bigint, text string")
    assert language.identify(one, profiles).first().lang_pred == "und"


POLISH = (
    "Litwo! Ojczyzno moja! ty jesteś jak zdrowie. Ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. "
    "Dziś piękność twą w całej ozdobie widzę i opisuję, bo tęsknię po tobie. Panno Święta, co Jasnej bronisz "
    "Częstochowy i w Ostrej świecisz Bramie! Ty, co gród zamkowy nowogródzki ochraniasz z jego wiernym ludem! "
)
FINNISH = (
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
    "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. "
)
RUSSIAN = (
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и "
    "должны поступать в отношении друг друга в духе братства. "
)


def test_other_languages_go_and_short_texts_stay(spark):
    """Texts in no learned language go, gibberish too; every text of the table stays, and so do its first words."""
    docs = documents(ready(spark), "/root/testdata/sf0.01")
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    strange = [t * k for t in (POLISH, FINNISH, RUSSIAN) for k in (1, 3, 10)]
    strange += ["".join(rng.choice(letters, n)) for n in (150, 300, 1000, 5000) for _ in range(10)]
    own = docs.collect()
    short = [" ".join(r.text.split()[:n]) for r in own[:100] for n in (8, 20)]
    # held out or without a language, so that nothing is learned from them
    rows = [(-k - 1, t, None, "planted", len(t)) for k, t in enumerate(strange)]
    rows += [(1_000_000 + k, t, None, "short", len(t)) for k, t in enumerate(short)]
    every = docs.unionAll(spark.createDataFrame(rows, docs.schema))
    kept = language.keep_identified(every, language.fit_profiles(every)).collect()
    assert [r.text for r in kept if r.doc_id < 0] == []
    assert sum(r.doc_id < 1_000_000 for r in kept) == len(own)
    profiles = language.fit_profiles(docs)
    lettered = [t for t, s in zip(short, profiles.predict(short)[1]) if s > 0]
    assert sum(r.source == "short" for r in kept) >= 0.98 * len(lettered)


def test_least_scores(spark):
    docs = documents(ready(spark), "/root/testdata/sf0.01")
    profiles = language.fit_profiles(docs)
    one, other = (language.least_scores(docs.repartition(n), profiles) for n in (1, 5))
    assert (one == other).all() and one.min() >= 0 and one[:, 10].min() > 0.2
    assert language.size_class(np.array([0, 1, 2, 3, 4, 1023, 1024])).tolist() == [0, 1, 2, 2, 3, 10, 11]


def test_scripts_with_many_letters_take_little_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    batch = ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 300))) for _ in range(1000)]
    alphabet = language.Alphabet()
    tracemalloc.start()
    sums, distinct = language.measured(batch, alphabet)
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    for k in (0, 501, 999):
        alone, n = language.measured([batch[k]], alphabet)  # a single text goes the dense way
        assert (alone[0] == sums[k]).all() and n[0] == distinct[k]


def test_sparse_and_dense_sums_agree(monkeypatch):
    rng = np.random.default_rng(4)
    batch = ["".join(rng.choice(list("abc é中文d "), 200)) for _ in range(50)] + ["", "1 2", "x"]
    dense = language.measured(batch, language.Alphabet())
    monkeypatch.setattr(language, "DENSE_GRAMS", 0)
    monkeypatch.setattr(language, "SPARSE_GRAMS", 7)
    sparse = language.measured(batch, language.Alphabet())
    assert (dense[0] == sparse[0]).all() and (dense[1] == sparse[1]).all()
