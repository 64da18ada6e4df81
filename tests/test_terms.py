import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import text as words
from millrace.operators import association
from millrace.operators.terms import frequency, tokenize
from millrace.plans.term_selection import select_terms, term_report


def docs(spark, *pairs):
    return spark.createDataFrame(list(pairs), "text string, category string")


@pytest.mark.parametrize(
    "raw, expected",
    [("Toys & Games", "toys-games"), ("Apps_for_Android", "apps-for-android"), ("42", "")],
)
def test_category_names(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "c string")
    assert rows(df.select(words.normalized_category(F.col("c")))) == [(expected,)]


def test_digits_separate_or_not(spark):
    df = docs(spark, ("abc123def", "c"))
    assert rows(tokenize(df, "text", keep=[])) == [("abc",), ("def",)]
    assert rows(tokenize(df, "text", words.DELIMITERS_KEEP_DIGITS, keep=[])) == [("abc123def",)]


def test_every_delimiter_separates(spark):
    between = " \t\n0123456789()[]{}.!?,;:+=-_\"'`~#@&*%€$§\\/"
    df = docs(spark, ("".join(f"a{c}" for c in between) + "a", "c"))
    assert rows(frequency(tokenize(df, "text", distinct=False, keep=[]), "term")) == [
        ("a", len(between) + 1)
    ]


def test_document_and_term_frequency(spark):
    df = docs(spark, ("Dog dog DOG!", "c"), (None, "c"))
    assert rows(frequency(tokenize(df, "text"), "term")) == [("dog", 1)]
    assert rows(frequency(tokenize(df, "text", distinct=False), "term")) == [("dog", 3)]


def test_stop_words_are_left_out_after_folding(spark):
    stop = spark.createDataFrame([("the",)], "w string")
    assert rows(tokenize(docs(spark, ("The cat", "c")), "text", stop_words=stop, keep=[])) == [("cat",)]


def test_tokenize_takes_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs(spark, ("one two two", "c")).write.json(source)
    stream = spark.readStream.schema("text string, category string").json(source)
    query = (
        tokenize(stream, "text")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(out).select("term")) == [("one",), ("two",)]


def test_chi_square_by_hand(spark):
    df = docs(spark, ("t", "c"), ("t u", "c"), ("u", "d"), ("v", "d"))
    scores = association.chi_square_scores(df, "text", "category").collect()
    got = {(r.category, r.term): tuple(r)[2:] for r in scores}
    assert got[("c", "t")] == (2, 0, 0, 2, 1.0)
    assert got[("d", "u")] == (1, 1, 1, 1, 0.0)


def test_chi_square_zero_denominator(spark):
    df = docs(spark, ("t", "c"), ("u", "c"))
    scores = association.chi_square_scores(df, "text", "category")
    assert {r.score for r in scores.collect()} == {None}
    assert association.top_terms(scores, 75).count() == 0


def test_chi_square_counts_documents_without_text_or_category(spark):
    df = docs(spark, ("t", "c"), (None, "c"), ("u", None), ("", "d"))
    scores = association.chi_square_scores(df, "text", "category").collect()
    got = {(r.category, r.term): (r.a, r.b, r.c, r.d) for r in scores}
    assert got == {("c", "t"): (1, 0, 1, 2), ("?", "u"): (1, 0, 0, 3)}


def test_a_category_with_few_terms_keeps_them_all(spark):
    df = docs(spark, ("x y z", "c"), ("q", "d"))
    top = select_terms(df, "text", "category")
    assert rows(top.where("category = 'c'").select("rank", "term")) == [(1, "x"), (2, "y"), (3, "z")]


def test_term_lines_by_rank_and_by_name(spark):
    top = spark.createDataFrame(
        [("c", 1, "z", 0.5), ("c", 2, "a", 0.25)], "category string, rank int, term string, score double"
    )
    assert rows(association.term_lines(top)) == [("c", "z:0.5000000000 a:0.2500000000")]
    assert rows(association.term_lines(top, "term")) == [("c", "a:0.2500000000 z:0.5000000000")]


def test_report_from_files_to_files(spark, tmp_path):
    reviews, stop, out = (str(tmp_path / n) for n in ("r.json", "stop.txt", "out"))
    with open(reviews, "w") as f:
        f.write('{"reviewText":"Ball the ball","category":"Toys & Games"}\n')
        f.write('{"reviewText":"the book","category":"Books"}\n{broken\n')
    with open(stop, "w") as f:
        f.write("the\n")
    term_report(spark, reviews, stop, out)
    assert rows(spark.read.text(out)) == [
        ("books\tbook:1.0000000000",),
        ("toys-games\tball:1.0000000000",),
    ]
