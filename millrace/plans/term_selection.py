"""Chi-square term selection from files to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as words
from millrace.operators.association import chi_square_scores, term_lines, top_terms
from millrace.sinks.writers import write_text_lines
from millrace.sources.readers import read_json_docs, read_wordlist

# How many terms a category keeps, in the two forms of the report.
TERMS_BY_NAME = 75
TERMS_BY_SCORE = 150


def select_terms(
    docs: DataFrame,
    text: str,
    category: str,
    stop_words: DataFrame | None = None,
    k: int = TERMS_BY_NAME,
    delimiters: str = words.DELIMITERS,
    normalize: bool = False,
) -> DataFrame:
    """The ``k`` most telling terms of each category."""
    return top_terms(chi_square_scores(docs, text, category, stop_words, delimiters, normalize), k)


def term_report(
    spark: SparkSession,
    reviews_path: str,
    stop_words_path: str,
    out_path: str,
    k: int = TERMS_BY_NAME,
    by: str = "term",
    mode: str = "overwrite",
) -> None:
    """Read JSON reviews and a stop-word list, write one line of terms per category."""
    top = select_terms(
        read_json_docs(spark, reviews_path),
        "reviewText",
        "category",
        read_wordlist(spark, stop_words_path),
        k,
        normalize=True,
    )
    lines = term_lines(top, by).select(F.concat_ws("\t", "category", "terms").alias("line"))
    write_text_lines(lines, out_path, mode)
