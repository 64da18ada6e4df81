"""Chi-square association of terms with categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as words
from millrace.operators.ranking import top_k_per_group
from millrace.operators.terms import frequency, tokenize, without_terms
from millrace.session import staged

SCORE_DIGITS = 10


def chi_square_scores(
    docs: DataFrame,
    text: str,
    category: str,
    stop_words: DataFrame | None = None,
    delimiters: str = words.DELIMITERS,
    normalize: bool = False,
) -> DataFrame:
    """Every (category, term) pair with its contingency table and score.

    Of the documents, ``a`` are in the category with the term, ``b`` outside with
    it, ``c`` in the category without it and ``d`` outside without it. The score
    is ``(ad - bc)^2 / ((a+b)(a+c)(b+d)(c+d))``, NULL where a factor is zero. A
    document without text counts as a document, one without category belongs to
    ``?``, also with ``normalize``; a name of delimiters only is normalized to an
    empty one.

    Terms are counted once per pair. A term's total is the sum over its pairs, so
    the documents are read once for terms; a second scan reads the category
    column only. The category table is written out first, which lets the planner
    see how small it is. Stop words leave after the count, so even a long list
    never makes single tokens travel.
    """
    label = F.col(category)
    if normalize:
        label = words.normalized_category(label, delimiters)
    label = words.category_or_unknown(label)  # "?" is a delimiter, so it comes last
    labelled = docs.select(label.alias("category"), F.col(text).alias("text"))

    in_category = staged(frequency(labelled, "category", name="docs_category"), "categories")
    documents = in_category.agg(F.sum("docs_category").alias("n")).scalar()

    terms = tokenize(labelled, "text", delimiters, keep=["category"])
    pairs = frequency(terms, "category", "term", name="docs_pair")
    if stop_words is not None:
        pairs = without_terms(pairs, stop_words)
    docs_term = F.sum("docs_pair").over(Window.partitionBy("term"))
    counts = (
        pairs.withColumn("docs_term", docs_term)
        .join(in_category, "category")
        .select(
            "category",
            "term",
            F.col("docs_pair").alias("a"),
            (F.col("docs_term") - F.col("docs_pair")).alias("b"),
            (F.col("docs_category") - F.col("docs_pair")).alias("c"),
            (documents - F.col("docs_category") - F.col("docs_term") + F.col("docs_pair")).alias("d"),
        )
    )
    return counts.withColumn("score", F.round(_score(), SCORE_DIGITS))


def _score():
    """Doubles divided factor by factor: the product of four sums outgrows integers."""
    a, b, c, d = (F.col(name).cast("double") for name in "abcd")
    difference = a * d - b * c
    score = difference * difference
    for factor in (a + b, a + c, b + d, c + d):
        score = F.try_divide(score, factor)
    return score


def top_terms(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best terms of each category; ties go to the smaller term."""
    ranked = scores.where(F.col("score").isNotNull())
    order = [F.desc("score"), F.asc("term")]
    return top_k_per_group(ranked, "category", order, k).select("category", "rank", "term", "score")


def term_lines(top: DataFrame, by: str = "rank") -> DataFrame:
    """One line per category: ``term:score`` joined by blanks, by rank or by term."""
    if by not in ("rank", "term"):
        raise ValueError("by is 'rank' or 'term'")
    entry = F.struct(
        F.col(by).alias("position"),
        words.term_score_text(F.col("term"), F.col("score"), SCORE_DIGITS).alias("text"),
    )
    entries = F.array_sort(F.collect_list(entry))
    return top.groupBy("category").agg(
        F.array_join(entries.getField("text"), " ").alias("terms")
    )
