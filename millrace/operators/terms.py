"""Term counts over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as words
from millrace.operators.counting import group_count


def tokenize(
    df: DataFrame,
    text: str,
    delimiters: str = words.DELIMITERS,
    stop_words: DataFrame | None = None,
    distinct: bool = True,
    keep: list[str] | None = None,
    term: str = "term",
) -> DataFrame:
    """One row per term of a text, with the columns named in ``keep``.

    Tokens are split at ``delimiters`` and lower-cased. ``distinct`` keeps each
    term once per row, which is settled inside the row, without a shuffle. Terms
    listed in ``stop_words`` (its first column) are left out.
    """
    split = words.distinct_tokens if distinct else words.tokens
    columns = df.columns if keep is None else keep
    exploded = df.select(*columns, F.explode(split(F.col(text), delimiters)).alias(term))
    return exploded if stop_words is None else without_terms(exploded, stop_words, term)


def without_terms(df: DataFrame, stop_words: DataFrame, term: str = "term") -> DataFrame:
    """Rows whose term is not listed. A list of known, small size is broadcast."""
    listed = stop_words.select(F.col(stop_words.columns[0]).alias(term))
    return df.join(listed, term, "left_anti").select(*df.columns)


def frequency(terms: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key: document frequency over distinct terms, occurrences otherwise."""
    return group_count(terms, *keys, name=name)
