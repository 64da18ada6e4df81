"""Tokenising and case folding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate tokens, as regular expressions.
# The first set also splits at digits, the second keeps digits inside tokens.
# White space always separates, line breaks included.
DELIMITERS = r"""[\s0-9()\[\]{}.!?,;:+=\-_"'`~#@&*%€$§\\/]+"""
DELIMITERS_KEEP_DIGITS = r"""[\s()\[\]{}.!?,;:+=\-_"'`~#@&*%€$§\\/]+"""

# Fixed value: the category of a document that names none.
UNKNOWN_CATEGORY = "?"


def tokens(text: Column, delimiters: str = DELIMITERS) -> Column:
    """Lower-case tokens of ``text``, empty ones dropped; NULL stays NULL."""
    return F.array_remove(F.split(F.lower(text), delimiters), "")


def distinct_tokens(text: Column, delimiters: str = DELIMITERS) -> Column:
    """Each token of ``text`` once."""
    return F.array_distinct(tokens(text, delimiters))


def normalized_category(category: Column, delimiters: str = DELIMITERS) -> Column:
    """``Toys & Games`` becomes ``toys-games``."""
    return F.array_join(tokens(category, delimiters), "-")


def category_or_unknown(category: Column) -> Column:
    return F.coalesce(category, F.lit(UNKNOWN_CATEGORY))


def term_score_text(term: Column, score: Column, digits: int = 10) -> Column:
    """``term:score`` with a fixed number of decimals."""
    return F.concat(term, F.lit(":"), F.format_string(f"%.{digits}f", score))
