"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import number_above


def member_of(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def filter_guarded_numeric(
    df: DataFrame, column: str, bound: int | float, number_type: str = "int"
) -> DataFrame:
    """Rows whose text column holds a number above ``bound``."""
    return df.where(number_above(F.col(column), bound, number_type))


def filter_complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which none of the columns is missing."""
    return df.dropna(subset=columns)
