"""Counts: global, per group, shares and duplicate keys.

All of them are partial-then-final aggregates, so a group that holds a large
part of the table is reduced inside each map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """One row: how many rows meet the condition."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))


def group_count(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per group; a NULL key is a group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def having_duplicates(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return group_count(df, *keys, name=name).where(F.col(name) > 1)


def bar_counts(df: DataFrame, x: str, fill: str) -> DataFrame:
    """Bar heights: rows per group and label."""
    return group_count(df, x, fill)


def bar_shares(df: DataFrame, x: str, fill: str) -> DataFrame:
    """Filled bars: the share of each label within its group."""
    counts = bar_counts(df, x, fill)
    total = F.sum("n").over(Window.partitionBy(x))
    return counts.select(x, fill, "n", (F.col("n") / total).alias("share"))


def group_mean_sorted(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """Mean per two-level group, missing values skipped, ordered by the mean.

    ``place`` is the position of the inner group within its outer group.
    """
    means = df.groupBy(outer, inner).agg(
        F.avg(value).alias("mean"), F.count(value).alias("n_values")
    )
    order = [F.asc_nulls_last("mean"), F.asc(inner)]
    place = F.row_number().over(Window.partitionBy(outer).orderBy(*order))
    return means.withColumn("place", place).orderBy(*order)


def bubble_table(
    df: DataFrame, label: str, x: str, y: str, group: str, size: str
) -> DataFrame:
    """What a bubble chart draws: rows with a missing coordinate or size are left out."""
    picked = df.select(
        F.col(label).alias("label"),
        F.col(x).alias("x"),
        F.col(y).alias("y"),
        F.col(group).alias("group"),
        F.col(size).alias("size"),
    )
    return picked.dropna(subset=["x", "y", "size"])
