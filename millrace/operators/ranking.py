"""Most frequent values and top-k rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_by_count(df: DataFrame, group: str, value: str) -> DataFrame:
    """The most frequent value of each group; the smaller value wins a tie.

    Counts are reduced to one candidate per group and map task, no sort needed.
    """
    counts = df.groupBy(group, value).agg(F.count(value).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col(value).alias(value)))
    return (
        counts.groupBy(group)
        .agg(best.alias("best"))
        .select(group, F.col("best").getField(value).alias(value), (-F.col("best.neg")).alias("n"))
    )


def first_by_name(df: DataFrame, group: str, value: str) -> DataFrame:
    """The first value of each group in ascending order, NULL first; counts play no part."""
    first = F.min(F.struct(F.col(value).alias(value)))
    return (
        df.groupBy(group)
        .agg(first.alias("first"))
        .select(group, F.col("first").getField(value).alias(value))
    )


def top_k_per_group(
    df: DataFrame, group: str | list[str], order: list[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark keeps at most ``k`` rows per group and task ahead of the shuffle, so a
    large group does not travel to one task.
    """
    keys = [group] if isinstance(group, str) else group
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= k)


def unpivot_values(df: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """Long form: one (group, field, value) row per listed column."""
    texts = df.select(group, *[F.col(f).cast("string").alias(f) for f in fields])
    return texts.unpivot([group], fields, "field", "value")


def leading_values(long: DataFrame, group: str) -> DataFrame:
    """The two most frequent values per group and field, with ``n`` and ``place``."""
    counts = long.groupBy(group, "field", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    return top_k_per_group(counts, [group, "field"], order, 2, rank="place")


def modes_per_group(
    df: DataFrame,
    group: str,
    product: str,
    section: str,
    department: str,
    single_fallback: bool = True,
    skip_blank: bool = False,
) -> DataFrame:
    """Per group: most frequent product, second most frequent section, most frequent department.

    Ties go to the smaller name. A group with a single section reports that
    section, or NULL with ``single_fallback=False``. Empty values count like
    others unless ``skip_blank`` is set.
    """
    long = unpivot_values(df, group, [product, section, department])
    if skip_blank:
        long = long.where(F.trim("value") != "")
    leaders = leading_values(long, group)

    def place(field: str, position: int) -> Column:
        hit = (F.col("field") == field) & (F.col("place") == position)
        return F.max(F.when(hit, F.col("value")))

    second = place(section, 2)
    return leaders.groupBy(group).agg(
        place(product, 1).alias(product),
        (F.coalesce(second, place(section, 1)) if single_fallback else second).alias(section),
        place(department, 1).alias(department),
    )
