"""Ratios of consecutive values in ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranges import cut_points, range_number
from millrace.session import staged

# Rows that a chunk of a series should have.
CHUNK_ROWS = 100_000


def consecutive_ratio(
    df: DataFrame, key: str, order: str, value: str, chunk: Column | None = None
) -> DataFrame:
    """``next value / value`` along each series; NULL at its end.

    ``order`` must be unique within a series. Series are cut into chunks: each chunk
    is a window group of its own, and its last row takes the successor from the next
    chunk's first row, out of a table with one row per chunk.

    ``chunk`` gives the cut as an expression that never decreases along ``order``
    (a day, a month). Without it, a series is cut at sampled values of its order, whatever
    type that has, one for every ``CHUNK_ROWS`` rows. A missing order comes first.
    """
    if chunk is None:
        df, columns = cut_series(df, key, order), df.columns
    else:
        df, columns = df.withColumn("_chunk", chunk), df.columns
    return _by_chunk(df, columns, key, order, value)


def cut_series(df: DataFrame, key: str, order: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``_chunk``, the piece of its series that a row belongs to, about ``rows`` rows each."""
    cuts = cut_points(df, [key], order, rows).withColumnRenamed(key, "_cut_key")
    placed = df.join(cuts, F.col(f"`{key}`").eqNullSafe(F.col("_cut_key")), "left")
    number = range_number(F.col("_cuts"), F.col(f"`{order}`"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], number.alias("_chunk"))


def _by_chunk(
    cut: DataFrame, columns: list[str], key: str, order: str, value: str
) -> DataFrame:
    """The ratio where ``_chunk`` says which piece of its series a row belongs to."""
    first = F.min(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    firsts = cut.groupBy(key, "_chunk").agg(first.getField("v").alias("_first"))
    upcoming = F.lead("_first").over(Window.partitionBy(key).orderBy("_chunk"))
    chunks = staged(
        firsts.select(
            F.col(key).alias("_key"), F.col("_chunk").alias("_part"), upcoming.alias("_upcoming")
        ),
        "chunks",
    )
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(order)
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_chunk").eqNullSafe(F.col("_part"))
    is_last = F.lead(F.lit(True)).over(in_chunk).isNull()
    return (
        cut.withColumn("_last", is_last)
        .withColumn("_next", F.lead(value).over(in_chunk))
        .join(chunks, same, "left")
        .withColumn("_next", F.when(F.col("_last"), F.col("_upcoming")).otherwise(F.col("_next")))
        .withColumn("ratio", F.try_divide(F.col("_next"), F.col(value)))
        .select(*columns, "ratio")
    )
