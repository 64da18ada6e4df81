"""Data checks: guards, column comparison, replication rates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: relative difference below which two columns count as equal.
EQUALITY_TOLERANCE = 1.5e-8
# Fixed value: what a failed guard says.
GUARD_MESSAGE = "step {step} requires {required} observation(s) with value >= {threshold:g}"


def min_count_check(df: DataFrame, column: str, steps: list[tuple[float, int]]) -> DataFrame:
    """Per (threshold, required) step: how many values reach the threshold, and is it enough.

    All steps share one aggregate over the data.
    """
    reached = [
        F.count_if(F.col(column) >= F.lit(threshold)).alias(f"s{i}")
        for i, (threshold, _) in enumerate(steps)
    ]
    report = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(float(threshold)).alias("threshold"),
            F.lit(required).cast("long").alias("required"),
            F.col(f"s{i}").alias("observed"),
            (F.col(f"s{i}") >= F.lit(required)).alias("passed"),
        )
        for i, (threshold, required) in enumerate(steps)
    ]
    return df.agg(*reached).select(F.inline(F.array(*report)))


def require_min_counts(df: DataFrame, column: str, steps: list[tuple[float, int]]) -> DataFrame:
    """``df``, whose execution stops with a message at the first step that has too few observations.

    The counts are one aggregate that enters the plan as a scalar; nothing runs before ``df`` does.
    """
    reached = [F.count_if(F.col(f"`{column}`") >= F.lit(threshold)) for threshold, _ in steps]
    verdict = F.lit(True)
    for i in reversed(range(len(steps))):
        threshold, required = steps[i]
        message = GUARD_MESSAGE.format(step=i + 1, required=required, threshold=threshold)
        verdict = F.when(reached[i] >= required, verdict).otherwise(F.raise_error(message))
    return df.where(df.agg(verdict.alias("enough")).scalar())


def columns_all_equal(
    df: DataFrame, left: Column, right: Column, tolerance: float = EQUALITY_TOLERANCE
) -> DataFrame:
    """Exact against tolerant equality of two columns, in one aggregate.

    Exact equality compares every row. Tolerant equality takes the mean
    difference over the differing rows, relative to the mean size of the left
    values there (absolute where those are themselves within the tolerance). A
    value missing on one side only makes the columns unequal.
    """
    pairs = df.select(left.cast("double").alias("l"), right.cast("double").alias("r"))
    differs = F.col("l") != F.col("r")
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("l").eqNullSafe(F.col("r"))).alias("n_equal"),
        F.count_if(F.col("l").isNull() != F.col("r").isNull()).alias("n_one_missing"),
        F.avg(F.when(differs, F.abs(F.col("l") - F.col("r")))).alias("difference"),
        F.avg(F.when(differs, F.abs("l"))).alias("size"),
    )
    relative = F.when(F.col("size") > tolerance, F.col("difference") / F.col("size")).otherwise(
        F.col("difference")
    )
    mean_difference = F.coalesce(relative, F.lit(0.0))
    return sums.select(
        "n_rows",
        "n_equal",
        "n_one_missing",
        mean_difference.alias("mean_difference"),
        (F.col("n_equal") == F.col("n_rows")).alias("all_identical"),
        ((mean_difference < tolerance) & (F.col("n_one_missing") == 0)).alias("all_equal"),
    )


@dataclass
class MapSide:
    """One input table of a step's map side, and the rows that the step's own operator makes of it.

    ``read`` holds the columns that the step reads, ``emitted`` what goes to the shuffle.
    """

    read: DataFrame
    emitted: DataFrame


def text_bytes(*columns: Column | str) -> Column:
    """Bytes of values as text, missing ones without any."""
    sizes = [F.coalesce(F.octet_length(_column(c).cast("string")), F.lit(0)) for c in columns]
    return reduce(lambda x, y: x + y, sizes).cast("long")


def _column(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def replication_rate(steps: list[tuple[str, list[MapSide]]]) -> DataFrame:
    """Records and bytes that go into and come out of the map side of each step.

    The operators of a step run as they do in their job and their output rows are counted, so
    the report follows what they really emit. ``rate`` is output over input records;
    ``communication`` is the bytes read plus the bytes handed to the shuffle. Counts are
    aggregates and not accumulators, so a repeated task changes nothing.
    """

    def measured(df: DataFrame, number: int, name: str, side: str) -> DataFrame:
        size = F.coalesce(F.sum(text_bytes(*df.columns)), F.lit(0))
        return df.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).select(
            F.lit(number).alias("step"), F.lit(name).alias("name"), F.lit(side).alias("side"), "*"
        )

    sides = [
        measured(df, number, name, side)
        for number, (name, listed) in enumerate(steps, start=1)
        for part in listed
        for df, side in ((part.read, "in"), (part.emitted, "out"))
    ]
    totals = (
        reduce(DataFrame.unionAll, sides)
        .groupBy("step", "name")
        .agg(
            F.sum(F.when(F.col("side") == "in", F.col("n"))).alias("records_in"),
            F.sum(F.when(F.col("side") == "out", F.col("n"))).alias("records_out"),
            F.sum("bytes").alias("communication"),
        )
    )
    rate = F.try_divide(F.col("records_out"), F.col("records_in"))
    return totals.select("step", "name", "records_in", "records_out", rate.alias("rate"), "communication")
