"""Cutting ordered rows into ranges of about equal size, for any type that has an order.

A share of the rows, chosen by hash, is sorted by Spark in ranges of its own, and every
so many of these rows become a cut. The number of cuts follows from the number of rows alone. Cuts are
values of the order itself, so texts, binaries, decimals and structs are cut as well as numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import staged

#: Sampled rows per range; the sizes of the ranges vary by about a tenth for it.
SAMPLED = 100
#: Sampled rows that one task sorts.
TASK_ROWS = 200_000


def cut_points(df: DataFrame, keys: list[str], order: str, rows: int) -> DataFrame:
    """``(keys..., _cuts)``: ascending values of ``order``, about one for every ``rows`` rows of a key.

    Equal rows fall into one range, so keys and order together should be nearly unique.
    Keys with a few rows only have no line. No range is much above one and a half times ``rows``.
    """
    one_in = max(1, rows // SAMPLED)
    every = max(1, rows // one_in)
    names = [f"_k{i}" for i in range(len(keys))]
    chosen = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.col(f"`{order}`")), F.lit(one_in)) == 0
    sample = staged(
        df.where(chosen).select(
            *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{order}`").alias("_o")
        ),
        "sampled",
    )
    tasks = 1 + sample.count() // TASK_ROWS
    dealt = sample.repartitionByRange(tasks, *names, "_o").withColumn("_task", F.spark_partition_id())
    in_task = Window.partitionBy(*names, "_task").orderBy("_o")
    # half a range at both ends of a task, so that a range across two tasks is not twice as long
    nth = F.row_number().over(in_task) % every
    cut = dealt.withColumn("_nth", nth).where(F.col("_nth") == every // 2)
    found = cut.groupBy(*names).agg(F.array_sort(F.collect_list("_o")).alias("_cuts"))
    return staged(found.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "_cuts"), "cuts")


def range_number(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are not above ``value``; 0 without cuts or without a value.

    A binary search, as a fold over the bits of the answer.
    """
    bits = F.ceil(F.log2(F.size(cuts) + 1)).cast("int")

    def step(found: Column, bit: Column) -> Column:
        upto = found + F.call_function("shiftleft", F.lit(1), bit)
        return F.when(F.get(cuts, upto - 1) <= value, upto).otherwise(found)

    searched = F.aggregate(F.sequence(bits - 1, F.lit(0), F.lit(-1)), F.lit(0), step)
    return F.when(F.size(cuts) > 0, searched).otherwise(F.lit(0))
