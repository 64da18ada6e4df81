"""Exact quantiles per group without gathering a group in one task.

A quantile sketch says roughly where the wanted ranks lie; the exact answer comes from
counting, in the same way for groups of any size:

1. One partial aggregate gives each group's size and sketch. The sketch cuts the values into
   narrow brackets around the wanted ranks and the gaps between them.
2. One partial aggregate counts the rows of every such part and takes a sketch of each, which
   cuts a part into cells of about equal numbers of rows.
3. Exact counts say which parts hold the wanted ranks, brackets as a rule. Only their rows are
   counted per distinct value, and ranks are summed up cell by cell.

The sketches decide how much is counted in detail, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import is_finite
from millrace.session import staged

SKETCH_ACCURACY = 2000
# Cells of a part: a cell has this share of its rows, heavy single values aside.
CELLS = 256


def finite_values(df: DataFrame, group: str, value: str) -> DataFrame:
    """(grp, v) rows with a finite number in ``v``."""
    rows = df.select(F.col(group).alias("grp"), F.col(value).cast("double").alias("v"))
    return rows.where(is_finite(F.col("v")))


def group_sketch(rows: DataFrame, probs: list[float], extra: list[Column] | None = None) -> DataFrame:
    """Per group: size, extremes, bracket ends around each quantile, extra aggregates."""
    slack = 2.5 / SKETCH_ACCURACY
    ends = [min(1.0, max(0.0, p + side)) for p in sorted(probs) for side in (-slack, slack)]
    sketch = rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.percentile_approx("v", ends, SKETCH_ACCURACY).alias("ends"),
        *(extra or []),
    )
    return staged(sketch, "sketch")


def exact_quantiles(rows: DataFrame, sketch: DataFrame, probs: list[float]) -> DataFrame:
    """(grp, q0, q1, ...): linearly interpolated quantiles, in ascending order of ``probs``.

    ``rows`` comes from :func:`finite_values`, ``sketch`` from :func:`group_sketch`.
    """
    probs = sorted(probs)
    wanted = _wanted_parts(rows, sketch, probs)
    cells = staged(_count_cells(rows, sketch, wanted, len(probs)), "cells")
    picked = _pick_ranks(cells, probs)
    between = [
        f"lo{i} + ({_rank(p)} - floor({_rank(p)})) * (hi{i} - lo{i}) AS q{i}"
        for i, p in enumerate(probs)
    ]
    return staged(picked.selectExpr("grp", *between), "quantiles")


def _rank(p: float) -> str:
    """Zero-based fractional position of the quantile in its sorted group."""
    return f"((n - 1) * double({p!r}))"


def _parts(rows: DataFrame, sketch: DataFrame, brackets: int) -> DataFrame:
    """(grp, v, n, part): odd parts are brackets, even ones the gaps around them."""
    part = "".join(
        f"WHEN v < ends[{2 * b}] THEN {2 * b} WHEN v <= ends[{2 * b + 1}] THEN {2 * b + 1} "
        for b in range(brackets)
    )
    return rows.join(sketch.selectExpr("grp AS g", "n", "ends"), F.expr("grp <=> g")).selectExpr(
        "grp", "v", "n", f"CASE {part} ELSE {2 * brackets} END AS part"
    )


def _wanted_parts(rows: DataFrame, sketch: DataFrame, probs: list[float]) -> DataFrame:
    """(g, p, before, edges) of the parts that hold a wanted rank.

    ``before`` is the number of smaller rows of the group, ``edges`` are where cells end. A
    group has a handful of parts, so the running count is a small window.
    """
    shares = [k / CELLS for k in range(1, CELLS)]
    counted = (
        _parts(rows, sketch, len(probs))
        .groupBy("grp", "part")
        .agg(
            F.first("n").alias("n"),
            F.count(F.lit(1)).alias("n_part"),
            F.percentile_approx("v", shares, SKETCH_ACCURACY).alias("edges"),
        )
    )
    up_to = F.sum("n_part").over(Window.partitionBy("grp").orderBy("part"))
    placed = counted.withColumn("before", up_to - F.col("n_part"))
    holds = " OR ".join(
        f"{side}({_rank(p)}) BETWEEN before AND before + n_part - 1"
        for p in probs
        for side in ("floor", "ceil")
    )
    return placed.where(holds).selectExpr(
        "grp AS g", "part AS p", "before", "array_distinct(edges) AS edges"
    )


def _count_cells(rows: DataFrame, sketch: DataFrame, wanted: DataFrame, brackets: int) -> DataFrame:
    """Row counts per (grp, n, part, before, cell, v) in the wanted parts."""
    return (
        _parts(rows, sketch, brackets)
        .join(wanted, F.expr("grp <=> g AND part = p"))
        .withColumn("cell", F.size(F.filter("edges", lambda e: e < F.col("v"))))
        .groupBy("grp", "n", "part", "before", "cell", "v")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _pick_ranks(cells: DataFrame, probs: list[float]) -> DataFrame:
    """(grp, n, lo0, hi0, lo1, ...): values at the two ranks around each quantile."""
    up_to_cell = F.sum("n_cell").over(Window.partitionBy("grp", "part").orderBy("cell"))
    offsets = (
        cells.groupBy("grp", "part", "cell")
        .agg(F.sum("n_rows").alias("n_cell"))
        .withColumn("up_to_cell", up_to_cell)
        .selectExpr("grp AS g", "part AS p", "cell AS c", "up_to_cell - n_cell AS in_part")
    )
    up_to_value = F.sum("n_rows").over(Window.partitionBy("grp", "part", "cell").orderBy("v"))
    ranked = (
        cells.withColumn("up_to_value", up_to_value)
        .join(offsets, F.expr("grp <=> g AND part = p AND cell = c"))
        .selectExpr(
            "grp",
            "n",
            "v",
            "before + in_part + up_to_value - n_rows AS first",
            "before + in_part + up_to_value - 1 AS last",
        )
    )
    picks = [
        F.expr(f"max(if({side}({_rank(p)}) BETWEEN first AND last, v, NULL)) AS {name}{i}")
        for i, p in enumerate(probs)
        for name, side in (("lo", "floor"), ("hi", "ceil"))
    ]
    return ranked.groupBy("grp").agg(F.max("n").alias("n"), *picks)
