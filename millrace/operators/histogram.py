"""Histograms per group whose cells are cut until ranks and fences fall between them.

Quartiles, whiskers and outliers of a boxplot come from three reads of the values:

1. A sketch per group says about where the quartiles lie, and so about where the fences do.
   Its values cut the group into parts: narrow brackets, the gaps between them, and each cut
   value by itself.
2. One partial aggregate counts every part, with its extremes. Exact counts say which parts
   hold a wanted rank; their extremes bound the fences.
3. Only parts that hold a rank, or that a fence may cut, are read again and counted per value.

A part that is not read again lies wholly on one side of each fence, so its count and
extremes are all that is needed. The sketch decides how much is read again, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import quantiles
from millrace.session import staged

# Two cuts around each of three quartiles and two fences.
CUTS = 10
# Room for the rounding of an interpolated quartile, relative to the quartiles.
_ROUNDING = 1e-12


def _fence_bounds(q1: tuple[Column, Column], q3: tuple[Column, Column], reach: float) -> list[Column]:
    """Least and greatest lower fence, least and greatest upper fence, for quartiles in these bounds."""
    widest = reach * (q3[1] - q1[0])
    narrowest = reach * F.greatest(q3[0] - q1[1], F.lit(0.0))
    room = _ROUNDING * (F.abs(q1[0]) + F.abs(q1[1]) + F.abs(q3[0]) + F.abs(q3[1]))
    return [q1[0] - widest - room, q1[1] - narrowest + room, q3[0] + narrowest - room, q3[1] + widest + room]


def _part(value: Column) -> Column:
    """Even numbers are the gaps between the ``cuts``, odd ones the cuts themselves."""
    part = F.when(value < F.get("cuts", F.lit(0)), 0)
    for i in range(CUTS):
        cut = F.get("cuts", F.lit(i))
        part = part.when(value < cut, 2 * i).when(value == cut, 2 * i + 1)
    return part.otherwise(2 * CUTS)


def group_parts(rows: DataFrame, sketch: DataFrame, probs: list[float], reach: float) -> DataFrame:
    """(g, n, cuts, part, n_part, least, greatest, before, edges, again, outside), some parts a group.

    ``rows`` and ``sketch`` are those of :func:`quantiles.finite_values` and
    :func:`quantiles.group_sketch` for three quartiles. ``before`` is the number of smaller
    rows of the group; ``again`` says that a rank or a fence may fall inside the part,
    ``outside`` that it may hold outliers.
    """
    end = lambda i: F.get("ends", F.lit(i))
    fences = _fence_bounds((end(0), end(1)), (end(4), end(5)), reach)
    cuts = F.array_sort(F.concat("ends", F.array(*fences)))
    groups = sketch.select(F.col("grp").alias("g"), "n", cuts.alias("cuts"))
    shares = [k / quantiles.CELLS for k in range(1, quantiles.CELLS)]
    counted = (
        rows.join(groups, F.expr("grp <=> g"))
        .groupBy("g", _part(F.col("v")).alias("part"))
        .agg(
            F.first("n").alias("n"),
            F.first("cuts").alias("cuts"),
            F.count(F.lit(1)).alias("n_part"),
            F.min("v").alias("least"),
            F.max("v").alias("greatest"),
            F.percentile_approx("v", shares, quantiles.SKETCH_ACCURACY).alias("edges"),
        )
    )
    placed = counted.withColumn(
        "before", F.sum("n_part").over(Window.partitionBy("g").orderBy("part")) - F.col("n_part")
    )
    group = Window.partitionBy("g")
    holds = [
        F.expr(" OR ".join(f"{s}({quantiles._rank(p)}) BETWEEN before AND before + n_part - 1" for s in ("floor", "ceil")))
        for p in probs
    ]
    bounds = [
        (F.min(F.when(h, F.col("least"))).over(group), F.max(F.when(h, F.col("greatest"))).over(group))
        for h in (holds[0], holds[2])
    ]
    low, low_end, high, high_end = _fence_bounds(*bounds, reach)
    cut = ((F.col("greatest") >= low) & (F.col("least") <= low_end)) | (
        (F.col("greatest") >= high) & (F.col("least") <= high_end)
    )
    several = F.col("least") < F.col("greatest")
    parts = placed.select(
        "*",
        (several & (holds[0] | holds[1] | holds[2] | cut)).alias("again"),
        ((F.col("least") <= low_end) | (F.col("greatest") >= high)).alias("outside"),
    )
    return staged(parts.withColumn("edges", F.expr("if(again, array_distinct(edges), NULL)")), "parts")


def in_parts(df: DataFrame, group: Column, value: Column, parts: DataFrame) -> DataFrame:
    """The rows of ``df`` in ``parts``, with the columns of ``parts``; one row per group and part meets them."""
    cuts = parts.groupBy("g").agg(F.first("cuts").alias("cuts")).select(F.col("g").alias("_cut_group"), "cuts")
    meets = (F.col("_cut_group").eqNullSafe(F.col("g"))) & (F.col("_part") == F.col("part"))
    return (
        df.join(cuts, group.eqNullSafe(F.col("_cut_group")))
        .withColumn("_part", _part(value))
        .drop("cuts")
        .join(parts, meets)
    )


def count_again(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(grp, n, part, before, cell, v, n_rows): rows of the parts that are read again, per value.

    ``rows`` are (v, columns of ``parts``) of such parts. Parts of a single value follow as they are.
    """
    columns = ["grp", "n", "part", "before", "cell", "v"]
    again = (
        rows.withColumn("cell", F.size(F.filter("edges", lambda e: e < F.col("v"))))
        .withColumnRenamed("g", "grp")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    single = parts.where("least = greatest").selectExpr(
        "g AS grp", "n", "part", "before", "0 AS cell", "least AS v", "n_part AS n_rows"
    )
    return staged(again.unionByName(single), "cells")


def quartiles_of(cells: DataFrame, probs: list[float]) -> DataFrame:
    """(grp, n, q0, q1, q2), linearly interpolated, from :func:`count_again`."""
    rank = quantiles._rank
    return quantiles._pick_ranks(cells, probs).selectExpr(
        "grp",
        "n",
        *[f"lo{i} + ({rank(p)} - floor({rank(p)})) * (hi{i} - lo{i}) AS q{i}" for i, p in enumerate(probs)],
    )


def pieces(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """(g, least, greatest, n_piece): every row of a group once, in pieces that no fence cuts."""
    whole = parts.where("NOT again AND least < greatest").selectExpr("g", "least", "greatest", "n_part AS n_piece")
    return whole.unionByName(cells.selectExpr("grp AS g", "v AS least", "v AS greatest", "n_rows AS n_piece"))
