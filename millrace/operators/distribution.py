"""Boxplot summaries and kernel densities per group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import is_finite
from millrace.operators import histogram
from millrace.operators.quantiles import exact_quantiles, finite_values, group_sketch
from millrace.session import staged

QUARTILES = [0.25, 0.5, 0.75]
# How far a whisker may reach, in quartile ranges, the number of points of a
# density curve, and how far its grid goes beyond the range, in bandwidths.
WHISKER_REACH = 1.5
DENSITY_POINTS = 512
GRID_MARGIN = 4


def _parts(df: DataFrame, group: str, value: str) -> DataFrame:
    rows = finite_values(df, group, value)
    return histogram.group_parts(rows, group_sketch(rows, QUARTILES), QUARTILES, WHISKER_REACH)


def _fences(cells: DataFrame) -> DataFrame:
    """(grp, n, q1, median, q3, low_fence, high_fence), one row per group."""
    reach = WHISKER_REACH * (F.col("q2") - F.col("q0"))
    fences = histogram.quartiles_of(cells, QUARTILES).select(
        "grp",
        "n",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        (F.col("q0") - reach).alias("low_fence"),
        (F.col("q2") + reach).alias("high_fence"),
    )
    return staged(fences, "fences")


def boxplot_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers (extreme values within the fences) and outlier count per group.

    Three reads of the values; whiskers and counts come from the histogram of the last two.
    """
    parts = _parts(df, group, value)
    rows = histogram.in_parts(finite_values(df, group, value), F.col("grp"), F.col("v"), parts.where("again"))
    cells = histogram.count_again(rows.drop("grp"), parts)
    fences = _fences(cells)
    inside = (F.col("least") >= F.col("low_fence")) & (F.col("greatest") <= F.col("high_fence"))
    bounds = fences.select("grp", "low_fence", "high_fence")
    whiskers = (
        histogram.pieces(cells, parts)
        .join(bounds, F.col("grp").eqNullSafe(F.col("g")))
        .groupBy("g")
        .agg(
            F.min(F.when(inside, F.col("least"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("greatest"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n_piece"))).alias("outliers"),
        )
    )
    return fences.join(whiskers, F.col("grp").eqNullSafe(F.col("g"))).select(
        F.col("grp").alias(group),
        "n",
        "q1",
        "median",
        "q3",
        "whisker_low",
        "whisker_high",
        "outliers",
    )


def boxplot_outliers(df: DataFrame, group: str, value: str) -> DataFrame:
    """The rows whose value lies beyond the whiskers of its group.

    Three reads of the values: the last one writes the rows that may be outliers, and those
    among which a quartile lies, to the scratch folder; both results come from there.
    """
    parts = _parts(df, group, value)
    named = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{group}`").alias("grp"),
        F.col(f"`{value}`").cast("double").alias("v"),
    ).where(is_finite(F.col("v")))
    near = histogram.in_parts(named, F.col("grp"), F.col("v"), parts.where("again OR outside"))
    near = staged(near.drop("cuts", "grp"), "near")
    fences = _fences(histogram.count_again(near.where("again"), parts))
    outside = (F.col("v") < F.col("low_fence")) | (F.col("v") > F.col("high_fence"))
    bounds = fences.select("grp", "low_fence", "high_fence")
    return near.where("outside").join(bounds, F.col("g").eqNullSafe(F.col("grp")) & outside).select("row.*")


def grouped_density(
    df: DataFrame, group: str, value: str, points: int = DENSITY_POINTS
) -> DataFrame:
    """Gaussian kernel density per group, at ``points`` places over the range of the whole column.

    The bandwidth is ``0.9 * min(sd, IQR / 1.34) * n^-0.2``. Where that minimum is zero or
    missing, the standard deviation takes its place, then the size of the smallest value,
    then 1, so that a group without spread has a curve too.

    Each group has a grid of its own, wider than the range by four bandwidths at both ends, of
    at least 512 cells and a power of two if more. A value is shared linearly between
    its two grid points by one partial aggregate, so at most a grid of weights is left per
    group. The weights are convolved with the kernel, whose places are those of a circle of twice
    the cells, ``2 / (2 * cells - 1)`` of the grid's length apart; half of that circle is
    empty, so nothing wraps around. The curve is interpolated linearly between grid points.
    """
    rows = finite_values(df, group, value)
    sketch = group_sketch(rows, QUARTILES, [F.stddev_samp("v").alias("sd")])
    quartiles = exact_quantiles(rows, sketch, QUARTILES).withColumnRenamed("grp", "g")
    reach = (F.col("q2") - F.col("q0")) / 1.34
    spread = F.coalesce(
        *[F.nullif(s, F.lit(0.0)) for s in (F.least("sd", reach), F.col("sd"), F.abs("lo"))], F.lit(1.0)
    )
    bandwidth = 0.9 * spread * F.pow(F.col("n"), F.lit(-0.2))
    span = sketch.agg(F.struct(F.min("lo").alias("first"), F.max("hi").alias("last")).alias("span")).scalar()
    cells = max(DENSITY_POINTS, 1 << math.ceil(math.log2(points)))
    length = F.col("span.last") - F.col("span.first") + 2 * GRID_MARGIN * F.col("bandwidth")
    groups = (
        sketch.join(quartiles, F.col("grp").eqNullSafe(F.col("g")))
        .select("grp", "n", bandwidth.alias("bandwidth"), span.alias("span"))
        .withColumn("start", F.col("span.first") - GRID_MARGIN * F.col("bandwidth"))
        .withColumn("step", length / (cells - 1))
        .withColumn("apart", 2 * length / (2 * cells - 1))
    )
    groups = staged(groups, "curves")
    weights = _grid_weights(rows, groups.select(F.col("grp").alias("g"), "start", "step"), cells)

    def kernel_at(distance: Column) -> Column:
        scaled = distance * F.col("apart") / F.col("bandwidth")
        return F.exp(-0.5 * scaled * scaled)

    x = F.col("span.first") + F.col("point") * (F.col("span.last") - F.col("span.first")) / (points - 1)
    curve = (
        weights.join(groups, F.col("g").eqNullSafe(F.col("grp")))
        .withColumn("kernel", F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), kernel_at))
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .withColumn("place", (F.col("x") - F.col("start")) / F.col("step"))
        .withColumn("left", F.floor("place").cast("int"))
        .withColumn("share", F.col("place") - F.col("left"))
    )

    def add(total: Column, w: Column) -> Column:
        away = F.col("left") - w["bin"]
        here, next_one = F.get("kernel", F.abs(away)), F.get("kernel", F.abs(away + 1))
        return total + w["weight"] * (here + F.col("share") * (next_one - here))

    mass = F.aggregate("weights", F.lit(0.0), add)
    scale = F.col("n") * F.col("bandwidth") * math.sqrt(2 * math.pi)
    return curve.select(F.col("grp").alias(group), "point", "x", "bandwidth", (mass / scale).alias("density"))


def _grid_weights(rows: DataFrame, grids: DataFrame, cells: int) -> DataFrame:
    """(g, weights): per group the non-empty points of its grid with their weight."""
    position = (F.col("v") - F.col("start")) / F.col("step")
    binned = (
        rows.join(grids, F.col("grp").eqNullSafe(F.col("g")))
        .select("grp", position.alias("position"))
        .withColumn("bin", F.least(F.floor("position"), F.lit(cells - 2)).cast("int"))
        .groupBy("grp", "bin")
        .agg(
            F.count(F.lit(1)).alias("n_bin"),
            F.sum(F.col("position") - F.col("bin")).alias("to_right"),
        )
    )
    shares = F.array(
        F.struct("bin", (F.col("n_bin") - F.col("to_right")).alias("weight")),
        F.struct((F.col("bin") + 1).alias("bin"), F.col("to_right").alias("weight")),
    )
    return (
        binned.select("grp", F.inline(shares))
        .groupBy("grp", "bin")
        .agg(F.sum("weight").alias("weight"))
        .groupBy(F.col("grp").alias("g"))
        .agg(F.array_sort(F.collect_list(F.struct("bin", "weight"))).alias("weights"))
    )
