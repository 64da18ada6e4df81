"""Least-squares fits, bands and residuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import two_sided_t_95
from millrace.operators.checks import GUARD_MESSAGE
from millrace.operators.joins import free_name

# Fixed value: number of x positions of a drawn fit.
BAND_POINTS = 80


def _complete(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull())


def ols_fit_by_group(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Slope, intercept and size of the fit ``y ~ x`` of each group."""
    return df.groupBy(group).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_count(y, x).alias("n"),
    )


def ols_band_by_group(
    df: DataFrame, group: str, x: str, y: str, points: int = BAND_POINTS
) -> DataFrame:
    """The fitted line of each group over its own x range, with a 95 % confidence band.

    One aggregate per group; the points are then spanned inside the group's row.
    Groups of one or two rows have no degree of freedom left and a NULL band.
    """
    fits = (
        _complete(df, x, y)
        .groupBy(group)
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.regr_count(y, x).alias("n"),
            F.regr_avgx(y, x).alias("mean_x"),
            F.regr_sxx(y, x).alias("sxx"),
            F.regr_syy(y, x).alias("syy"),
            F.regr_sxy(y, x).alias("sxy"),
            F.min(x).cast("double").alias("min_x"),
            F.max(x).cast("double").alias("max_x"),
        )
    )
    freedom = F.col("n") - 2
    unexplained = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    variance = F.try_divide(F.greatest(unexplained, F.lit(0.0)), freedom)
    step = (F.col("max_x") - F.col("min_x")) / (points - 1)
    line = fits.withColumn("variance", variance).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    line = line.withColumn("x", F.col("min_x") + F.col("point") * step)
    away = F.col("x") - F.col("mean_x")
    leverage = F.lit(1.0) / F.col("n") + F.try_divide(away * away, F.col("sxx"))
    half_width = two_sided_t_95(freedom) * F.sqrt(F.col("variance") * leverage)
    fit = F.col("intercept") + F.col("slope") * F.col("x")
    return line.select(
        group,
        "point",
        "x",
        fit.alias("fit"),
        (fit - half_width).alias("lower"),
        (fit + half_width).alias("upper"),
    )


def _fit(y: Column, x: Column) -> tuple[Column, Column]:
    """Intercept and slope; without spread in x the fit is the mean of y."""
    slope = F.coalesce(F.regr_slope(y, x), F.lit(0.0))
    intercept = F.coalesce(F.regr_intercept(y, x), F.avg(F.when(x.isNotNull(), y)))
    return intercept, slope


def ols_residuals(df: DataFrame, x: str, y: str, name: str = "residual") -> DataFrame:
    """Rows with the residual of the fit ``y ~ x`` over the whole table.

    The fit is one row and enters the second pass as a scalar. Rows without x or y
    have no residual and are left out.
    """
    rows = _complete(df, x, y)
    intercept, slope = _fit(F.col(y), F.col(x))
    fit = rows.agg(F.struct(intercept.alias("intercept"), slope.alias("slope")).alias("fit")).scalar()
    return rows.withColumn(name, F.col(y) - (fit["intercept"] + fit["slope"] * F.col(x)))


def residual_chain(
    df: DataFrame, x: str, z: str, steps: int = 4, name: str = "transformed"
) -> DataFrame:
    """Repeatedly replace x by ``i * sin(residual of x ~ z) + 0.01 * i``, i = 1 .. steps.

    Step i needs at least i values of i / 1000 or more; the query stops with a message
    otherwise. Guard and fit of a step are one aggregate whose row enters the next step as a scalar:
    nothing runs before the result is asked for, and no intermediate rows are stored.
    """
    rows = _complete(df, x, z)
    own, found = free_name("current", set(df.columns)), free_name("fit", set(df.columns))
    chained = rows.withColumn(own, F.col(f"`{x}`").cast("double"))
    for i in range(1, steps + 1):
        threshold = i * 0.001
        intercept, slope = _fit(F.col(own), F.col(f"`{z}`"))
        fit = F.struct(intercept.alias("intercept"), slope.alias("slope"))
        enough = F.count_if(F.col(own) >= threshold) >= i
        message = GUARD_MESSAGE.format(step=i, required=i, threshold=threshold)
        guarded = chained.agg(F.when(enough, fit).otherwise(F.raise_error(message)).alias("fit")).scalar()
        # the scalar stands in one column, as every mention of it would repeat the steps before
        residual = F.col(own) - (F.col(f"{found}.intercept") + F.col(f"{found}.slope") * F.col(f"`{z}`"))
        chained = chained.withColumn(found, guarded).withColumn(own, i * F.sin(residual) + 0.01 * i).drop(found)
    return chained.select(*[F.col(f"`{c}`") for c in df.columns], F.col(own).alias(name))
