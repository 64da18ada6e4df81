"""Parsing of flags and numbers, and conditional labels.

Spark 4 raises on a bad cast, so every parse of text goes through ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def parse_flag(text: Column, yes: str = "yes") -> Column:
    """``yes`` is true, any other text false, NULL stays NULL."""
    return text == F.lit(yes)


def label_if_else(condition: Column, if_true: str, if_false: str) -> Column:
    """Label by a condition; an unknown condition gives NULL, not the else label."""
    return F.when(condition, F.lit(if_true)).when(~condition, F.lit(if_false))


def number_above(text: Column, bound: int | float, number_type: str = "int") -> Column:
    """True where ``text`` holds a number above ``bound``; NULL where it holds none.

    As a filter this drops blank text, and on a numeric column it reaches the scan.
    """
    return text.try_cast(number_type) > F.lit(bound)


def locale_number(
    text: Column, decimal_mark: str = ",", number_type: str | DataType = "double"
) -> Column:
    """A number from text that uses its own decimal mark."""
    return F.replace(text, F.lit(decimal_mark), F.lit(".")).try_cast(number_type)


def is_finite(value: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    return F.abs(value) < F.lit(float("inf"))


# 97.5 % quantiles of Student's t for 1 to 30 degrees of freedom.
T_975 = [
    12.706204736174705, 4.302652729749464, 3.1824463052837095, 2.7764451051977943, 2.5705818356363155,
    2.44691185114497, 2.3646242515927853, 2.3060041352041667, 2.2621571627982053, 2.228138851986275,
    2.2009851600916397, 2.178812829667229, 2.1603686564627926, 2.144786687917804, 2.1314495455597755,
    2.1199052992212546, 2.109815577833317, 2.1009220402410387, 2.0930240544083096, 2.085963447265865,
    2.0796138447276804, 2.0738730679040263, 2.0686576104190486, 2.063898561628026, 2.0595385527532977,
    2.055529438642873, 2.0518305164802855, 2.048407141795245, 2.0452296421327043, 2.042272456301238,
]
# Fixed value: the 97.5 % quantile of the normal distribution.
NORMAL_975 = 1.959963984540054


def two_sided_t_95(df: Column) -> Column:
    """97.5 % quantile of Student's t for every whole number of degrees of freedom from 1 on.

    Tabulated up to 30; beyond that the Cornish-Fisher series in 1/df, good to 3e-8. NULL
    for 0 or fewer, which have no distribution.
    """
    z = NORMAL_975
    terms = [
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    n = df.cast("double")
    series = F.lit(terms[0])
    for power, coefficient in enumerate(terms[1:], start=1):
        series = series + F.lit(coefficient) / F.pow(n, F.lit(float(power)))
    tabulated = F.get(F.array(*[F.lit(t) for t in T_975]), df.cast("int") - 1)
    return F.when(df > len(T_975), series).when(df >= 1, tabulated)
