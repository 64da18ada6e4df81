"""Operators on tables without rows."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import association, checks, counting, distribution, ranking, regression, series


def test_empty_tables(spark):
    df = spark.createDataFrame([], "g string, f string, x double, y double")
    assert rows(association.chi_square_scores(df, "f", "g")) == []
    assert rows(association.term_lines(association.top_terms(association.chi_square_scores(df, "f", "g"), 3))) == []
    assert rows(distribution.boxplot_stats(df, "g", "x")) == []
    assert rows(distribution.boxplot_outliers(df, "g", "x")) == []
    assert rows(distribution.grouped_density(df, "g", "x")) == []
    assert rows(regression.ols_fit_by_group(df, "g", "x", "y")) == []
    assert rows(regression.ols_band_by_group(df, "g", "x", "y")) == []
    assert rows(regression.ols_residuals(df, "x", "y")) == []
    assert rows(ranking.modes_per_group(df, "g", "f", "x", "y")) == []
    assert rows(counting.bar_shares(df, "g", "f")) == []
    assert rows(series.consecutive_ratio(df, "g", "x", "y", F.floor("x"))) == []
    assert rows(series.consecutive_ratio(df, "g", "x", "y")) == []
    assert rows(series.consecutive_ratio(df, "g", "f", "y")) == []
    assert rows(checks.min_count_check(df, "x", [(1.0, 1)])) == [(1, 1.0, 1, 0, False)]
    got = checks.columns_all_equal(df, F.col("x"), F.col("y")).first()
    assert (got.n_rows, got.all_identical, got.all_equal) == (0, True, True)


def test_one_row_groups(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 1.0)], "g string, x double, y double")
    assert rows(distribution.boxplot_stats(df, "g", "x")) == [("a", 1, 1.0, 1.0, 1.0, 1.0, 1.0, 0)]
    density = distribution.grouped_density(df, "g", "x").collect()
    # no spread and the value 1: the bandwidth is 0.9, the curve a single bell
    assert {(r.g, r.bandwidth) for r in density} == {("a", 0.9)}
    assert max(r.density for r in density) == pytest.approx(1 / (0.9 * math.sqrt(2 * math.pi)), rel=1e-3)
    assert rows(regression.ols_fit_by_group(df, "g", "x", "y"))[0][:1] == ("a",)
    band = regression.ols_band_by_group(df, "g", "x", "y").collect()
    assert {(r.g, r.lower) for r in band} == {("a", None)}
