"""Country statistics: densities, bars, fits, boxplots and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import label_if_else, parse_flag
from millrace.operators import counting, distribution, regression
from millrace.operators.filters import filter_complete_rows
from millrace.operators.joins import left_join_enrich
from millrace.sources.readers import read_csv_locale
from millrace.sources.schemas import COUNTRY_STATISTICS


def load_countries(spark: SparkSession, path: str) -> DataFrame:
    """Countries with a known status and two-letter code; yes/no columns as booleans."""
    rows = filter_complete_rows(
        read_csv_locale(spark, path, COUNTRY_STATISTICS), ["developed", "iso_3166_2"]
    )
    flags = ["above_average_median_age", "above_average_yu"]
    rows = rows.withColumns({f: parse_flag(F.col(f)) for f in flags})
    return rows.withColumn(
        "development", label_if_else(F.col("developed"), "Developed", "Not Developed")
    )


def country_tables(countries: DataFrame) -> dict[str, DataFrame]:
    """The table behind each chart of the report."""
    age, unemployment = "age_median", "youth_unempl_rate"
    return {
        "age_density": distribution.grouped_density(countries, "development", age),
        "unemployment_density": distribution.grouped_density(countries, "development", unemployment),
        "region_bars": counting.bar_counts(countries, "region_name", "development"),
        "region_shares": counting.bar_shares(countries, "region_name", "development"),
        "fit": regression.ols_fit_by_group(countries, "development", unemployment, age),
        "fit_band": regression.ols_band_by_group(countries, "development", unemployment, age),
        "unemployment_boxes": distribution.boxplot_stats(countries, "region_name", unemployment),
        "age_boxes": distribution.boxplot_stats(countries, "region_name", age),
        "unemployment_means": counting.group_mean_sorted(
            countries, "region_name", "sub_region_name", unemployment
        ),
    }


def population_bubbles(countries: DataFrame, population: DataFrame) -> DataFrame:
    """Unemployment against age, sized by population; countries without one are not drawn."""
    enriched = left_join_enrich(countries, population, "iso_3166_3", "country_code")
    return counting.bubble_table(
        enriched, "country_name", "youth_unempl_rate", "age_median", "development", "population_2020"
    )
