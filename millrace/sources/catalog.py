"""Managed tables, temporary views and schema reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.schemas import FORUM_TABLES


def create_table(spark: SparkSession, name: str, schema: str | T.StructType) -> DataFrame:
    """An empty managed table with a declared schema."""
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.catalog.createTable(name, source="parquet", schema=declared)


def create_forum_tables(
    spark: SparkSession, database: str, location: str | None = None
) -> list[str]:
    """The six tables of a question-and-answer site, in a database of their own."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    for name, schema in FORUM_TABLES.items():
        create_table(spark, f"{database}.{name}", schema)
    return list(FORUM_TABLES)


def load_into_table(
    df: DataFrame, table: str, bucket_by: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Load rows into a managed table and return the table.

    The input is copied, not consumed. With ``bucket_by`` the table is stored
    bucketed and sorted by that key: later joins on it need no shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by is not None:
        writer = writer.bucketBy(buckets or 200, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def register_views(views: dict[str, DataFrame]) -> None:
    """Give frames a name SQL text can use."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and how many values are present.

    Files seldom say which columns may be empty, so presence is counted: one
    aggregate over the whole table, unpivoted.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    described = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"c{i}").alias("present"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*described)))
