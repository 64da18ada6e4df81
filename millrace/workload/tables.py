"""The benchmark tables, read with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the role of shop articles."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS article_id",
        "p_name AS prod_name",
        "p_type AS garment_group_name",
        "p_brand AS section_name",
        "p_size AS department_name",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the account balance in the role of the age."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id", "c_nationkey AS postal_code", "c_acctbal AS age"
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the customer of their order."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_partkey AS article_id", "l_shipdate AS t_dat"
    )
    buyers = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id"
    )
    return lines.join(buyers, "order_id").select("t_dat", "customer_id", "article_id")
