"""Shop queries over articles, customers and transactions, as DataFrame calls and as SQL.

The SQL functions expect the views ``articles``, ``customers`` and
``transactions`` (see ``register_views``) with the columns named below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import number_above
from millrace.operators import counting, filters, joins, ranking


def count_department(articles: DataFrame, department) -> DataFrame:
    """How many articles one department lists."""
    return counting.count_where(articles, F.col("department_name") == F.lit(department))


def count_department_sql(spark: SparkSession, department) -> DataFrame:
    return spark.sql(
        "SELECT count(*) AS n FROM articles WHERE department_name = :department",
        args={"department": department},
    )


def customers_per_postal_code(customers: DataFrame) -> DataFrame:
    return counting.group_count(customers, "postal_code")


def customers_per_postal_code_sql(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT postal_code, count(*) AS n FROM customers GROUP BY postal_code")


def top_product_per_group(articles: DataFrame) -> DataFrame:
    """The most frequent product of each garment group."""
    return ranking.top_by_count(articles, "garment_group_name", "prod_name")


def top_product_per_group_sql(spark: SparkSession) -> DataFrame:
    return spark.sql(
        """
        WITH counted AS (
          SELECT garment_group_name, prod_name, count(prod_name) AS n
          FROM articles
          GROUP BY garment_group_name, prod_name),
        placed AS (
          SELECT *, row_number() OVER (
            PARTITION BY garment_group_name ORDER BY n DESC, prod_name) AS place
          FROM counted)
        SELECT garment_group_name, prod_name, n FROM placed WHERE place = 1
        """
    )


def first_product_per_group(articles: DataFrame) -> DataFrame:
    """The alphabetically first product of each garment group: not the most frequent one."""
    return ranking.first_by_name(articles, "garment_group_name", "prod_name")


def purchases_per_customer(
    articles: DataFrame,
    transactions: DataFrame,
    customers: DataFrame,
    departments: list,
    older_than: int | float,
    number_type: str = "int",
    headers: DataFrame | None = None,
) -> DataFrame:
    """Purchases from some departments by customers above an age, most purchases first.

    With ``headers`` (``order_id, customer_id``) the transactions name an order instead of
    a customer.
    """
    return joins.star_join_count(
        transactions,
        filters.member_of(articles, "department_name", departments),
        filters.filter_guarded_numeric(customers, "age", older_than, number_type),
        headers=headers,
    )


def purchases_per_customer_sql(
    spark: SparkSession, departments: list, older_than: int | float, number_type: str = "int"
) -> DataFrame:
    """The same in SQL; purchases are counted per customer ahead of the customer join.

    Departments are a list of markers, which reaches the scan of the articles.
    """
    wanted = {f"d{k}": d for k, d in enumerate(departments)}
    listed = ", ".join(f":{name}" for name in wanted) or "NULL"
    return spark.sql(
        f"""
        WITH bought AS (
          SELECT customer_id, count(t_dat) AS n
          FROM transactions JOIN articles USING (article_id)
          WHERE department_name IN ({listed})
          GROUP BY customer_id)
        SELECT customer_id, sum(n) AS count_transactions
        FROM bought JOIN customers USING (customer_id)
        WHERE try_cast(age AS {number_type}) > :older_than
        GROUP BY customer_id
        ORDER BY count_transactions DESC, customer_id
        """,
        args={**wanted, "older_than": older_than},
    )


def transactions_of_known_customers(
    articles: DataFrame,
    transactions: DataFrame,
    customers: DataFrame,
    departments: list,
    older_than: int | float,
    number_type: str = "int",
) -> DataFrame:
    """Like :func:`purchases_per_customer`, but a repeated article or customer counts once."""
    return joins.semi_join_count(
        transactions,
        filters.member_of(articles, "department_name", departments),
        customers.where(number_above(F.col("age"), older_than, number_type)),
    )
