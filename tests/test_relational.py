import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.values import label_if_else, locale_number, parse_flag
from millrace.operators import counting, filters, joins, ranking
from millrace.plans import forum, retail
from millrace.sources.catalog import register_views


def test_labels_and_flags_keep_missing_values(spark):
    df = spark.createDataFrame([("yes",), ("no",), (None,)], "v string")
    flag = parse_flag(F.col("v"))
    got = df.select("v", flag, label_if_else(flag, "A", "B"))
    assert rows(got) == [("no", False, "B"), ("yes", True, "A"), (None, None, None)]


def test_guarded_numeric(spark):
    df = spark.createDataFrame([("",), (None,), ("30",), ("31",), ("old",)], "age string")
    assert rows(filters.filter_guarded_numeric(df, "age", 30)) == [("31",)]


def test_locale_number(spark):
    df = spark.createDataFrame([("1,5",), ("x",)], "v string")
    assert rows(df.select(locale_number(F.col("v")))) == [(1.5,), (None,)]


def test_simple_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    assert rows(filters.member_of(df, "id", [1, 3])) == [(1, "a"), (3, "c")]
    assert rows(filters.filter_complete_rows(df, ["v"])) == [(1, "a"), (3, "c")]


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(counting.group_count(df, "k")) == [("a", 2), (None, 1)]
    assert rows(counting.having_duplicates(df, ["k"])) == [("a", 2)]
    assert rows(counting.count_where(df, F.col("k") == "b")) == [(0,)]


def test_shares_add_up_per_group(spark):
    df = spark.createDataFrame([("g", "x"), ("g", "x"), ("g", "y"), ("h", "x")], "g string, f string")
    assert rows(counting.bar_shares(df, "g", "f")) == [
        ("g", "x", 2, 2 / 3),
        ("g", "y", 1, 1 / 3),
        ("h", "x", 1, 1.0),
    ]


def test_group_means_skip_missing_values(spark):
    data = [("A", "p", 1.0), ("A", "p", None), ("A", "q", 0.5), ("B", "r", None), ("B", "s", 0.7)]
    got = counting.group_mean_sorted(spark.createDataFrame(data, "o string, i string, v double"), "o", "i", "v")
    assert [tuple(r) for r in got.collect()] == [
        ("A", "q", 0.5, 1, 1),
        ("B", "s", 0.7, 1, 1),
        ("A", "p", 1.0, 1, 2),
        ("B", "r", None, 0, 2),
    ]


ARTICLES = "garment_group_name string, prod_name string, section_name string, department_name string"


def modes(df, **options):
    columns = ["garment_group_name", "prod_name", "section_name", "department_name"]
    return rows(ranking.modes_per_group(df, *columns, **options))


def test_modes_break_ties_by_name(spark):
    df = spark.createDataFrame([("g", v, v, v) for v in "yxyx"], ARTICLES)
    assert modes(df) == [("g", "x", "y", "x")]


def test_modes_single_section(spark):
    df = spark.createDataFrame([("g", "p", "only", "d")], ARTICLES)
    assert modes(df) == [("g", "p", "only", "d")]
    assert modes(df, single_fallback=False) == [("g", "p", None, "d")]


def test_modes_blank_values(spark):
    df = spark.createDataFrame([("g", "", "s", "d"), ("g", "", "s", "d"), ("g", "p", "t", "d")], ARTICLES)
    assert modes(df) == [("g", "", "t", "d")]
    assert modes(df, skip_blank=True) == [("g", "p", "t", "d")]


@pytest.fixture
def shop(spark):
    articles = spark.createDataFrame(
        [
            ("a1", "zip", "Shirt", "G"),
            ("a1", "zip", "Shirt", "G"),
            ("a2", "sock", "Socks", "G"),
            ("a3", "sock", "Socks", "G"),
            ("a4", "abc", "Shirt", "G"),
        ],
        "article_id string, prod_name string, department_name string, garment_group_name string",
    )
    customers = spark.createDataFrame(
        [("c1", "31", "1010"), ("c2", "", "1010"), ("c3", "30", None), ("c4", "40", "2020")],
        "customer_id string, age string, postal_code string",
    )
    transactions = spark.createDataFrame(
        [("d", "c1", "a1"), (None, "c1", "a4"), ("d", "c2", "a1"), ("d", "c3", "a1"), ("d", "c4", "a2")],
        "t_dat string, customer_id string, article_id string",
    )
    return articles, transactions, customers


def test_semi_join_counts_a_repeated_article_once(shop):
    assert rows(retail.transactions_of_known_customers(*shop, ["Shirt"], 30)) == [("c1", 2)]


def test_star_join_counts_a_repeated_article_twice(spark, shop):
    articles, transactions, customers = shop
    got = retail.purchases_per_customer(articles, transactions, customers, ["Shirt"], 30)
    assert rows(got) == [("c1", 2)]
    twice = customers.unionAll(customers)
    assert rows(retail.purchases_per_customer(articles, transactions, twice, ["Shirt"], 30)) == [("c1", 4)]


def test_sql_and_dataframe_forms_agree(spark, shop):
    articles, transactions, customers = shop
    register_views({"articles": articles, "transactions": transactions, "customers": customers})
    assert rows(retail.count_department(articles, "Socks")) == [(2,)]
    assert rows(retail.count_department_sql(spark, "Socks")) == [(2,)]
    assert rows(retail.customers_per_postal_code(customers)) == [("1010", 2), ("2020", 1), (None, 1)]
    assert rows(retail.customers_per_postal_code_sql(spark)) == rows(
        retail.customers_per_postal_code(customers)
    )
    assert rows(retail.top_product_per_group(articles)) == [("G", "sock", 2)]
    assert rows(retail.top_product_per_group_sql(spark)) == [("G", "sock", 2)]
    sql = retail.purchases_per_customer_sql(spark, ["Shirt", "Socks"], 30)
    api = retail.purchases_per_customer(articles, transactions, customers, ["Shirt", "Socks"], 30)
    assert [tuple(r) for r in sql.collect()] == [tuple(r) for r in api.collect()] == [("c1", 2), ("c4", 1)]


def test_top_product_and_first_product_differ(shop):
    assert rows(retail.first_product_per_group(shop[0])) == [("G", "abc")]
    assert rows(retail.top_product_per_group(shop[0])) == [("G", "sock", 2)]


def test_first_rows(spark):
    got = joins.first_rows(spark.range(50), [F.desc("id")])
    assert [r[0] for r in got.collect()] == list(range(49, 29, -1))


def test_left_join_keeps_every_left_row(spark):
    left = spark.createDataFrame([("PSE", 1), ("PSE", 2), ("XXX", 3), (None, 4)], "code string, v int")
    right = spark.createDataFrame([("PSE", 9), ("YYY", 8), (None, 7)], "country string, p int")
    got = joins.left_join_enrich(left, right, "code", "country")
    assert got.columns == ["code", "v", "p"]
    assert rows(got) == [("PSE", 1, 9), ("PSE", 2, 9), ("XXX", 3, None), (None, 4, None)]


def test_active_posts_need_a_repeated_link(spark):
    users = spark.createDataFrame([(1,), (2,)], "id bigint")
    posts = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "id bigint, owneruserid bigint")
    comments = spark.createDataFrame([(10,), (10,), (11,), (12,)], "postid bigint")
    links = spark.createDataFrame([(5, 10), (5, 10), (6, 11), (7, 12)], "id bigint, postid bigint")
    assert rows(forum.users_active_posts(users, posts, comments, links)) == [(1, 1)]
