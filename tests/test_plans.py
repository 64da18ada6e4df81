"""Physical plans of the registered queries."""

import re

import pytest
from conftest import plan_of

from millrace.workload import queries as workload

QUERIES = workload.queries()
UNWANTED = [
    "EvalPython",
    "InPandas",
    "InArrow",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "ObjectHashAggregate(keys=[], functions=[percentile(",
]


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    cache = {}

    def plan(name):
        if name not in cache:
            cache[name] = plan_of(QUERIES[name](spark, sf_dir))
        return cache[name]

    return plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_the_plan_and_no_cross_join(plans, name):
    assert [part for part in UNWANTED if part in plans(name)] == []


def test_top_terms_are_limited_ahead_of_the_shuffle(plans):
    plan = plans("chi_square_top75")
    assert re.search(r"WindowGroupLimit .*row_number\(\), 75, Partial", plan)
    assert "LeftAnti, BuildRight" in plan
    assert re.search(r"BroadcastHashJoin \[category#", plan)


def test_modes_are_limited_ahead_of_the_shuffle(plans):
    assert re.search(r"WindowGroupLimit .*row_number\(\), 2, Partial", plans("modes_per_group"))


def test_first_rows_are_a_top_k(plans):
    assert "TakeOrderedAndProject(limit=20" in plans("top_customers")


@pytest.mark.parametrize("name", ["q4_star_join_count", "q4_star_join_sql", "semi_join_count"])
def test_each_table_is_scanned_once(plans, name):
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", plans(name))
    assert sorted(scans) == ["customer", "lineitem", "orders", "part"]


def test_articles_come_before_the_orders(plans):
    plan = plans("q4_star_join_count")
    assert plan.index("Join [order_id#") < plan.index("Join [article_id#")


def test_semi_joins_take_their_sides_as_they_are(plans):
    plan = plans("semi_join_count")
    assert plan.count("LeftSemi") == 2 and "HashAggregate(keys=[article_id" not in plan
    assert plan.count("Aggregate(keys=[customer_id#") == 2


@pytest.mark.parametrize("name", ["q4_star_join_count", "q4_star_join_sql", "semi_join_count"])
def test_filters_and_columns_reach_the_scan(plans, name):
    plan = plans(name)
    assert "In(p_size, [1,2,3])" in plan
    assert "GreaterThan(c_acctbal,3000.0)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    assert "l_extendedprice" not in plan


def test_equality_reaches_the_scan(plans):
    assert "EqualTo(p_size,7)" in plans("q1_filtered_count")


def test_counts_are_combined_ahead_of_the_customer_join(plans):
    joined, _, below = plans("q4_star_join_count").partition("Join [customer_id#")
    assert "partial_count(t_dat#" in below
    assert "partial_count" not in joined


@pytest.mark.parametrize("name", ["label_if_else", "normalize_category", "filter_guarded_numeric"])
def test_row_wise_queries_do_not_shuffle(plans, name):
    assert "Exchange" not in plans(name)


def test_json_is_parsed_once_for_all_fields(plans):
    assert plans("json_fields").count("parseJson(") == 1
    assert plans("json_fields").count("try_variant_get(") == 4
