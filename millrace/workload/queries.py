"""One callable ``(spark, sf_dir) -> DataFrame`` per registered query.

Doubles are rounded for comparison with other engines, whose sums run in another
order; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as words
from millrace.functions.values import label_if_else, number_above, parse_flag
from millrace.operators import (
    association,
    checks,
    counting,
    distribution,
    documents,
    filters,
    joins,
    ranking,
    regression,
    series,
    terms,
)
from millrace.plans import forum, retail, term_selection
from millrace.session import delete_at_end, scratch_path, staged, tune
from millrace.sinks import writers
from millrace.sources import catalog, readers
from millrace.workload.tables import SCHEMAS, articles, customers, table, transactions

STOP_WORDS = ["the", "of", "and", "in", "is", "der", "die", "und", "la", "le", "de", "el"]
DEPARTMENTS = [1, 2, 3]
OLDER_THAN = 3000

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _stop_words(spark: SparkSession) -> DataFrame:
    """A local relation, so the planner knows its size."""
    words_sql = ", ".join(f"('{w}')" for w in STOP_WORDS)
    return spark.sql(f"SELECT term FROM VALUES {words_sql} AS words(term)")


def _awkward_category() -> Column:
    """Categories by document number: missing ones, some that need normalising, one of digits."""
    return (
        F.when(F.col("doc_id") % 7 == 0, F.lit(None))
        .when(F.col("doc_id") % 7 == 1, "42")
        .when(F.col("doc_id") % 7 < 4, "Toys & Games")
        .otherwise("BOOKS/old")
    )


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as comments on orders; many orders have none."""
    return table(spark, sf_dir, "events").selectExpr("event_id AS id", "user_id AS postid")


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


# --- sources and sinks: write in the foreign format, read back with the operator


@_query
def scan_json_lines(spark, sf_dir):
    """Broken lines, objects after a tab, and extra fields that do not fit their type."""
    docs = _documents(spark, sf_dir, "doc_id", "lang", "text")
    number = F.col("doc_id").cast("string")
    number = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("x"), number)).otherwise(number)
    good = docs.select(
        F.concat(
            F.when(F.col("doc_id") % 3 == 0, F.lit("\t")).otherwise(F.lit("")),
            F.to_json(
                F.struct(
                    number.alias("doc_id"), F.col("text").alias("reviewText"), F.col("lang").alias("category")
                )
            ),
        ).alias("value")
    )
    broken = docs.select(F.format_string('{"reviewText": %d, broken', "doc_id").alias("value"))
    listed = docs.select(F.format_string('[{"reviewText": "%d"}]', "doc_id").alias("value"))
    path = scratch_path(spark, "json-lines")
    good.unionAll(broken).unionAll(listed).write.text(path)
    return readers.read_json_docs(spark, path, extra="doc_id bigint")


@_query
def scan_csv_quoted(spark, sf_dir):
    path = scratch_path(spark, "csv-quoted")
    table(spark, sf_dir, "customer").write.csv(path, header=True, quoteAll=True, escape='"')
    return readers.read_csv_quoted(spark, path, SCHEMAS["customer"])


@_query
def csv_mixed_headers(spark, sf_dir):
    """Customers in files whose headers order the columns differently and leave one out."""
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_acctbal", "Account Balance")
    path = scratch_path(spark, "csv-mixed")
    orders = [
        ["c_custkey", "c_name", "Account Balance", "c_nationkey"],
        ["Account Balance", "c_nationkey", "c_custkey", "c_name"],
        ["c_name", "c_custkey"],
    ]
    for rest, names in enumerate(orders):
        part = people.where(F.col("c_custkey") % len(orders) == rest).select(*names)
        part.write.mode("append").csv(path, header=True, escape='"')
    columns = {"c_custkey": "id bigint", "c_name": "name string", "Account.Balance": "balance double"}
    return readers.read_csv_header(spark, path, columns | {"c_nationkey": "nation int"})


@_query
def scan_delimited_text(spark, sf_dir):
    """Rows with quotes and control characters as data, bad numbers, missing and surplus fields.

    There is a blank line for every urgent order, which is a row without an order.
    """
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", price]
    date = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    priority = F.concat(F.lit('"'), "o_orderpriority", F.lit('\u0001"'))
    line = (
        F.when(F.col("o_orderstatus") == "F", F.concat_ws(",", *fields))
        .when(F.col("o_orderstatus") == "O", F.concat_ws(",", *fields, date, priority, F.lit("x")))
        .otherwise(F.concat_ws(",", *fields, date, priority))
    )
    path = scratch_path(spark, "delimited")
    orders.select(line.alias("header")).write.csv(path, header=True, sep="\u0002", quote="")
    blank = orders.where(F.startswith("o_orderpriority", F.lit("1"))).select(F.lit("").alias("value"))
    blank.write.mode("append").text(path)
    return readers.read_delimited_text(spark, path, SCHEMAS["orders"])


@_query
def scan_csv_locale(spark, sf_dir):
    """Decimal commas, and ``.`` for the negative balances, declared missing here."""
    balance = F.when(
        F.col("s_acctbal") >= 0, F.replace(F.col("s_acctbal").cast("string"), F.lit("."), F.lit(","))
    )
    path = scratch_path(spark, "csv-locale")
    table(spark, sf_dir, "supplier").withColumn("s_acctbal", balance).write.csv(
        path, sep=";", nullValue="."
    )
    return readers.read_csv_locale(spark, path, SCHEMAS["supplier"])


@_query
def load_table(spark, sf_dir):
    """A bucketed managed table, one per application."""
    name = f"orders_{spark.sparkContext.applicationId.replace('-', '_')}"
    orders = table(spark, sf_dir, "orders")
    loaded = catalog.load_into_table(orders, name, bucket_by="o_custkey", buckets=8)
    delete_at_end(spark, _location(spark, name))
    return loaded


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'")
    return described.first()["data_type"]


@_query
def forum_tables(spark, sf_dir):
    """Declared tables of a forum, filled from files, and the activity of its users."""
    database = f"forum_{spark.sparkContext.applicationId.replace('-', '_')}"
    place = scratch_path(spark, "forum")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    catalog.create_forum_tables(spark, database, place)
    people, orders, lines = (table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem"))
    rows = {
        "users": people.selectExpr("c_custkey AS id", "c_name AS displayname"),
        "posts": orders.selectExpr("o_orderkey AS id", "o_custkey AS owneruserid"),
        "comments": _comments(spark, sf_dir),
        "postlinks": lines.selectExpr("l_linenumber AS id", "l_orderkey AS postid"),
    }
    for name, df in rows.items():
        declared = spark.table(f"{database}.{name}")
        filled = df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in declared.schema
            ]
        )
        filled.write.insertInto(f"{database}.{name}")
    return forum.users_active_posts(*[spark.table(f"{database}.{name}") for name in rows])


@_query
def mixed_input_semi_join(spark, sf_dir):
    """Articles, transactions and customers mixed in one set of files, told apart by width."""
    path = scratch_path(spark, "mixed")
    tables = {
        "articles": articles(spark, sf_dir),
        "transactions": transactions(spark, sf_dir),
        "customers": customers(spark, sf_dir).withColumn("extra", F.lit("a, b")),
    }
    for name, df in tables.items():
        df.write.csv(f"{path}/{name}", header=True, quoteAll=True, escape='"')
    schemas = {name: df.schema for name, df in tables.items()}
    found = readers.read_multi(spark, [f"{path}/{name}" for name in tables], schemas)
    return retail.transactions_of_known_customers(
        found["articles"], found["transactions"], found["customers"], DEPARTMENTS, OLDER_THAN, "double"
    )


@_query
def header_csv_bubbles(spark, sf_dir):
    """A CSV with awkward header names, joined to the customers and drawn as bubbles."""
    counted = counting.group_count(table(spark, sf_dir, "orders"), "o_custkey", name="n")
    path = scratch_path(spark, "header-csv")
    counted.selectExpr("o_custkey AS `Customer Code`", "'a, b' AS `Long name`", "n AS `2020`").write.csv(
        path, header=True, quoteAll=True, escape='"'
    )
    columns = {"Customer.Code": "code bigint", "X2020": "n_orders bigint"}
    found = readers.read_csv_header(spark, path, columns)
    enriched = joins.left_join_enrich(
        table(spark, sf_dir, "customer"), found, "c_custkey", "code"
    ).withColumn("standing", label_if_else(F.col("c_acctbal") > 0, "credit", "debt"))
    return counting.bubble_table(enriched, "c_name", "c_acctbal", "c_nationkey", "standing", "n_orders")


@_query
def term_report_files(spark, sf_dir):
    """JSON reviews and a stop-word file to a text report, all as files."""
    reviews, stop, out = (scratch_path(spark, f"report-{n}") for n in ("reviews", "stop", "out"))
    docs = _documents(spark, sf_dir, "doc_id", "text")
    review = F.struct(F.col("text").alias("reviewText"), _awkward_category().alias("category"))
    docs.select(F.to_json(review).alias("value")).write.text(reviews)
    twice = _stop_words(spark)
    twice.unionAll(twice).select(F.col("term").alias("value")).write.text(stop)
    term_selection.term_report(spark, reviews, stop, out)
    return spark.read.text(out)


@_query
def sink_single_file(spark, sf_dir):
    """One report file; writing it again where that is not allowed must be refused."""
    counts = counting.group_count(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")
    path = scratch_path(spark, "single")
    writers.write_single_text(counts, path, mode="errorifexists")
    try:
        writers.write_single_text(counts, path, mode="errorifexists")
        refused = False
    except FileExistsError:
        refused = True
    lines = spark.read.text(path)
    n_files = lines.select(F.input_file_name().alias("file")).distinct().count()
    return lines.select("value", F.lit(n_files).cast("bigint").alias("n_files"), F.lit(refused).alias("refused"))


@_query
def schema_report(spark, sf_dir):
    return catalog.schema_report(table(spark, sf_dir, "lineitem"))


@_query
def sink_text_roundtrip(spark, sf_dir):
    scores = association.chi_square_scores(
        _documents(spark, sf_dir, "lang", "text"), "text", "lang"
    )
    lines = association.term_lines(
        association.top_terms(scores, term_selection.TERMS_BY_NAME), by="term"
    )
    path = scratch_path(spark, "text-lines")
    writers.write_text_lines(lines, path)
    return spark.read.text(path)


@_query
def sink_csv_roundtrip(spark, sf_dir):
    modes = ranking.modes_per_group(
        articles(spark, sf_dir), "garment_group_name", "prod_name", "section_name", "department_name"
    )
    path = scratch_path(spark, "csv-rows")
    writers.write_csv_rows(modes, path)
    return readers.read_csv_quoted(spark, path, modes.schema, header=False)


# --- projections and filters


@_query
def label_if_else_query(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    label = label_if_else(F.col("c_acctbal") > 0, "credit", "debt")
    return customer.select("c_custkey", label.alias("label"))


@_query
def parse_flag_query(spark, sf_dir):
    answer = F.when(F.col("l_returnflag") == "R", "yes").when(F.col("l_returnflag") == "A", "no")
    flagged = table(spark, sf_dir, "lineitem").select(parse_flag(answer).alias("flag"))
    return counting.group_count(flagged, "flag")


@_query
def filter_guarded_numeric(spark, sf_dir):
    age = F.when(F.col("c_acctbal") < 0, "").otherwise(F.floor("c_acctbal").cast("string"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", age.alias("age"))
    return filters.filter_guarded_numeric(customer, "age", OLDER_THAN)


@_query
def filter_complete_rows(spark, sf_dir):
    labelled = joins.left_join_enrich(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang"),
        table(spark, sf_dir, "labels"),
        "id",
        "doc_id",
    )
    return filters.filter_complete_rows(labelled, ["quality", "toxic"])


@_query
def min_count_check(spark, sf_dir):
    steps = [(1000.0, 1), (20000.0, 100), (40000.0, 1000), (1000000.0, 1)]
    return checks.min_count_check(table(spark, sf_dir, "lineitem"), "l_extendedprice", steps)


# --- joins


@_query
def users_active_posts(spark, sf_dir):
    return forum.users_active_posts(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")),
        table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_custkey AS owneruserid"),
        _comments(spark, sf_dir),
        table(spark, sf_dir, "lineitem").selectExpr("l_linenumber AS id", "l_orderkey AS postid"),
    )


@_query
def semi_join_count(spark, sf_dir):
    return retail.transactions_of_known_customers(
        articles(spark, sf_dir),
        transactions(spark, sf_dir),
        customers(spark, sf_dir),
        DEPARTMENTS,
        OLDER_THAN,
        "double",
    )


@_query
def left_join_enrich(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), "lang", "source", "n_chars"
    )
    return joins.left_join_enrich(docs, table(spark, sf_dir, "labels"), "id", "doc_id")


@_query
def left_join_enrich_repeated(spark, sf_dir):
    """Suppliers and customers of a nation: right keys repeat, and both sides have a ``name``."""
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_nationkey AS nation"
    )
    people = table(spark, sf_dir, "customer").where("c_nationkey % 3 <> 0")
    people = people.selectExpr("c_nationkey AS c_nation", "c_name AS name")
    return joins.left_join_enrich(suppliers, people, "nation", "c_nation")


# --- shop queries


@_query
def q1_filtered_count(spark, sf_dir):
    return retail.count_department(articles(spark, sf_dir), 7)


@_query
def q1_filtered_count_sql(spark, sf_dir):
    catalog.register_views({"articles": articles(spark, sf_dir)})
    return retail.count_department_sql(spark, 7)


@_query
def q2_group_count(spark, sf_dir):
    return retail.customers_per_postal_code(customers(spark, sf_dir))


@_query
def q2_group_count_sql(spark, sf_dir):
    catalog.register_views({"customers": customers(spark, sf_dir)})
    return retail.customers_per_postal_code_sql(spark)


@_query
def having_duplicates(spark, sf_dir):
    return counting.having_duplicates(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"]
    )


@_query
def q3_top_by_count(spark, sf_dir):
    return retail.top_product_per_group(articles(spark, sf_dir))


@_query
def q3_top_by_count_sql(spark, sf_dir):
    catalog.register_views({"articles": articles(spark, sf_dir)})
    return retail.top_product_per_group_sql(spark)


@_query
def q3_first_by_name(spark, sf_dir):
    return retail.first_product_per_group(articles(spark, sf_dir))


@_query
def q4_star_join_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_partkey AS article_id", "l_shipdate AS t_dat"
    )
    headers = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS order_id", "o_custkey AS customer_id")
    return retail.purchases_per_customer(
        articles(spark, sf_dir), lines, customers(spark, sf_dir), DEPARTMENTS, OLDER_THAN, "double", headers
    )


@_query
def q4_star_join_sql(spark, sf_dir):
    catalog.register_views(
        {
            "articles": articles(spark, sf_dir),
            "transactions": transactions(spark, sf_dir),
            "customers": customers(spark, sf_dir),
        }
    )
    return retail.purchases_per_customer_sql(spark, DEPARTMENTS, OLDER_THAN, "double")


@_query
def top_customers(spark, sf_dir):
    order = [F.desc("count_transactions"), F.asc("customer_id")]
    return joins.first_rows(q4_star_join_count(spark, sf_dir), order)


# --- most frequent values


@_query
def modes_per_group(spark, sf_dir):
    return ranking.modes_per_group(
        articles(spark, sf_dir), "garment_group_name", "prod_name", "section_name", "department_name"
    )


@_query
def modes_per_group_literal(spark, sf_dir):
    """Groups with a single section report NULL."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS customer_id",
        "o_orderpriority AS priority",
        "o_orderstatus AS status",
        "year(o_orderdate) AS year",
    )
    return ranking.modes_per_group(
        orders, "customer_id", "priority", "status", "year", single_fallback=False
    )


# --- terms


@_query
def tokens_filtered(spark, sf_dir):
    docs = _documents(spark, sf_dir, "doc_id", "text")
    return terms.tokenize(docs, "text", stop_words=_stop_words(spark), keep=["doc_id"])


@_query
def normalize_category(spark, sf_dir):
    label = F.concat("p_type", F.lit(" & "), "p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey", words.normalized_category(label).alias("category")
    )


@_query
def doc_freq_terms(spark, sf_dir):
    docs = _documents(spark, sf_dir, "text")
    return terms.frequency(terms.tokenize(docs, "text", keep=[]), "term")


@_query
def doc_freq_pairs(spark, sf_dir):
    docs = _documents(spark, sf_dir, "lang", "text")
    return terms.frequency(terms.tokenize(docs, "text", keep=["lang"]), "lang", "term")


@_query
def term_freq_pairs(spark, sf_dir):
    """Occurrences, not documents; digits stay inside terms."""
    docs = _documents(spark, sf_dir, "lang", "text")
    occurrences = terms.tokenize(
        docs, "text", words.DELIMITERS_KEEP_DIGITS, distinct=False, keep=["lang"]
    )
    return terms.frequency(occurrences, "lang", "term")


@_query
def chi_square_scores(spark, sf_dir):
    return association.chi_square_scores(
        _documents(spark, sf_dir, "lang", "text"), "text", "lang", _stop_words(spark)
    )


@_query
def chi_square_top75(spark, sf_dir):
    """Categories that need normalising; documents without one count under ``?``."""
    docs = _documents(spark, sf_dir, "doc_id", "text").withColumn("category", _awkward_category())
    return term_selection.select_terms(
        docs, "text", "category", _stop_words(spark), term_selection.TERMS_BY_NAME, normalize=True
    )


@_query
def chi_square_top150_text(spark, sf_dir):
    top = term_selection.select_terms(
        _documents(spark, sf_dir, "source", "text"),
        "text",
        "source",
        k=term_selection.TERMS_BY_SCORE,
        delimiters=words.DELIMITERS_KEEP_DIGITS,
    )
    return association.term_lines(top, by="rank")


# --- grouped statistics


@_query
def group_mean_sorted(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    balances = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return _rounded(
        counting.group_mean_sorted(balances, "r_name", "n_name", "c_acctbal"), {"mean": 6}
    )


@_query
def bar_counts(spark, sf_dir):
    return counting.bar_counts(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@_query
def bar_shares(spark, sf_dir):
    shares = counting.bar_shares(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")
    return _rounded(shares, {"share": 10})


@_query
def grouped_density(spark, sf_dir):
    """Balances per segment, and two more groups: one value many times, and one row alone."""
    balances = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    level = balances.where("c_custkey % 10 = 0").selectExpr(
        "c_custkey", "'level' AS c_mktsegment", "500D AS c_acctbal"
    )
    alone = balances.where("c_custkey = 7").withColumn("c_mktsegment", F.lit("alone"))
    density = distribution.grouped_density(
        balances.unionAll(level).unionAll(alone), "c_mktsegment", "c_acctbal"
    )
    return _rounded(density, {"x": 6, "bandwidth": 6, "density": 12})


@_query
def boxplot_stats(spark, sf_dir):
    boxes = distribution.boxplot_stats(
        table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice"
    )
    return _rounded(boxes, {"q1": 6, "median": 6, "q3": 6})


@_query
def boxplot_outliers(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return distribution.boxplot_outliers(events, "event_type", "value")


@_query
def ols_fit_by_group(spark, sf_dir):
    fit = regression.ols_fit_by_group(
        table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice"
    )
    return _rounded(fit, {"slope": 6, "intercept": 6})


@_query
def ols_band_by_group(spark, sf_dir):
    band = regression.ols_band_by_group(
        table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice"
    )
    return _rounded(band, {"x": 6, "fit": 5, "lower": 4, "upper": 4})


@_query
def ols_band_small_groups(spark, sf_dir):
    """Bands of groups with few rows, one to some dozens: the days of the first orders."""
    orders = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_custkey", "o_totalprice"
    )
    band = regression.ols_band_by_group(orders, "day", "o_custkey", "o_totalprice", points=3)
    return _rounded(band, {"x": 6, "fit": 4, "lower": 3, "upper": 3})


@_query
def ols_residuals(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    residuals = regression.ols_residuals(lines, "l_quantity", "l_extendedprice")
    return _rounded(residuals, {"residual": 4})


@_query
def residual_chain(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000).alias("x")
    )
    chained = regression.residual_chain(lines, "x", "l_quantity").drop("x")
    return _rounded(chained, {"transformed": 5})


# --- checks


@_query
def columns_all_equal(spark, sf_dir):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    compared = checks.columns_all_equal(
        table(spark, sf_dir, "lineitem"), price * (1 - discount), price - price * discount
    )
    return _rounded(compared, {"mean_difference": 20})


@_query
def consecutive_ratio(spark, sf_dir):
    """Month over month order totals per customer segment; the orders are read once."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    monthly = staged(
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", month)
        .agg(F.sum("o_totalprice").alias("total")),
        "monthly",
    ).withColumn("month", F.date_format("month", "yyyy-MM"))
    ratios = series.consecutive_ratio(
        monthly, "c_mktsegment", "month", "total", chunk=F.substring("month", 1, 4)
    )
    return _rounded(ratios, {"total": 2, "ratio": 8})


@_query
def consecutive_ratio_unchunked(spark, sf_dir):
    """Value over value per event type along the event numbers."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return _rounded(series.consecutive_ratio(events, "event_type", "event_id", "value"), {"ratio": 8})


@_query
def consecutive_ratio_by_text(spark, sf_dir):
    """Price over price along the names of the parts of a size."""
    parts = table(spark, sf_dir, "part").select(
        "p_size", F.format_string("part %09d é", "p_partkey").alias("name"), "p_retailprice"
    )
    return _rounded(series.consecutive_ratio(parts, "p_size", "name", "p_retailprice"), {"ratio": 8})


@_query
def consecutive_ratio_by_time_text(spark, sf_dir):
    """Value over value per event type along ISO time texts."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    at = F.concat_ws("#", iso, F.format_string("%012d", "event_id")).alias("at")
    events = table(spark, sf_dir, "events").select("event_type", at, "value")
    return _rounded(series.consecutive_ratio(events, "event_type", "at", "value"), {"ratio": 8})


@_query
def bubble_table(spark, sf_dir):
    """Customers by balance and nation, sized by their number of orders."""
    per_customer = counting.group_count(
        table(spark, sf_dir, "orders"), "o_custkey", name="n_orders"
    )
    enriched = joins.left_join_enrich(
        table(spark, sf_dir, "customer"), per_customer, "c_custkey", "o_custkey"
    ).withColumn("standing", label_if_else(F.col("c_acctbal") > 0, "credit", "debt"))
    return counting.bubble_table(
        enriched, "c_name", "c_acctbal", "c_nationkey", "standing", "n_orders"
    )


@_query
def replication_rate(spark, sf_dir):
    """Map-side growth of the modes job, the purchase count and the term count."""
    listed = articles(spark, sf_dir)
    described = listed.drop("article_id")
    fields = ["prod_name", "section_name", "department_name"]
    bought = transactions(spark, sf_dir).select("customer_id", "article_id")
    people = customers(spark, sf_dir).select("customer_id", "postal_code", "age")
    wanted = filters.member_of(listed, "department_name", DEPARTMENTS).select("article_id")
    older = filters.filter_guarded_numeric(people, "age", OLDER_THAN, "double").select("customer_id")
    docs = _documents(spark, sf_dir, "lang", "text")

    per_field = ranking.unpivot_values(described, "garment_group_name", fields)
    per_term = terms.tokenize(docs, "text", distinct=True, keep=["lang"])
    sides = checks.MapSide
    rates = checks.replication_rate(
        [
            ("modes: one row per field", [sides(described, per_field)]),
            ("purchases: filter and tag", [sides(listed, wanted), sides(bought, bought), sides(people, older)]),
            ("terms: one row per term", [sides(docs, per_term)]),
        ]
    )
    return _rounded(rates, {"rate": 8})


@_query
def json_field_count(spark, sf_dir):
    """Events per value of an integer field inside a JSON text column."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return counting.group_count(table(spark, sf_dir, "events").select(k.alias("k")), "k")


for _name in ("label_if_else", "parse_flag"):
    _QUERIES[_name] = _QUERIES.pop(f"{_name}_query")


@_query
def json_fields(spark, sf_dir):
    """Typed fields of nested event records, some of them broken or of another type."""
    size = F.when(F.col("event_id") % 5 == 0, F.lit("many")).otherwise(F.col("value").cast("string"))
    user = F.struct(F.col("user_id").alias("id"), F.array("event_type", F.lit("all")).alias("tags"))
    whole = F.to_json(F.struct("event_id", size.alias("size"), user.alias("user")))
    whole = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), whole)).otherwise(whole)
    records = table(spark, sf_dir, "events").select("event_id", whole.alias("record"))
    fields = {
        "size": ("$.size", "double"),
        "user": ("$.user.id", "bigint"),
        "tag": ("$.user.tags[0]", "string"),
        "absent": ("$.user.name", "string"),
    }
    return documents.json_fields(records, "record", fields).drop("record")
