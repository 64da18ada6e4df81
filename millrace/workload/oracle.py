"""SQL counterparts of the registered queries, for DuckDB over the same tables.

They are written from what a query means and share no code with the operators,
apart from fixed values (delimiter patterns, t quantiles) and the parameters of the queries.
"""

from __future__ import annotations

from millrace.functions.text import DELIMITERS, DELIMITERS_KEEP_DIGITS
from millrace.functions.values import NORMAL_975, T_975
from millrace.workload.queries import DEPARTMENTS, OLDER_THAN, STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_STOP = "(" + ", ".join(_text(w) for w in STOP_WORDS) + ")"
_DEPARTMENTS = "(" + ", ".join(map(str, DEPARTMENTS)) + ")"


def _tokens(
    column: str,
    pattern: str = DELIMITERS,
    distinct: bool = True,
    stop: bool = False,
    source: str = "documents",
) -> str:
    """A subquery of (column, term) over documents."""
    kind = "DISTINCT" if distinct else ""
    words = f"unnest(string_split_regex(lower(text), {_text(pattern)}))"
    inner = f"SELECT {kind} doc_id AS id, {column}, {words} AS term FROM {source} AS src"
    keep = f" AND term NOT IN {_STOP}" if stop else ""
    return f"(SELECT {column}, term FROM ({inner}) WHERE term <> ''{keep})"


def _chi_square(category: str, pattern: str, stop: bool, source: str = "documents") -> str:
    """Common table expressions ending in ``scored``."""
    terms = _tokens(category, pattern, stop=stop, source=source)
    return f"""
    WITH pairs AS (SELECT {category} AS category, term, count(*) AS a FROM {terms} GROUP BY ALL),
    by_term AS (SELECT term, sum(a)::BIGINT AS docs_term FROM pairs GROUP BY term),
    by_category AS (
      SELECT {category} AS category, count(*) AS docs_category FROM {source} AS src GROUP BY 1),
    counted AS (
      SELECT category, term, a, docs_term - a AS b, docs_category - a AS c,
             (SELECT count(*) FROM documents) - docs_category - docs_term + a AS d
      FROM pairs JOIN by_term USING (term) JOIN by_category USING (category)),
    scored AS (
      SELECT category, term, a, b, c, d,
             round(pow(a::DOUBLE * d - b::DOUBLE * c, 2)
                   / nullif(a + b, 0)::DOUBLE / nullif(a + c, 0)::DOUBLE
                   / nullif(b + d, 0)::DOUBLE / nullif(c + d, 0)::DOUBLE, 10) AS score
      FROM counted)"""


def _top_terms(category: str, pattern: str, stop: bool, k: int, source: str = "documents") -> str:
    return (
        _chi_square(category, pattern, stop, source)
        + f""",
    ranked AS (
      SELECT category, term, score, row_number() OVER (
        PARTITION BY category ORDER BY score DESC, term) AS rank
      FROM scored WHERE score IS NOT NULL),
    top AS (SELECT * FROM ranked WHERE rank <= {k})"""
    )


_TERM_TEXT = "term || ':' || printf('%.10f', score)"

_ARTICLES = (
    "(SELECT p_type AS garment_group_name, p_name AS prod_name, p_brand AS section_name, "
    "p_size::VARCHAR AS department_name FROM part)"
)


def _modes(source: str, group: str, product: str, section: str, department: str, fallback: bool) -> str:
    def placed(column: str) -> str:
        return f"""
          SELECT {group} AS g, {column} AS v, row_number() OVER (
            PARTITION BY {group} ORDER BY count(*) DESC, {column}) AS place
          FROM {source} AS src GROUP BY {group}, {column}"""

    second = "coalesce(s2.v, s1.v)" if fallback else "s2.v"
    return f"""
    WITH p AS ({placed(product)}), s AS ({placed(section)}), d AS ({placed(department)})
    SELECT p.g AS {group}, p.v AS {product}, {second} AS {section}, d.v AS {department}
    FROM p
    JOIN d ON d.g = p.g AND d.place = 1
    JOIN s AS s1 ON s1.g = p.g AND s1.place = 1
    LEFT JOIN s AS s2 ON s2.g = p.g AND s2.place = 2
    WHERE p.place = 1"""


_STAR = f"""
    SELECT c_custkey AS customer_id, count(l_shipdate) AS count_transactions
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = l_partkey
    JOIN customer ON c_custkey = o_custkey
    WHERE p_size IN {_DEPARTMENTS} AND c_acctbal > {OLDER_THAN}
    GROUP BY c_custkey"""

_FENCES = """
    q AS (
      SELECT {g} AS g, count(*) AS n, quantile_cont({v}, 0.25) AS q1,
             quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3
      FROM {t} WHERE isfinite({v}) GROUP BY 1),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)"""

# The two ways to write the same price.
_LEFT, _RIGHT = "l_extendedprice * (1 - l_discount)", "l_extendedprice - l_extendedprice * l_discount"


def _residual_chain() -> str:
    ctes = [
        "s0 AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice / 1000 AS x FROM lineitem)"
    ]
    for i in range(1, 5):
        ctes.append(
            f"f{i} AS (SELECT regr_intercept(x, l_quantity) AS a, regr_slope(x, l_quantity) AS b FROM s{i - 1})"
        )
        ctes.append(
            f"s{i} AS (SELECT l_orderkey, l_linenumber, l_quantity, "
            f"{i} * sin(x - (a + b * l_quantity)) + 0.01::DOUBLE * {i} AS x FROM s{i - 1}, f{i})"
        )
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT l_orderkey, l_linenumber, l_quantity, "
        "round(x, 5) AS transformed FROM s4"
    )


# From 31 degrees of freedom on a series, up to 30 the tabulated values.
_Z = f"{NORMAL_975!r}::DOUBLE"
_T_QUANTILE = (
    f"CASE WHEN df > 30 THEN {_Z} + ({_Z}^3 + {_Z}) / (4 * df) "
    f"+ (5 * {_Z}^5 + 16 * {_Z}^3 + 3 * {_Z}) / (96 * df^2) "
    f"+ (3 * {_Z}^7 + 19 * {_Z}^5 + 17 * {_Z}^3 - 15 * {_Z}) / (384 * df^3) "
    f"+ (79 * {_Z}^9 + 776 * {_Z}^7 + 1482 * {_Z}^5 - 1920 * {_Z}^3 - 945 * {_Z}) / (92160 * df^4) "
    f"WHEN df >= 1 THEN ({T_975}::DOUBLE[])[df] END"
)


def _band(table: str, g: str, x: str, y: str, points: int, digits: tuple[int, int]) -> str:
    """A fit with its band; groups without spread or freedom have NULLs."""
    return f"""
            WITH m AS (
              SELECT {g} AS g, count(*)::DOUBLE AS n, count(*) - 2 AS df, avg({x}) AS mx, avg({y}) AS my,
                     var_pop({x}) * count(*) AS sxx, var_pop({y}) * count(*) AS syy,
                     covar_pop({y}, {x}) * count(*) AS sxy,
                     min({x})::DOUBLE AS lo, max({x})::DOUBLE AS hi
              FROM {table} GROUP BY 1),
            b AS (SELECT *, sxy / nullif(sxx, 0) AS b FROM m),
            e AS (SELECT *, CASE WHEN df > 0 THEN sqrt(greatest(syy - sxy * sxy / nullif(sxx, 0), 0) / df) END AS s,
                         {_T_QUANTILE} AS t FROM b),
            k AS (SELECT *, lo + point * (hi - lo) / {points - 1} AS x,
                         my + b * (lo + point * (hi - lo) / {points - 1} - mx) AS fit
                  FROM e, range({points}) AS grid(point))
            SELECT g AS {g}, point::INTEGER AS point, round(x, 6) AS x, round(fit, {digits[0]}) AS fit,
                   round(fit - t * s * sqrt(1 / n + pow(x - mx, 2) / nullif(sxx, 0)), {digits[1]}) AS lower,
                   round(fit + t * s * sqrt(1 / n + pow(x - mx, 2) / nullif(sxx, 0)), {digits[1]}) AS upper
            FROM k"""


_USERS = """
            SELECT c_custkey AS id, count(*) AS n_posts
            FROM customer JOIN orders ON o_custkey = c_custkey
            WHERE o_orderkey IN (SELECT user_id FROM events)
              AND o_orderkey IN (
                SELECT l_orderkey FROM lineitem GROUP BY l_linenumber, l_orderkey HAVING count(*) > 1)
            GROUP BY c_custkey"""

# Documents with categories that are missing, awkward or nothing but digits, as they are read
# and as they are after normalising.
_AWKWARD = """(SELECT doc_id, text, CASE doc_id % 7 WHEN 0 THEN '?' WHEN 1 THEN '' WHEN 2 THEN 'toys-games'
               WHEN 3 THEN 'toys-games' ELSE 'books-old' END AS category FROM documents)"""


def oracle_sql() -> dict[str, str]:
    """Query name to SQL."""
    sql = {
        "scan_json_lines": """
            SELECT text AS "reviewText", lang AS category,
                   CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS doc_id
            FROM documents""",
        "scan_csv_quoted": "SELECT * FROM customer",
        "csv_mixed_headers": """
            SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 < 2 THEN c_acctbal END AS balance,
                   CASE WHEN c_custkey % 3 < 2 THEN c_nationkey END::INTEGER AS nation
            FROM customer""",
        "scan_delimited_text": """
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
                   CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS o_orderdate,
                   CASE WHEN o_orderstatus <> 'F' THEN '"' || o_orderpriority || chr(1) || '"' END
                     AS o_orderpriority
            FROM orders
            UNION ALL
            SELECT NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderpriority LIKE '1%'""",
        "scan_csv_locale": """
            SELECT s_suppkey, s_name, s_nationkey,
                   CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS s_acctbal
            FROM supplier""",
        "load_table": "SELECT * FROM orders",
        "schema_report": "\nUNION ALL\n".join(
            f"SELECT {i}::INTEGER AS position, '{name}' AS name, '{kind}' AS type, "
            f"count({name}) AS present FROM lineitem"
            for i, (name, kind) in enumerate(
                [
                    ("l_orderkey", "bigint"),
                    ("l_partkey", "bigint"),
                    ("l_suppkey", "bigint"),
                    ("l_linenumber", "int"),
                    ("l_quantity", "double"),
                    ("l_extendedprice", "double"),
                    ("l_discount", "double"),
                    ("l_tax", "double"),
                    ("l_returnflag", "string"),
                    ("l_linestatus", "string"),
                    ("l_shipdate", "timestamp_ntz"),
                ],
                start=1,
            )
        ),
        "sink_text_roundtrip": _top_terms("lang", DELIMITERS, stop=False, k=75)
        + f"""
            SELECT category || chr(9) || string_agg({_TERM_TEXT}, ' ' ORDER BY term) AS value
            FROM top GROUP BY category""",
        "sink_csv_roundtrip": _modes(
            _ARTICLES, "garment_group_name", "prod_name", "section_name", "department_name", True
        ),
        "label_if_else": """
            SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'credit'
                                   WHEN c_acctbal <= 0 THEN 'debt' END AS label
            FROM customer""",
        "parse_flag": """
            SELECT CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS flag,
                   count(*) AS n
            FROM lineitem GROUP BY 1""",
        "filter_guarded_numeric": f"""
            SELECT c_custkey, floor(c_acctbal)::BIGINT::VARCHAR AS age
            FROM customer WHERE floor(c_acctbal) > {OLDER_THAN}""",
        "filter_complete_rows": """
            SELECT d.doc_id AS id, d.lang, l.quality, l.toxic
            FROM documents d JOIN labels l USING (doc_id)
            WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
        "min_count_check": """
            SELECT step::INTEGER AS step, threshold::DOUBLE AS threshold,
                   required::BIGINT AS required, observed, observed >= required AS passed
            FROM (
              SELECT step, threshold, required,
                     count(*) FILTER (WHERE l_extendedprice >= threshold) AS observed
              FROM lineitem, (VALUES (1, 1000, 1), (2, 20000, 100), (3, 40000, 1000),
                                     (4, 1000000, 1)) AS s(step, threshold, required)
              GROUP BY step, threshold, required)""",
        "users_active_posts": _USERS,
        "forum_tables": _USERS,
        "semi_join_count": f"""
            SELECT o_custkey AS customer_id, count(*) AS count_transactions
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey
            WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size IN {_DEPARTMENTS})
              AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > {OLDER_THAN})
            GROUP BY o_custkey""",
        "left_join_enrich": """
            SELECT d.doc_id AS id, d.lang, d.source, d.n_chars, l.quality, l.toxic
            FROM documents d LEFT JOIN labels l USING (doc_id)""",
        "left_join_enrich_repeated": """
            SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, c_name AS name_right
            FROM supplier LEFT JOIN customer ON c_nationkey = s_nationkey AND c_nationkey % 3 <> 0""",
        "sink_single_file": """
            SELECT l_returnflag || chr(9) || l_linestatus || chr(9) || count(*) AS value,
                   1::BIGINT AS n_files, true AS refused
            FROM lineitem GROUP BY l_returnflag, l_linestatus""",
        "term_report_files": _top_terms("category", DELIMITERS, stop=True, k=75, source=_AWKWARD)
        + f"""
            SELECT category || chr(9) || string_agg({_TERM_TEXT}, ' ' ORDER BY term) AS value
            FROM top GROUP BY category""",
        "q1_filtered_count": "SELECT count(*) AS n FROM part WHERE p_size = 7",
        "q2_group_count": (
            "SELECT c_nationkey AS postal_code, count(*) AS n FROM customer GROUP BY c_nationkey"
        ),
        "having_duplicates": """
            SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem
            GROUP BY l_orderkey, l_partkey HAVING count(*) > 1""",
        "q3_top_by_count": """
            SELECT p_type AS garment_group_name, p_name AS prod_name, n FROM (
              SELECT p_type, p_name, count(p_name) AS n, row_number() OVER (
                PARTITION BY p_type ORDER BY count(p_name) DESC, p_name) AS place
              FROM part GROUP BY p_type, p_name)
            WHERE place = 1""",
        "q3_first_by_name": """
            SELECT p_type AS garment_group_name, p_name AS prod_name FROM (
              SELECT p_type, p_name,
                     row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS place
              FROM part)
            WHERE place = 1""",
        "q4_star_join_count": _STAR,
        "q4_star_join_sql": _STAR,
        "top_customers": _STAR + " ORDER BY count_transactions DESC, customer_id LIMIT 20",
        "modes_per_group": _modes(
            _ARTICLES, "garment_group_name", "prod_name", "section_name", "department_name", True
        ),
        "modes_per_group_literal": _modes(
            "(SELECT o_custkey AS customer_id, o_orderpriority AS priority, o_orderstatus AS status, "
            "year(o_orderdate)::VARCHAR AS year FROM orders)",
            "customer_id",
            "priority",
            "status",
            "year",
            False,
        ),
        "tokens_filtered": f"SELECT DISTINCT doc_id, term FROM {_tokens('doc_id', stop=True)}",
        "normalize_category": """
            SELECT p_partkey, array_to_string(list_filter(
                     string_split_regex(lower(p_type || ' & ' || p_brand), '[^a-z]+'),
                     lambda x: x <> ''), '-') AS category
            FROM part""",
        "doc_freq_terms": f"SELECT term, count(*) AS n FROM {_tokens('doc_id')} GROUP BY term",
        "doc_freq_pairs": f"SELECT lang, term, count(*) AS n FROM {_tokens('lang')} GROUP BY ALL",
        "term_freq_pairs": f"""
            SELECT lang, term, count(*) AS n
            FROM {_tokens('lang', DELIMITERS_KEEP_DIGITS, distinct=False)} GROUP BY ALL""",
        "chi_square_scores": _chi_square("lang", DELIMITERS, stop=True)
        + " SELECT category, term, a, b, c, d, score FROM scored",
        "chi_square_top75": _top_terms("category", DELIMITERS, stop=True, k=75, source=_AWKWARD)
        + " SELECT category, rank::INTEGER AS rank, term, score FROM top",
        "chi_square_top150_text": _top_terms("source", DELIMITERS_KEEP_DIGITS, stop=False, k=150)
        + f"""
            SELECT category, string_agg({_TERM_TEXT}, ' ' ORDER BY rank) AS terms
            FROM top GROUP BY category""",
        "group_mean_sorted": """
            SELECT r_name, n_name, round(mean, 6) AS mean, n_values,
                   (row_number() OVER (PARTITION BY r_name ORDER BY mean, n_name))::INTEGER AS place
            FROM (
              SELECT r_name, n_name, avg(c_acctbal) AS mean, count(c_acctbal) AS n_values
              FROM customer JOIN nation ON n_nationkey = c_nationkey
              JOIN region ON r_regionkey = n_regionkey
              GROUP BY r_name, n_name)""",
        "bar_counts": """
            SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL""",
        "bar_shares": """
            SELECT c.l_returnflag, c.l_linestatus, c.n, round(c.n / t.total, 10) AS share
            FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL) c
            JOIN (SELECT l_returnflag, count(*) AS total FROM lineitem GROUP BY ALL) t
            USING (l_returnflag)""",
        "grouped_density": """
            WITH src AS (
              SELECT c_mktsegment, c_acctbal FROM customer
              UNION ALL SELECT 'level', 500 FROM customer WHERE c_custkey % 10 = 0
              UNION ALL SELECT 'alone', c_acctbal FROM customer WHERE c_custkey = 7),
            r AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM src WHERE isfinite(c_acctbal)),
            b AS (
              SELECT c_mktsegment, count(*) AS n,
                     0.9::DOUBLE * coalesce(
                       nullif(least(stddev_samp(c_acctbal),
                         (quantile_cont(c_acctbal, 0.75) - quantile_cont(c_acctbal, 0.25)) / 1.34), 0),
                       nullif(stddev_samp(c_acctbal), 0), nullif(abs(min(c_acctbal)), 0), 1)
                     * pow(count(*), -0.2) AS bandwidth
              FROM src WHERE isfinite(c_acctbal) GROUP BY c_mktsegment),
            g AS (SELECT *, lo - 4 * bandwidth AS start, (hi - lo + 8 * bandwidth) / 511 AS step,
                         2 * (hi - lo + 8 * bandwidth) / 1023 AS apart
                  FROM b, r),
            p AS (SELECT c_mktsegment, (c_acctbal - start) / step AS position,
                         least(floor((c_acctbal - start) / step), 510) AS bin
                  FROM src JOIN g USING (c_mktsegment) WHERE isfinite(c_acctbal)),
            w AS (
              SELECT c_mktsegment, bin, sum(weight) AS weight FROM (
                SELECT c_mktsegment, bin, 1 - (position - bin) AS weight FROM p
                UNION ALL SELECT c_mktsegment, bin + 1, position - bin FROM p)
              GROUP BY ALL),
            smooth AS (
              SELECT c_mktsegment, cell,
                     sum(weight * exp(-0.5 * pow((cell - bin) * apart / bandwidth, 2)))
                     / any_value(n * bandwidth * sqrt(2 * pi())) AS y
              FROM w JOIN g USING (c_mktsegment), range(512) AS cells(cell) GROUP BY ALL),
            places AS (
              SELECT c_mktsegment, point, lo + point * (hi - lo) / 511 AS x, bandwidth,
                     (lo + point * (hi - lo) / 511 - start) / step AS place
              FROM g, range(512) AS grid(point))
            SELECT c_mktsegment, point::INTEGER AS point, round(x, 6) AS x, round(bandwidth, 6) AS bandwidth,
                   round(l.y + (place - floor(place)) * (h.y - l.y), 12) AS density
            FROM places
            JOIN smooth l USING (c_mktsegment)
            JOIN smooth h USING (c_mktsegment)
            WHERE l.cell = floor(place) AND h.cell = floor(place) + 1""",
        "boxplot_stats": "WITH "
        + _FENCES.format(g="l_returnflag", v="l_extendedprice", t="lineitem")
        + """
            SELECT f.g AS l_returnflag, f.n, round(q1, 6) AS q1, round(q2, 6) AS median,
                   round(q3, 6) AS q3,
                   min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN low AND high)
                     AS whisker_low,
                   max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN low AND high)
                     AS whisker_high,
                   count(*) FILTER (WHERE l_extendedprice NOT BETWEEN low AND high) AS outliers
            FROM f JOIN lineitem ON l_returnflag = f.g
            GROUP BY f.g, f.n, q1, q2, q3""",
        "boxplot_outliers": "WITH "
        + _FENCES.format(g="event_type", v="value", t="events")
        + """
            SELECT event_id, event_type, value FROM events JOIN f ON f.g = event_type
            WHERE value NOT BETWEEN low AND high""",
        "ols_fit_by_group": """
            SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
                   round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
                   regr_count(l_extendedprice, l_quantity)::BIGINT AS n
            FROM lineitem GROUP BY l_returnflag""",
        "ols_band_by_group": _band("lineitem", "l_returnflag", "l_quantity", "l_extendedprice", 80, (5, 4)),
        "ols_band_small_groups": _band(
            "(SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, * FROM orders)", "day", "o_custkey",
            "o_totalprice", 3, (4, 3),
        ),
        "ols_residuals": """
            WITH f AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a,
                              regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
                   round(l_extendedprice - (a + b * l_quantity), 4) AS residual
            FROM lineitem, f""",
        "residual_chain": _residual_chain(),
        "columns_all_equal": f"""
            SELECT n_rows, n_equal, n_one_missing, round(diff, 20) AS mean_difference,
                   n_equal = n_rows AS all_identical, diff < 1.5e-8 AND n_one_missing = 0 AS all_equal
            FROM (
              SELECT count(*) AS n_rows, count(*) FILTER (WHERE l = r) AS n_equal,
                     count(*) FILTER (WHERE (l IS NULL) <> (r IS NULL)) AS n_one_missing,
                     coalesce(sum(abs(l - r)) FILTER (WHERE l <> r)
                              / sum(abs(l)) FILTER (WHERE l <> r), 0) AS diff
              FROM (SELECT {_LEFT} AS l, {_RIGHT} AS r FROM lineitem))""",
        "consecutive_ratio": """
            WITH monthly AS (
              SELECT c_mktsegment, strftime(o_orderdate, '%Y-%m') AS month,
                     sum(o_totalprice) AS total
              FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
            SELECT c_mktsegment, month, round(total, 2) AS total,
                   round(lead(total) OVER (PARTITION BY c_mktsegment ORDER BY month) / total, 8)
                     AS ratio
            FROM monthly""",
        "consecutive_ratio_unchunked": """
            SELECT event_id, event_type, value,
                   round(lead(value) OVER (PARTITION BY event_type ORDER BY event_id) / nullif(value, 0), 8)
                     AS ratio
            FROM events""",
        "consecutive_ratio_by_text": """
            SELECT p_size, 'part ' || printf('%09d', p_partkey) || ' é' AS name, p_retailprice,
                   round(lead(p_retailprice) OVER (PARTITION BY p_size ORDER BY p_partkey)
                         / nullif(p_retailprice, 0), 8) AS ratio
            FROM part""",
        "consecutive_ratio_by_time_text": """
            SELECT event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '#' || printf('%012d', event_id) AS at, value,
                   round(lead(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) / nullif(value, 0), 8)
                     AS ratio
            FROM events""",
        "json_fields": """
            SELECT event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 0 THEN value END AS size,
                   CASE WHEN event_id % 7 <> 0 THEN user_id END AS user,
                   CASE WHEN event_id % 7 <> 0 THEN event_type END AS tag, NULL::VARCHAR AS absent
            FROM events""",
        "bubble_table": """
            SELECT c_name AS label, c_acctbal AS x, c_nationkey AS y,
                   CASE WHEN c_acctbal > 0 THEN 'credit' WHEN c_acctbal <= 0 THEN 'debt' END
                     AS "group",
                   n_orders AS size
            FROM customer
            JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)
              ON o_custkey = c_custkey
            WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL""",
        "replication_rate": f"""
            WITH parts AS (
              SELECT p_partkey::VARCHAR AS k, p_type AS g, p_name AS a, p_brand AS b,
                     p_size::VARCHAR AS c, p_size FROM part),
            fields AS (
              SELECT g, 'prod_name' AS f, a AS v FROM parts
              UNION ALL SELECT g, 'section_name', b FROM parts
              UNION ALL SELECT g, 'department_name', c FROM parts),
            sold AS (
              SELECT o_custkey::VARCHAR AS u, l_partkey::VARCHAR AS k
              FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
            people AS (SELECT c_custkey::VARCHAR AS u, c_nationkey::VARCHAR AS p,
                              c_acctbal::VARCHAR AS age, c_acctbal FROM customer),
            sides AS (
              SELECT 1 AS step, 'in' AS side, count(*) AS r,
                     sum(strlen(g) + strlen(a) + strlen(b) + strlen(c)) AS b FROM parts
              UNION ALL SELECT 1, 'out', count(*), sum(strlen(g) + strlen(f) + strlen(v)) FROM fields
              UNION ALL SELECT 2, 'in', count(*),
                     sum(strlen(k) + strlen(g) + strlen(a) + strlen(b) + strlen(c)) FROM parts
              UNION ALL SELECT 2, unnest(['in', 'out']), count(*), sum(strlen(u) + strlen(k)) FROM sold
              UNION ALL SELECT 2, 'in', count(*), sum(strlen(u) + strlen(p) + strlen(age)) FROM people
              UNION ALL SELECT 2, 'out', count(*), sum(strlen(k)) FROM parts
                     WHERE p_size IN {_DEPARTMENTS}
              UNION ALL SELECT 2, 'out', count(*), sum(strlen(u)) FROM people WHERE c_acctbal > {OLDER_THAN}
              UNION ALL SELECT 3, 'in', count(*), sum(strlen(lang) + strlen(text)) FROM documents
              UNION ALL SELECT 3, 'out', count(*), sum(strlen(lang) + strlen(term))
                     FROM {_tokens('lang')}),
            names(step, name) AS (VALUES
              (1, 'modes: one row per field'), (2, 'purchases: filter and tag'),
              (3, 'terms: one row per term'))
            SELECT step::INTEGER AS step, name,
                   (sum(r) FILTER (WHERE side = 'in'))::BIGINT AS records_in,
                   (sum(r) FILTER (WHERE side = 'out'))::BIGINT AS records_out,
                   round(sum(r) FILTER (WHERE side = 'out') / sum(r) FILTER (WHERE side = 'in'), 8)
                     AS rate,
                   sum(b)::BIGINT AS communication
            FROM sides JOIN names USING (step) GROUP BY step, name""",
        "json_field_count": """
            SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n
            FROM events GROUP BY 1""",
    }
    for name in ("q1_filtered_count", "q2_group_count", "q3_top_by_count"):
        sql[f"{name}_sql"] = sql[name]
    sql["mixed_input_semi_join"] = sql["semi_join_count"]
    sql["header_csv_bubbles"] = sql["bubble_table"]
    return {name: statement.strip() for name, statement in sql.items()}
