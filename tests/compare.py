"""Run registered queries against their SQL counterparts.

``python tests/compare.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) or (a != a and b != b)
    return a == b


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """Row count and the differences in schema or values, none if both agree."""
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in result.description}
    duck_rows = result.fetchall()
    names = sorted(df.columns)
    problems = []
    if names != sorted(duck_types):
        return 0, [f"columns {names} against {sorted(duck_types)}"]
    for name, kind in df.dtypes:
        if SPARK_TO_DUCK.get(kind, kind) != duck_types[name]:
            problems.append(f"{name}: {kind} against {duck_types[name]}")
    order = [list(duck_types).index(n) for n in names]
    right = sorted((tuple(r[i] for i in order) for r in duck_rows), key=_key)
    left = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows against {len(right)}")
    differing = [
        (a, b) for a, b in zip(left, right) if not all(_same(x, y) for x, y in zip(a, b))
    ]
    if differing:
        problems.append(f"{len(differing)} rows differ, first {str(differing[0])[:400]}")
    return len(left), problems


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/millrace-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = contract.oracle_sql()
    wanted = sys.argv[2:] or [name for name in contract.queries() if name in oracle]
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            rows, problems = compare(contract.queries()[name](spark, sf_dir), con, oracle[name])
        except Exception as error:  # report and go on with the next query
            rows, problems = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name:26} {rows:7} rows {time.time() - start:6.2f}s", *problems)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
