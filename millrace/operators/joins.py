"""Semi-joins, star joins and enrichment.

No join is hinted. The planner broadcasts a side whose size is below its
threshold and shuffles otherwise; hot keys are split at run time, or ahead of an outer join,
which cannot split both sides. Where a count
follows, rows are counted per key before the join that key takes part in, so a
key that owns a third of the rows arrives as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

# Rows of a key on one side of an outer join from which on it is dealt out, in parts of this size.
HOT_ROWS = 500_000
# Keys of a side that are dealt out at most, and keys that the sketch follows: it finds every key with
# more than about four rows in the number of followed keys.
HOT_KEYS = 1_000
TRACKED_KEYS = 50_000
# Pairs of a key, left rows times right rows, from which on it is dealt out as well, in cells of this many: what
# a join has to emit does not show in the bytes it reads. Tasks for such cells at most; more cells share them.
HOT_PAIRS = 4_000_000
MOST_TASKS = 10_000
# Copies of a side's rows on average, above which they are spread over tasks first, as a small table may be one task,
# and copies that a task then makes.
MANY_COPIES = 4
COPIED_ROWS = 4_000_000


def semi_join_count(
    transactions: DataFrame,
    articles: DataFrame,
    customers: DataFrame,
    article: str = "article_id",
    customer: str = "customer_id",
    name: str = "count_transactions",
) -> DataFrame:
    """Transactions per customer, only for listed articles and customers.

    ``articles`` and ``customers`` are the already filtered sides; an article or
    customer listed twice does not count twice.
    """
    bought = transactions.join(articles.select(article), article, "left_semi")
    counts = bought.groupBy(customer).agg(F.count(F.lit(1)).alias(name))
    return counts.join(customers.select(customer), customer, "left_semi")


def star_join_count(
    transactions: DataFrame,
    articles: DataFrame,
    customers: DataFrame,
    article: str = "article_id",
    customer: str = "customer_id",
    counted: str = "t_dat",
    name: str = "count_transactions",
    headers: DataFrame | None = None,
    header: str = "order_id",
) -> DataFrame:
    """Inner three-table join, ``count(counted)`` per customer, largest first.

    As in any inner join, an article or customer listed twice counts twice. Transactions
    that name their customer in a header table (``headers``: ``header``, ``customer``) meet
    the articles first, so only what is left of them meets the headers.
    """
    bought = transactions.join(articles.select(article), article)
    if headers is not None:
        bought = bought.join(headers.select(header, customer), header)
    per_customer = bought.groupBy(customer).agg(F.count(counted).alias("n"))
    return (
        per_customer.join(customers.select(customer), customer)
        .groupBy(customer)
        .agg(F.sum("n").alias(name))
        .orderBy(F.desc(name), F.asc(customer))
    )


def first_rows(df: DataFrame, order: list[Column], rows: int = 20) -> DataFrame:
    """The first rows of a sorted result."""
    return df.orderBy(*order).limit(rows)


def left_join_enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer join on differently named keys.

    Every left row stays, repeated keys included; without a partner the right
    columns are NULL. The right key is dropped; another right column whose name the
    left side has too gets ``_right`` behind it.

    Keys with ``HOT_ROWS`` rows or more on a side, missing ones on the left among them, and keys with more
    than ``HOT_PAIRS`` pairs are found by a sketch of each side first. A hot key is dealt out over a grid:
    its left rows over as many lines, its right rows over as many columns as its rows or pairs ask for, and
    each row goes to all cells of its line or column. Other keys have a grid of one cell, so one join serves
    all. Where pairs ask for it there is a task per cell, however few bytes the cells are, and a side whose
    rows go to more than ``MANY_COPIES`` cells on average is spread over tasks before.
    """
    taken = {c.lower() for c in left.columns}
    own = free_name("right_key", taken)
    renamed = {
        f.name: own if f.name == right_key else f"{f.name}_right" if f.name.lower() in taken else f.name
        for f in right.schema
    }
    right = right.select(*[F.col(f"`{old}`").alias(new) for old, new in renamed.items()])
    right = right.where(F.col(own).isNotNull())
    # both keys in the type that they are compared in
    kind = left.select(F.col(f"`{left_key}`")).unionAll(right.select(own)).schema[0].dataType
    left_hash, right_hash = (F.xxhash64(F.col(f"`{c}`").cast(kind)) for c in (left_key, own))
    grids = staged(_hot_grids(left, left_hash, right, right_hash), "hot-keys")
    same = F.col(f"`{left_key}`") == F.col(own)
    all_cells = F.sum(F.col("_lines").cast("bigint") * F.col("_columns"))
    copies = [F.sum(name).alias(name) for name in ("_left_copies", "_right_copies")]
    sizes = [F.max(name).alias(name) for name in ("_left_rows", "_right_rows")]
    total = grids.agg(F.max("_by_pairs").alias("by_pairs"), all_cells.alias("cells"), *copies, *sizes).first()
    if total["cells"] is None:
        return left.join(right, same, "left").drop(own)

    usual = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if total["by_pairs"]:
        left, right = (
            _spread(side, total[f"_{name}_rows"], total[f"_{name}_copies"], usual)
            for side, name in ((left, "left"), (right, "right"))
        )

    # 2 * HOT_KEYS rows at most
    grids = grids.select("_hot", "_lines", "_columns")
    key, line, column, cells, found = (
        free_name(n, taken | set(right.columns)) for n in ("left_key", "line", "column", "cells", "found")
    )
    none = F.array(F.lit(0))
    dealt_left = (
        left.join(F.broadcast(grids), left_hash == F.col("_hot"), "left")
        .withColumn(key, F.col(f"`{left_key}`").cast(kind))
        .withColumn(line, F.coalesce(F.pmod(_row_hash(left), F.col("_lines")), F.lit(0)).cast("int"))
        .withColumn(cells, F.coalesce("_columns", F.lit(1)))
        .withColumn(column, F.explode(F.coalesce(F.sequence(F.lit(0), F.col("_columns") - 1), none)))
        .drop("_hot", "_lines", "_columns")
    )
    own_line, own_column = f"{line}_right", f"{column}_right"
    dealt_right = (
        right.join(F.broadcast(grids), right_hash == F.col("_hot"), "left")
        .withColumn(own_column, F.coalesce(F.pmod(_row_hash(right), F.col("_columns")), F.lit(0)).cast("int"))
        .withColumn(own_line, F.explode(F.coalesce(F.sequence(F.lit(0), F.col("_lines") - 1), none)))
        .withColumn(own, F.col(own).cast(kind))
        .withColumn(found, F.lit(True))
        .drop("_hot", "_lines", "_columns")
    )
    if total["by_pairs"]:  # a number of tasks of its own, as the planner merges small partitions or broadcasts them
        tasks = max(usual, min(total["cells"], MOST_TASKS))
        dealt_left = dealt_left.repartition(tasks, key, line, column)
        dealt_right = dealt_right.repartition(tasks, own, own_line, own_column)
    cell = (F.col(key) == F.col(own)) & (F.col(line) == F.col(own_line)) & (F.col(column) == F.col(own_column))
    joined = dealt_left.join(dealt_right, cell, "left")
    # a key with several columns has right rows, though maybe none in this cell
    kept = joined.where(F.col(found) | (F.col(cells) == 1))
    return kept.drop(key, own, line, column, cells, found, own_line, own_column)


def free_name(name: str, taken: set[str]) -> str:
    """``name`` between underscores, with more of them while it is taken."""
    name = f"_{name}_"
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _spread(df: DataFrame, n: int, copies: int, most: int) -> DataFrame:
    """``df`` over ``most`` tasks at most if many more copies than its ``n`` rows are to be made of them."""
    tasks = min(most, -(-copies // COPIED_ROWS))
    return df.repartition(tasks) if tasks > 1 and copies > MANY_COPIES * n else df


def _row_hash(df: DataFrame) -> Column:
    """A hash over all columns that have one, the same whenever a task runs again."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return F.xxhash64(*[F.col(f"`{n}`") for n, k in kinds.items() if "map<" not in k and "variant" not in k])


def _hot_grids(left: DataFrame, left_hash: Column, right: DataFrame, right_hash: Column) -> DataFrame:
    """``(_hot, _lines, _columns, _by_pairs)`` per hot key hash, ``HOT_KEYS`` a side at most.

    ``_by_pairs`` says that the key has more than ``HOT_PAIRS`` pairs. ``_left_copies`` and ``_right_copies`` are
    made of the key's rows, ``_left_rows`` and ``_right_rows`` are those of all keys.
    """

    def top(df: DataFrame, key: Column, n: str) -> DataFrame:
        sketch = F.expr(f"approx_top_k(_hot, {HOT_KEYS}, {TRACKED_KEYS})")
        counted = df.select(key.alias("_hot")).agg(sketch.alias("top"), F.count(F.lit(1)).alias("size"))
        listed = counted.select("size", F.inline("top")).toDF("size", "_hot", n)
        # of the rows that the sketch counts, some four in the number of followed keys may be others'
        sure = F.greatest(F.col(n) - 4 * F.col("size") / TRACKED_KEYS, F.lit(0.0))
        return listed.select("_hot", n, sure.alias(f"sure_{n}"), F.col("size").alias(f"all_{n}"))

    both = top(left, left_hash, "lefts").join(top(right, right_hash, "rights"), "_hot", "full")
    both = both.withColumn("parts", F.coalesce(F.col("sure_lefts") * F.col("sure_rights") / HOT_PAIRS, F.lit(0.0)))
    both = both.withColumn("_by_pairs", F.col("parts") > 1)
    # cells about as wide as high have the fewest rows in more than one of them
    high = F.ceil(F.sqrt(F.col("parts") * F.col("sure_lefts") / F.col("sure_rights")))
    lines = F.when(F.col("_by_pairs"), high).otherwise(1)
    columns = F.when(F.col("_by_pairs"), F.ceil(F.col("parts") / lines)).otherwise(1)
    lines, columns = (
        F.greatest(by_pairs, F.coalesce(F.ceil(F.col(n) / HOT_ROWS), F.lit(1))).cast("int").alias(name)
        for by_pairs, n, name in ((lines, "lefts", "_lines"), (columns, "rights", "_columns"))
    )
    hot = F.col("_by_pairs") | (F.col("lefts") >= HOT_ROWS) | (F.col("rights") >= HOT_ROWS)
    sizes = [
        (F.col("lefts") * F.col("_columns")).alias("_left_copies"),
        (F.col("rights") * F.col("_lines")).alias("_right_copies"),
        F.col("all_lefts").alias("_left_rows"),
        F.col("all_rights").alias("_right_rows"),
    ]
    grids = both.where(hot).select("*", lines, columns)
    return grids.select("_hot", "_lines", "_columns", "_by_pairs", *sizes)
