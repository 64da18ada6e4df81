import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import checks


def values(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "v double")


def test_guard_passes_and_fails_by_step(spark):
    df = values(spark, 0.0015, 0.0, None)
    steps = [(0.001, 1), (0.002, 2)]
    assert rows(checks.min_count_check(df, "v", steps)) == [
        (1, 0.001, 1, 1, True),
        (2, 0.002, 2, 0, False),
    ]
    assert checks.require_min_counts(df, "v", steps[:1]).count() == 3
    guarded = checks.require_min_counts(df, "v", steps)
    with pytest.raises(Exception, match=r"step 2 requires 2 observation\(s\) with value >= 0.002"):
        guarded.collect()


@pytest.mark.parametrize(
    "pairs, identical, equal",
    [
        ([(1.0, 1 + 1e-10)], False, True),
        ([(1.0, 1.0), (2.0, 2.0)], True, True),
        ([(1.0, 1.0), (2.0, 2.1)], False, False),
        ([(0.0, 1e-9)], False, True),
        ([(None, None), (1.0, 1.0)], True, True),
        ([(None, 1.0), (1.0, 1.0)], False, False),
    ],
)
def test_exact_and_tolerant_equality(spark, pairs, identical, equal):
    df = spark.createDataFrame(pairs, "a double, b double")
    got = checks.columns_all_equal(df, F.col("a"), F.col("b")).first()
    assert (got.all_identical, got.all_equal) == (identical, equal)


def test_replication_rate(spark):
    one = spark.createDataFrame([("ab", 1), (None, 22)], "a string, b int")
    thrice = one.select("a", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("copy")).select("a")
    none = one.where("b > 99")
    steps = [
        ("expand", [checks.MapSide(one, thrice)]),
        ("nothing read", [checks.MapSide(none, none.select("a"))]),
        ("two tables", [checks.MapSide(one, one.where("b > 9").select("b")), checks.MapSide(one.select("b"), one.select("b"))]),
    ]
    assert rows(checks.replication_rate(steps)) == [
        (1, "expand", 2, 6, 3.0, 5 + 6),
        (2, "nothing read", 0, 0, None, 0),
        (3, "two tables", 4, 3, 0.75, 5 + 2 + 3 + 3),
    ]
