import math

import numpy as np
import pandas as pd
import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.values import two_sided_t_95
from millrace.operators import checks, distribution, quantiles, ranges, regression, series

PROBS = [0.25, 0.5, 0.75]


@pytest.fixture(params=[2, 16, 256])
def limit(request, monkeypatch):
    """Cells of a part."""
    monkeypatch.setattr(quantiles, "CELLS", request.param)


def quantile_rows(df, probs=PROBS):
    values = quantiles.finite_values(df, "g", "v")
    sketch = quantiles.group_sketch(values, probs)
    return {r[0]: tuple(r)[1:] for r in quantiles.exact_quantiles(values, sketch, probs).collect()}


def expected(frame, probs=PROBS):
    frame = frame[np.isfinite(frame.v)]
    return {g: tuple(np.quantile(part.v, probs)) for g, part in frame.groupby("g", dropna=False)}


def assert_close(got, want):
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-12), g


def test_quartiles_of_four_values(spark, limit):
    df = spark.createDataFrame([("g", v) for v in (1.0, 2.0, 3.0, 10.0)], "g string, v double")
    assert quantile_rows(df) == {"g": (1.75, 2.5, 4.75)}


def test_quantiles_with_one_group_holding_most_rows(spark, limit):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(60000) < 0.7, "hot", rng.choice(["a", "b"], 60000)),
            "v": np.round(rng.lognormal(3, 1.5, 60000), 2),
        }
    )
    for probs in (PROBS, [0.0, 0.001, 0.9, 0.999, 1.0]):
        assert_close(quantile_rows(spark.createDataFrame(frame), probs), expected(frame, probs))


@pytest.mark.parametrize(
    "values",
    [
        [5.0] * 9000 + [7.0] * 3000,
        list(range(-4500, 4500)) + [1e300, -1e300],
        [0.0] * 20000,
        [1.5, float("nan"), float("inf"), None, 2.5],
        [4.0],
    ],
    ids=["ties", "extremes", "constant", "not-finite", "single"],
)
def test_quantiles_of_odd_groups(spark, limit, values):
    data = [("g", None if v is None else float(v)) for v in values]
    df = spark.createDataFrame(data, "g string, v double")
    kept = [v for v in values if v is not None and math.isfinite(v)]
    assert_close(quantile_rows(df), {"g": tuple(np.quantile(kept, PROBS))})


def test_quantiles_survive_a_useless_sketch(spark):
    """Brackets in the wrong place put the ranks into gaps, which are counted in their stead."""
    frame = pd.DataFrame({"g": ["x"] * 5000 + ["y"] * 10, "v": np.arange(5010.0)})
    values = quantiles.finite_values(spark.createDataFrame(frame), "g", "v")
    good = quantiles.group_sketch(values, PROBS)
    elsewhere = F.array(*[F.lit(-float(i)) for i in range(9, 3, -1)])
    wrong = F.when(F.col("g_ok"), F.col("ends")).otherwise(elsewhere)
    bad = good.withColumn("g_ok", F.col("grp") == "y").withColumn("ends", wrong).drop("g_ok")
    got = {r[0]: tuple(r)[1:] for r in quantiles.exact_quantiles(values, bad, PROBS).collect()}
    assert_close(got, expected(frame))


def test_a_heavy_tail_has_even_cells(spark):
    """Most values lie in a sliver of the range; cells go by rows, so none holds a large part."""
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"g": "x", "v": rng.pareto(0.3, 40000)})
    values = quantiles.finite_values(spark.createDataFrame(frame), "g", "v")
    sketch = quantiles.group_sketch(values, [0.5])
    wanted = quantiles._wanted_parts(values, sketch.withColumn("ends", F.array(F.lit(1e308), F.lit(1.1e308))), [0.5])
    cells = quantiles._count_cells(values, sketch.withColumn("ends", F.array(F.lit(1e308), F.lit(1.1e308))), wanted, 1)
    sizes = [r[1] for r in cells.groupBy("cell").agg(F.sum("n_rows")).collect()]
    assert sum(sizes) == 40000 and max(sizes) < 400
    assert_close(quantile_rows(spark.createDataFrame(frame), [0.5]), expected(frame, [0.5]))


def test_density_of_a_group_without_spread(spark):
    df = spark.createDataFrame([("same", 5.0)] * 3 + [("other", float(v)) for v in range(9)] + [("zero", 0.0)], "g string, v double")
    widths = {r.g: r.bandwidth for r in distribution.grouped_density(df, "g", "v").collect()}
    assert widths["same"] == pytest.approx(0.9 * 5 * 3**-0.2) and widths["zero"] == pytest.approx(0.9)
    assert all(r.density is not None for r in distribution.grouped_density(df, "g", "v").collect())


def test_null_group_is_a_group(spark, limit):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert quantile_rows(df) == {None: (1.5, 2.0, 2.5), "a": (5.0, 5.0, 5.0)}
    got = {r["g"]: r["outliers"] for r in distribution.boxplot_stats(df, "g", "v").collect()}
    assert got == {None: 0, "a": 0}


def test_boxplot_whiskers_are_observed_values(spark):
    df = spark.createDataFrame(
        [("g", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 100])], "g string, id int, v double"
    )
    box = distribution.boxplot_stats(df, "g", "v").first()
    assert (box.n, box.q1, box.median, box.q3) == (6, 2.25, 3.5, 4.75)
    assert (box.whisker_low, box.whisker_high, box.outliers) == (1.0, 5.0, 1)
    assert rows(distribution.boxplot_outliers(df, "g", "v")) == [("g", 5, 100.0)]


def test_density_integrates_to_one_and_matches_the_formula(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1, 400), [-12.0, 12.0]])
    frame = pd.DataFrame({"g": "a", "v": values})
    density = distribution.grouped_density(spark.createDataFrame(frame), "g", "v")
    got = density.toPandas().sort_values("point")
    assert len(got) == 512
    iqr = np.subtract(*np.quantile(values, [0.75, 0.25]))
    h = 0.9 * min(values.std(ddof=1), iqr / 1.34) * len(values) ** -0.2
    assert got.bandwidth.iloc[0] == pytest.approx(h)
    exact = np.exp(-0.5 * ((got.x.values[:, None] - values) / h) ** 2).sum(1) / (
        len(values) * h * math.sqrt(2 * math.pi)
    )
    assert np.abs(got.density.values - exact).max() < 2e-3
    assert np.trapezoid(got.density, got.x) == pytest.approx(1, abs=1e-2)


def fourier_density(values, first, last, points):
    """The curve by its definition: binned on the wide grid, multiplied after a Fourier transform."""
    iqr = np.subtract(*np.quantile(values, [0.75, 0.25]))
    h = 0.9 * min(values.std(ddof=1), iqr / 1.34) * len(values) ** -0.2
    n = max(512, 2 ** math.ceil(math.log2(points)))
    low, high = first - 4 * h, last + 4 * h
    place = (values - low) / ((high - low) / (n - 1))
    cell = np.floor(place).astype(int)
    binned = np.bincount(cell, cell + 1 - place, 2 * n) + np.bincount(cell + 1, place - cell, 2 * n)
    distance = np.linspace(0, 2 * (high - low), 2 * n)
    distance[n + 1 :] = -distance[n - 1 : 0 : -1]
    kernel = np.exp(-0.5 * (distance / h) ** 2) / (h * math.sqrt(2 * math.pi))
    smooth = np.fft.ifft(np.fft.fft(binned / len(values)) * np.conj(np.fft.fft(kernel))).real[:n]
    x = np.linspace(first, last, points)
    return x, np.interp(x, np.linspace(low, high, n), np.maximum(0, smooth))


@pytest.mark.parametrize("points", [512, 100, 700])
def test_density_is_the_convolution_on_the_wide_grid(spark, points):
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(40, 5, 300), "b": rng.gamma(2.0, 9.0, 2000), "few": np.array([3.0, 4.0, 11.0])}
    frame = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()])
    first, last = frame.v.min(), frame.v.max()
    got = distribution.grouped_density(spark.createDataFrame(frame), "g", "v", points).toPandas()
    for g, values in groups.items():
        curve = got[got.g == g].sort_values("point")
        x, density = fourier_density(values, first, last, points)
        np.testing.assert_allclose(curve.x, x, atol=1e-9)
        np.testing.assert_allclose(curve.density, density, atol=1e-9)


def test_fit_and_band(spark):
    rng = np.random.default_rng(7)
    x = rng.random(50) * 10
    y = 2 * x + 1 + rng.normal(0, 1, 50)
    frame = pd.DataFrame({"g": "a", "x": x, "y": y})
    few = pd.DataFrame({"g": "few", "x": [1.0, 2.0, 3.0], "y": [1.0, 2.0, 4.0]})
    df = spark.createDataFrame(pd.concat([frame, few]))
    slope, intercept = np.polyfit(x, y, 1)
    fit = {r.g: r for r in regression.ols_fit_by_group(df, "g", "x", "y").collect()}
    assert (fit["a"].slope, fit["a"].intercept, fit["a"].n) == pytest.approx((slope, intercept, 50))
    band = regression.ols_band_by_group(df, "g", "x", "y").toPandas()
    assert band.groupby("g").size().to_dict() == {"a": 80, "few": 80}
    few = band[band.g == "few"]
    assert few.lower.isna().all() == (int((df.toPandas().g == "few").sum()) < 3)
    a = band[band.g == "a"].sort_values("point")
    assert (a.x.min(), a.x.max()) == pytest.approx((x.min(), x.max()))
    s = math.sqrt(((y - slope * x - intercept) ** 2).sum() / 48)
    half = 2.0106347576 * s * np.sqrt(1 / 50 + (a.x - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
    assert np.allclose(a.upper - a.fit, half, rtol=1e-4)


def test_t_quantile(spark):
    df = spark.createDataFrame([(n,) for n in (-1, 0, 1, 2, 4, 9, 10, 30, 31, 44, 1000000)], "n int")
    got = [r[0] for r in df.orderBy("n").select(two_sided_t_95(F.col("n"))).collect()]
    assert got[:2] == [None, None]
    p = 0.95  # closed forms for 1, 2 and 4 degrees of freedom
    four = 2 * math.sqrt(math.cos(math.acos(math.sqrt(1 - p * p)) / 3) / math.sqrt(1 - p * p) - 1)
    assert got[2:5] == pytest.approx([math.tan(math.pi * p / 2), 2 * p * math.sqrt(1 / (2 * (1 - p * p))), four], rel=1e-12)
    assert got[5:] == pytest.approx([2.262157162740992, 2.2281388519649385, 2.0422724563012373, 2.0395134463964077, 2.0153675744437643, 1.95996635681594], abs=5e-8)


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(1)
    return spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=100), "z": rng.normal(size=100)}))


def residuals(x, z):
    slope, intercept = np.polyfit(z, x, 1)
    return x - (intercept + slope * z)


def test_residuals(spark, sample):
    frame = sample.toPandas()
    got = regression.ols_residuals(sample, "z", "x").toPandas()
    assert np.allclose(got.residual, residuals(frame.x, frame.z))
    assert got.residual.sum() == pytest.approx(0, abs=1e-9)
    constant = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "y double, x double")
    assert rows(regression.ols_residuals(constant, "x", "y").select("residual")) == [(-1.0,), (1.0,)]


def test_residual_chain_equals_the_unrolled_steps(sample):
    frame = sample.toPandas()
    x = frame.x.values
    x = 1 * np.sin(residuals(x, frame.z)) + 0.01
    x = 2 * np.sin(residuals(x, frame.z)) + 0.02
    x = 3 * np.sin(residuals(x, frame.z)) + 0.03
    x = 4 * np.sin(residuals(x, frame.z)) + 0.04
    got = regression.residual_chain(sample, "x", "z").toPandas()
    assert np.allclose(got.transformed, x, atol=1e-8)


def test_residual_chain_stops_at_the_failing_step(spark):
    df = spark.createDataFrame([(-1.0, 1.0), (-2.0, 2.0)], "x double, z double")
    with pytest.raises(Exception, match=r"step 1 requires 1 observation\(s\) with value >= 0.001"):
        regression.residual_chain(df, "x", "z").collect()
    df = spark.createDataFrame([(1.0, 1.0), (-2.0, 2.0)], "x double, z double")
    with pytest.raises(Exception, match=r"step 3 requires 3 observation\(s\) with value >= 0.003"):
        regression.residual_chain(df, "x", "z").collect()


def test_guards_run_nothing_while_they_are_built(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 4.0), (3.0, 5.0)], "x double, z double")
    context = spark.sparkContext
    context.setJobGroup("building", "guards")
    checks.require_min_counts(regression.residual_chain(df, "x", "z", steps=6), "x", [(0.5, 2)])
    assert list(context.statusTracker().getJobIdsForGroup("building")) == []
    context.setLocalProperty("spark.jobGroup.id", None)


def test_consecutive_ratio(spark):
    df = spark.createDataFrame(
        [("a", t, float(v)) for t, v in enumerate([1, 1, 2, 3, 5, 0, 8])]
        + [("b", 0, 4.0), (None, 1, 1.0), (None, 2, 3.0)],
        "k string, t int, v double",
    )
    plain = rows(series.consecutive_ratio(df, "k", "t", "v"))
    assert ("a", 3, 3.0, 5 / 3) in plain and ("a", 5, 0.0, None) in plain and ("a", 6, 8.0, None) in plain
    assert (None, 1, 1.0, 3.0) in plain
    for width in (1, 2, 3, 100):
        chunk = F.floor(F.col("t") / width)
        assert rows(series.consecutive_ratio(df, "k", "t", "v", chunk)) == plain


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp", "timestamp_ntz", "string"])
def test_long_series_are_cut_by_themselves(spark, monkeypatch, kind):
    order = {
        "int": "int(id * id)",
        "double": "double(id) / 7",
        "date": "date_add(date'2024-01-01', int(id))",
        "timestamp": "timestamp_seconds(id * id * 1000)",
        "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)",
        "string": "format_string('%04d', id)",
    }[kind]
    key = "IF(id % 3 = 0, 'other', 'hot')"
    many = spark.range(300).selectExpr(f"{key} AS k", f"{order} AS t", "double(id % 11) AS v")
    single = spark.range(5, 6).selectExpr("'single' AS k", f"{order} AS t", "1D AS v")
    df = many.unionAll(single)
    following = F.lead("v").over(Window.partitionBy("k").orderBy("t"))
    plain = rows(df.withColumn("ratio", F.try_divide(following, F.col("v"))))
    for size in (1, 20, 10**6):
        monkeypatch.setattr(series, "CHUNK_ROWS", size)
        assert rows(series.consecutive_ratio(df, "k", "t", "v")) == plain


def test_texts_of_any_kind_are_cut(spark, monkeypatch):
    monkeypatch.setattr(series, "CHUNK_ROWS", 1)
    names = ["", "a", "ab", "abc", "abcd é", "abcd 中", "abcd 𝒳", "abcd 𝒳x", None, "zz"]
    data = [("k", n, float(i + 1)) for i, n in enumerate(names)] + [("same", f"prefix {i:05d}", 1.0) for i in range(200)]
    df = spark.createDataFrame(data, "k string, t string, v double")
    cut = series.cut_series(df, "k", "t", 2).groupBy("k").agg(F.countDistinct("_chunk").alias("n")).collect()
    assert {r.k: r.n > 4 for r in cut} == {"k": True, "same": True}
    following = F.lead("v").over(Window.partitionBy("k").orderBy("t"))
    plain = rows(df.withColumn("ratio", F.try_divide(following, F.col("v"))))
    assert rows(series.consecutive_ratio(df, "k", "t", "v")) == plain


def test_two_million_rows_by_time_texts(spark):
    """One series holds nearly all rows; its texts differ only far behind what they share."""
    n = 2_000_000
    text = "date_format(timestamp_seconds(1700000000 + id * 3), \"yyyy-MM-dd'T'HH:mm:ss\")"
    df = spark.range(n).selectExpr("IF(id % 50 = 0, 'small', 'hot') AS k", f"{text} AS t", "double(id % 7 + 1) AS v")
    sizes = series.cut_series(df, "k", "t").groupBy("k", "_chunk").count().collect()
    hot = [r["count"] for r in sizes if r.k == "hot"]
    assert sum(r["count"] for r in sizes) == n
    assert max(hot) <= 2 * series.CHUNK_ROWS and 15 <= len(hot) <= 26
    got = series.consecutive_ratio(df, "k", "t", "v")
    following = F.lead("v").over(Window.partitionBy("k").orderBy("t"))
    want = df.withColumn("ratio", F.try_divide(following, F.col("v")))
    digest = F.sum(F.xxhash64("k", "t", "v", "ratio").cast("decimal(38,0)"))
    assert got.agg(digest).first() == want.agg(digest).first()


@pytest.mark.parametrize("kind", ["binary", "decimal(20,3)", "struct<a:int,b:string>", "boolean"])
def test_cut_points_of_other_types(spark, kind):
    made = {
        "binary": "cast(format_string('%05d', id) AS binary)",
        "decimal(20,3)": "cast(id / 8 AS decimal(20,3))",
        "struct<a:int,b:string>": "named_struct('a', int(id % 10), 'b', string(id))",
        "boolean": "id % 2 = 0",
    }[kind]
    df = spark.range(4000).selectExpr("id % 2 AS k", f"{made} AS o")
    cuts = {r.k: r._cuts for r in ranges.cut_points(df, ["k"], "o", 200).collect()}
    placed = df.join(ranges.cut_points(df, ["k"], "o", 200), "k")
    placed = placed.withColumn("n", ranges.range_number(F.col("_cuts"), F.col("o")))
    plain = placed.withColumn("want", F.size(F.filter("_cuts", lambda c: c <= F.col("o"))))
    assert plain.where("n <> want").count() == 0
    if kind != "boolean":
        assert all(8 <= len(c) <= 13 and c == sorted(c) for c in cuts.values())
        assert max(r["count"] for r in placed.groupBy("k", "n").count().collect()) <= 400


def test_range_number(spark):
    df = spark.sql("SELECT v, cuts FROM VALUES (array(1, 3, 3, 7)), (array()), (CAST(NULL AS array<int>)) AS c(cuts), "
                   "(VALUES (0), (1), (3), (6), (7), (9), (CAST(NULL AS int))) AS x(v)")  # fmt: skip
    for r in df.select("v", "cuts", ranges.range_number(F.col("cuts"), F.col("v")).alias("n")).collect():
        assert r.n == (0 if r.v is None else sum(c <= r.v for c in r.cuts or []))


def boxes(frame):
    """Boxplots and outliers by numpy."""
    found = {}
    for g, part in frame.groupby("g", dropna=False):
        q1, median, q3 = np.quantile(part.v, [0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part.v[(part.v >= low) & (part.v <= high)]
        found[g] = (len(part), q1, median, q3, inside.min(), inside.max(), len(part) - len(inside))
    return found


def odd_values():
    rng = np.random.default_rng(12)
    parts = {
        "normal": rng.normal(0, 1, 4000),
        "heavy": rng.standard_cauchy(3000),
        "ties": rng.integers(0, 4, 3000).astype(float),
        "one": np.full(500, 7.0),
        "mostly one": np.concatenate([np.zeros(900), rng.normal(0, 5, 100)]),
        "big": rng.normal(0, 1, 300) * 1e300,
        "few": np.array([1.0, 2.0, 100.0]),
        "single": np.array([3.5]),
    }
    return pd.DataFrame([(g, v) for g, values in parts.items() for v in values], columns=["g", "v"])


def assert_boxes(got, frame):
    want = boxes(frame)
    assert {r.g for r in got} == set(want)
    for r in got:
        assert tuple(r)[1:] == pytest.approx(want[r.g], rel=1e-12)


def test_boxplots_of_odd_groups(spark):
    frame = odd_values()
    df = spark.createDataFrame(frame).repartition(4)
    assert_boxes(distribution.boxplot_stats(df, "g", "v").collect(), frame)
    counts = {r.g: r["count"] for r in distribution.boxplot_outliers(df, "g", "v").groupBy("g").count().collect()}
    assert counts == {g: box[-1] for g, box in boxes(frame).items() if box[-1]}


def test_boxplots_survive_a_useless_sketch(spark, monkeypatch):
    """The cuts decide how much is read again, never the result."""
    frame = odd_values()
    honest = quantiles.group_sketch
    wrong = F.array(*[F.lit(float(x)) for x in (-3, -2, 0, 0, 1, 400)])
    monkeypatch.setattr(distribution, "group_sketch", lambda *a: honest(*a).withColumn("ends", wrong))
    assert_boxes(distribution.boxplot_stats(spark.createDataFrame(frame), "g", "v").collect(), frame)


@pytest.mark.parametrize("operator", [distribution.boxplot_stats, distribution.boxplot_outliers])
def test_boxplots_read_their_values_three_times(spark, monkeypatch, tmp_path, operator):
    from millrace.operators import histogram

    path = str(tmp_path / "values")
    spark.createDataFrame(odd_values()).write.parquet(path)
    reads = []

    def watched(df, name, staged=histogram.staged):
        reads.append(plan_of(df).count(path))
        return staged(df, name)

    for module in (histogram, distribution, quantiles):
        monkeypatch.setattr(module, "staged", watched)
    reads.append(plan_of(operator(spark.read.parquet(path), "g", "v")).count(path))
    assert sum(map(bool, reads)) <= 3 and sum(reads) <= 3 * max(reads)
