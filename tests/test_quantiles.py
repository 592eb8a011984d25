"""Exact distributed percentiles against NumPy's linear interpolation."""

import numpy as np
from hypothesis import given, settings, strategies as st

from marginflow.functions.quantiles import exact_percentiles, percentiles_of

PS = [0.0, 0.05, 0.25, 0.5, 0.95, 0.98, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = {r.p: r.value for r in exact_percentiles(df, "x", PS).collect()}
    for p in PS:
        exp = float(np.percentile(np.array(values, dtype=float), p * 100))
        assert abs(got[p] - exp) <= 1e-9 * max(1.0, abs(exp)), (p, got[p], exp)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_small_integer_samples(spark, values):
    check(spark, values)


def test_skewed_sample_with_hot_value(spark):
    rng = np.random.default_rng(7)
    v = np.round(rng.lognormal(2, 2, 3000), 3)
    v[:1000] = 4.0
    check(spark, list(v))


def test_grouped_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", 10.0), ("b", float("nan"))],
                               "g string, x double")
    got = {(r.g, r.p): r.value for r in exact_percentiles(df, "x", [0.5], by=["g"]).collect()}
    assert got == {("a", 0.5): 2.0, ("b", 0.5): 10.0}


def test_null_group_and_many_groups(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 20000 = 7 THEN NULL ELSE id % 20000 END AS g",
                                        "CAST(id AS double) AS x")
    got = {r.g: r.value for r in exact_percentiles(df, "x", [0.5], by=["g"]).collect()}
    assert len(got) == 20_000 and got[None] == 10_007.0 and got[19_999] == 29_999.0


def test_extreme_values(spark):
    v = [0.0, -0.0, 5e-324, -5e-324, 1.0, np.nextafter(1, 2), np.nextafter(1, 0), -1.0, np.nextafter(-1, -2), 1e308,
         -1e308, 8.0, np.nextafter(8, 0), 2.0 ** -1022, 3.0, 3.0, 3.0, 1e-300, 7.999999999999999, 1e15, 1e15 + 0.125]
    check(spark, v)
    inf = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "x double")
    got = [r.value for r in exact_percentiles(inf, "x", [0.0, 0.5, 1.0]).orderBy("p").collect()]
    assert got == [float("-inf"), 1.0, float("inf")]


def test_no_exchange_carries_all_values_to_one_task(spark):
    """Before the running counts, every exchange follows a partial aggregate."""
    import contextlib
    import io
    df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS double) AS x")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        exact_percentiles(df, "x", [0.5], by=["g"]).explain()
    assert "SinglePartition" not in buf.getvalue()


def test_several_columns_at_once(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.lognormal(0, 3, 800), 4), rng.integers(-3, 3, 800).astype(float)
    rows = [(float(x), float(y) if i % 7 else None, None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    got = percentiles_of(df, {"a": ("a", PS), "b": (df["b"] * 2, [0.5, 0.1]), "none": ("c", [0.5])})
    kept = np.array([y for i, y in enumerate(b) if i % 7])
    assert np.allclose(got["a"], np.percentile(a, [p * 100 for p in PS]), rtol=1e-12)
    assert np.allclose(got["b"], np.percentile(2 * kept, [50, 10])) and got["none"] == [None]
