"""Stored sketches, heavy hitters, the fast density and quarantined CSV rows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.functions.heavy import term_counters, top_candidates
from marginflow.operators import explore, sketches
from marginflow.sources import files, schemas


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.lognormal(1, 2, 20_000), np.full(5_000, 3.0)])
    rows = [(int(i % 5), float(v), int(i % 3000)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows + [(0, None, None), (1, float("nan"), None), (9, None, None)], "day int, x double, id int").cache(), x


def test_merged_quantile_sketches_keep_their_rank_error(spark, values, tmpdir_path):
    df, x = values
    sketches.quantile_sketches(df, ["x"], ["day"], k=400).write.parquet(tmpdir_path + "/s")
    stored = spark.read.parquet(tmpdir_path + "/s")
    assert stored.count() == 5                                       # the day without values has no row
    got = sketches.sketch_quantiles(sketches.merge_quantiles(stored), [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]).collect()
    assert len(got) == 6 and all(r.n == len(x) for r in got)
    for r in got:
        below, upto = (x < r.value).mean(), (x <= r.value).mean()
        assert below - 2 * sketches.rank_error(400) <= r.p <= upto + 2 * sketches.rank_error(400)


def test_unions_of_distinct_sketches_agree(spark, values):
    df, _ = values

    def union(by):
        parts = sketches.distinct_sketches(df.withColumn("part", by), ["id", "day"], ["part"])
        return {r.metric: r.distinct for r in sketches.distinct_estimates(sketches.merge_distinct(parts)).collect()}

    found, other = union(F.col("day")), union(F.pmod(F.xxhash64("x"), F.lit(9)))
    assert abs(found["id"] - other["id"]) <= 4 * sketches.distinct_error() * 3000 and found["day"] == other["day"]
    assert abs(found["id"] - 3000) <= 4 * sketches.distinct_error() * 3000 and found["day"] == 6


@pytest.mark.parametrize("counters", [2, 8, 1000])
def test_top_candidates_hold_the_top(spark, counters):
    rng = np.random.default_rng(counters)
    docs = [[f"t{min(int(v), 60)}" for v in rng.geometric(0.08, 12)] + ["all"] for _ in range(300)] + [None, [], [None, "all"]]
    df = spark.createDataFrame([(d,) for d in docs], "terms array<string>").repartition(5)
    exact = Counter(t for d in docs for t in d or () if t is not None)
    cut = sorted(exact.values(), reverse=True)[9]
    got = {r.term for r in top_candidates(df, "terms", 10, counters).collect()}
    assert {t for t, n in exact.items() if n >= cut} <= got
    sums = term_counters(df, "terms", counters).groupBy("term").agg(F.sum("low").alias("low")).collect()
    low = {r.term: r.low for r in sums}
    assert all(low.get(t, 0) <= n <= low.get(t, 0) + low[None] for t, n in exact.items())
    assert len(low) <= 5 * 2 * counters + 1 + 5 * 14                 # the bound, beside a batch's own


def test_flat_counts_and_few_terms(spark):
    df = spark.createDataFrame([([f"t{i}"],) for i in range(40)], "terms array<string>").repartition(3)
    assert top_candidates(df, "terms", 5, counters=1).count() == 40  # all are ties
    assert top_candidates(df, "terms", 50, counters=1).count() == 40
    assert top_candidates(df.where("false"), "terms", 5).count() == 0


def test_fast_density_is_within_its_error(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, 3000), rng.normal(50, 0.1, 20), [500.0]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double").repartition(3)
    exact = {r.point: r.density for r in explore.kde_exact(df, "x").collect()}
    h = x.std(ddof=1) * len(x) ** -0.2
    for error in (1e-3, 1e-12):
        got = explore.kde(df, "x", error=error).collect()
        assert len(got) == 200
        bound = error / (h * np.sqrt(2 * np.pi)) + 1e-14
        assert max(abs(r.density - exact[r.point]) for r in got) <= bound
    assert explore.hermite_terms(1e-3) < explore.hermite_terms(1e-12)
    flat = explore.kde(df.where("x = 500"), "x").collect()
    assert len(flat) == 200 and all(r.density is None for r in flat)


def test_density_moments_of_parts_add_up(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(0, 3, 500)], "_x double").repartition(4)
    whole = {r.cell: tuple(r)[1:] for r in explore.density_moments(df, -10.0, 0.7).collect()}
    parts = [explore.density_moments(df.where(c), -10.0, 0.7) for c in ("_x < 1", "_x >= 1")]
    both = parts[0].unionByName(parts[1]).groupBy("cell").agg(*[F.sum(c).alias(c) for c in parts[0].columns[1:]])
    assert all(np.allclose(tuple(r)[1:], whole[r.cell]) for r in both.collect())


CSV = ("VendorName,PerformanceTier\nA,Low Performer\nB\nC,Mid Performer,more\n\"D, Inc\",High Performer\n")


def test_quarantine_tells_good_rows_from_bad(spark, tmpdir_path):
    with open(tmpdir_path + "/a.csv", "w") as f:
        f.write(CSV)
    good, bad = files.read_csv_quarantined(spark, tmpdir_path + "/a.csv", schemas.TIER_REFERENCE)
    assert sorted(map(tuple, good.collect())) == [("A", "Low Performer"), ("D, Inc", "High Performer")]
    got = {r.line: r.reason for r in bad.collect()}
    assert got == {"B": "too few fields", "C,Mid Performer,more": "too many fields"}
    assert all(r.file.endswith("a.csv") for r in bad.collect())


def test_quarantine_of_types_and_encodings(spark, tmpdir_path):
    lines = ["Café,1,2,0,Cat,Sub", "x,one,2,0,Cat,Sub", "plain,1.5,,0,Cat,Sub", "y,1,2,nil,Cat,Sub"]
    with open(tmpdir_path + "/p.csv", "wb") as f:
        f.write(("Product Name,Sales,Profit,Discount,Category,Sub-Category\n" + "\n".join(lines) + "\n").encode("latin-1"))
    good, bad = files.read_csv_quarantined(spark, tmpdir_path + "/p.csv", schemas.PRODUCTS, "ISO-8859-1")
    assert sorted(r[0] for r in good.collect()) == ["Café", "plain"]
    assert sorted(r.reason for r in bad.collect()) == ["Discount: not double: nil", "Sales: not double: one"]
    good, bad = files.read_csv_quarantined(spark, tmpdir_path + "/p.csv", schemas.PRODUCTS)        # read as UTF-8
    assert [r[0] for r in good.collect()] == ["plain"]
    assert sorted(r.reason for r in bad.collect())[1] == "Product Name: not in the encoding"
    assert good.count() + bad.count() == len(lines)
