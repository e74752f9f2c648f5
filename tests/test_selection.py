import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import selection
from ledgerwatch.operators.selection import OrderStatistics, exact_quantiles, pick_smallest_hashes

PROBS = [0, 0.001, 0.25, 0.5, 0.75, 0.9, 1]


@pytest.fixture
def small_fetch(monkeypatch):
    monkeypatch.setattr(selection, "FETCH_ROWS", 16)
    monkeypatch.setattr(selection, "BUCKETS", 8)


def skewed(n=4000):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "a": rng.normal(size=n),
            "tied": np.where(rng.random(n) < 0.4, 1.5, rng.exponential(50, n)),
            "wide": rng.normal(size=n) * 10.0 ** rng.integers(-200, 200, n),
            "one": np.full(n, 7.0),
            "k": np.arange(n),
        }
    )
    pdf.loc[::7, "a"] = np.nan
    return pdf


def test_quantiles_equal_pandas(spark, small_fetch):
    pdf = skewed()
    found = exact_quantiles(spark.createDataFrame(pdf), ["a", "tied", "wide", "one"], PROBS)
    for c, values in found.items():
        np.testing.assert_allclose(values, pdf[c].quantile(PROBS), rtol=1e-9)


def test_infinities_are_extremes_and_nan_is_left_out(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0, 0.5, 1])["x"] == [float("-inf"), 1.0, float("inf")]


def test_empty_series_has_no_quantile(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.0]}


def test_weighted_ranks_count_copies(spark, small_fetch):
    df = spark.createDataFrame([(i, i % 5 + 1) for i in range(500)], "v long, w long")
    flat = sorted(v for v in range(500) for _ in range(v % 5 + 1))
    found = OrderStatistics(df, {"v": F.col("v")}, F.col("w")).locate({"v": [0, 700, len(flat) - 1]})
    assert [found["v", r].value for r in (0, 700, len(flat) - 1)] == [flat[0], flat[700], flat[-1]]
    at = found["v", 700]
    assert at.below == sum(v < at.value for v in flat) and at.at == flat.count(at.value)


def test_large_whole_numbers_stay_exact(spark, small_fetch):
    base = 2**60
    df = spark.createDataFrame([(base + i,) for i in range(300)], "v long")
    assert OrderStatistics(df, {"v": F.col("v")}).locate({"v": [150]})["v", 150].value == base + 150


def test_rank_outside_is_an_error(spark):
    with pytest.raises(ValueError, match="rank outside"):
        OrderStatistics(spark.range(3), {"id": F.col("id")}).locate({"id": [3]})


def test_hash_pick_is_exact_and_does_not_depend_on_partitions(spark, small_fetch):
    df = spark.createDataFrame(skewed())
    strata = {"tied": (F.col("tied") == 1.5, 333), "rest": (F.col("tied") != 1.5, 1001)}
    one = pick_smallest_hashes(df, ["k"], strata, 42)
    two = pick_smallest_hashes(df.repartition(7), ["k"], strata, 42)
    picked = {r["k"] for r in df.where(one).collect()}
    assert picked == {r["k"] for r in df.repartition(3).where(two).collect()}
    assert df.where(one & (F.col("tied") == 1.5)).count() == 333
    assert len(picked) == 333 + 1001


def test_hash_pick_rejects_a_repeated_key(spark):
    df = spark.range(100).withColumn("k", F.lit(1))
    with pytest.raises(ValueError, match="not unique"):
        pick_smallest_hashes(df, ["k"], {"all": (F.lit(True), 10)}, 42)


def counting(spark, pdf):
    """The rows and an accumulator that counts how often one is read."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    return spark.createDataFrame(pdf).withColumn("a", seen("a")), read


def test_quantiles_take_two_scans(spark):
    pdf = skewed(30_000)
    df, read = counting(spark, pdf)
    found = exact_quantiles(df, ["a", "tied", "wide", "k"], PROBS)
    for c, values in found.items():
        np.testing.assert_allclose(values, pdf[c].quantile(PROBS), rtol=1e-9)
    assert read.value == 2 * len(pdf)


def test_brackets_hold_few_rows(spark):
    pdf = pd.DataFrame({"v": np.random.default_rng(5).permutation(200_000)})
    stats = OrderStatistics(spark.createDataFrame(pdf), {"v": F.col("v")})
    it = selection._Interval(0, 0, 199_999, 0, 200_000, 200_000, [50_000, 50_001, 100_000])
    brackets = stats._brackets([it])
    assert [b.ranks for b in brackets] == [[50_000, 50_001], [100_000]]
    assert all(b.high - b.low < 6_000 for b in brackets)
    found = stats.locate({"v": [50_000, 50_001, 100_000]})
    assert [found["v", r].value for r in (50_000, 50_001, 100_000)] == [50_000, 50_001, 100_000]
    assert found["v", 100_000].below == 100_000


def test_a_rank_outside_its_bracket_is_still_found(spark, monkeypatch):
    stats = OrderStatistics(spark.range(9_000), {"v": F.col("id")})
    monkeypatch.setattr(OrderStatistics, "_brackets", lambda self, its: [selection._Interval(0, 10, 20, 0, 9_000, 9_000, [15, 5_000])])
    found = stats.locate({"v": [15, 5_000]})
    assert found["v", 15].value == 15 and found["v", 5_000].value == 5_000
