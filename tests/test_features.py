from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import features as fe
from ledgerwatch.operators import neighbours
from ledgerwatch.operators.neighbours import nearest_neighbours
from ledgerwatch.operators.smote import smote
from ledgerwatch.plans import training
from ledgerwatch.schemas import ENGINEERED, FEATURES, V_COLUMNS


def test_engineered_features(raw_df, raw_pdf):
    median = fe.fit_median_amount(raw_df)
    assert median == pytest.approx(raw_pdf["Amount"].median())
    out = fe.add_features(raw_df, median).toPandas()
    assert set(ENGINEERED) <= set(out.columns)
    assert out["hour_of_day"].between(0, 24).all()
    hour = (out["Time"] / 3600) % 24
    np.testing.assert_allclose(out["sin_hour"], np.sin(2 * np.pi * hour / 24), atol=1e-12)
    np.testing.assert_allclose(out["cos_hour"], np.cos(2 * np.pi * hour / 24), atol=1e-12)
    np.testing.assert_allclose(out["log_amount"], np.log1p(np.maximum(0, out["Amount"])))
    np.testing.assert_allclose(out["amount_ratio"], out["Amount"] / max(1.0, median))


def test_defaults_without_time_and_amount(spark):
    df = spark.createDataFrame([(1.0,)], "V1 double")
    assert fe.fit_median_amount(df) == 22.0
    row = fe.add_features(df, 22.0).first()
    assert [row[c] for c in ENGINEERED] == [12.0, 0.0, -1.0, 0.0, 1.0]


def test_negative_amount_and_time(spark):
    row = fe.add_features(spark.createDataFrame([(-3600.0, -5.0)], "Time double, Amount double"), 10.0).first()
    assert row["hour_of_day"] == 23.0 and row["log_amount"] == 0.0 and row["amount_ratio"] == -0.5


def test_split_sizes_of_the_published_data():
    assert fe.split_sizes({0: 283_253, 1: 473}, 0.2) == {0: 56_651, 1: 95}
    assert fe.split_sizes({0: 190, 1: 10}, 0.25) == {0: 47, 1: 3}


def test_split_partitions_the_input_and_is_stable(raw_df):
    keyed = raw_df.withColumn("k", F.col("Time"))
    train, test = fe.stratified_split(keyed, ["k"], 0.25)
    a, b = {r["k"] for r in train.collect()}, {r["k"] for r in test.collect()}
    assert len(a) == 150 and len(b) == 50 and not a & b
    assert {r["k"] for r in fe.stratified_split(keyed.repartition(5), ["k"], 0.25)[1].collect()} == b
    assert {r["k"] for r in fe.stratified_split(keyed, ["k"], 0.25, seed=7)[1].collect()} != b
    rate = [p.agg(F.avg("Class")).first()[0] for p in (train, test)]
    assert abs(rate[0] - rate[1]) < 0.05


def test_split_errors(raw_df):
    with pytest.raises(ValueError, match="no label column"):
        fe.stratified_split(raw_df.drop("Class"), ["Time"])
    with pytest.raises(ValueError, match="label other than"):
        fe.stratified_split(raw_df.withColumn("Class", F.lit(3)), ["Time"])


def test_scaling_is_exact_and_fitted_on_given_rows(raw_df, raw_pdf):
    df = raw_df.withColumn("flat", F.lit(4.0))
    scaled = fe.scale_features(df, fe.fit_robust_scaling(df, ["V1", "Amount", "flat"])).toPandas()
    for c in ("V1", "Amount"):
        q = raw_pdf[c].quantile([0.25, 0.5, 0.75]).tolist()
        np.testing.assert_allclose(scaled[c], (raw_pdf[c] - q[1]) / (q[2] - q[0]), rtol=1e-9, atol=1e-12)
    assert (scaled["flat"] == 0).all()


def test_prepared_parameters_come_from_train_only(spark, raw_df):
    prepared = training.prepare(raw_df, test_size=0.25)
    assert prepared.train.count() == 150 and prepared.test.count() == 50
    assert prepared.features == FEATURES and "Time" not in prepared.features
    train, _ = fe.stratified_split(fe.content_key(raw_df), ["row_key"], 0.25)
    median = fe.fit_median_amount(train)
    scaling = fe.fit_robust_scaling(fe.add_features(train, median), FEATURES)
    raw_row = train.orderBy("row_key").first()
    engineered = fe.add_features(train.where(F.col("row_key") == raw_row["row_key"]), median).first()
    got = prepared.train.where(F.col("row_key") == raw_row["row_key"]).first()["features"].toArray()
    want = [(engineered[c] - scaling.center[c]) / scaling.scale[c] for c in FEATURES]
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_balanced_weights(raw_df):
    assert fe.balanced_weights(raw_df) == {0: 200 / (2 * 180), 1: 200 / (2 * 20)}


@pytest.mark.parametrize("dims, rows, copies", [(3, 900, 300), (20, 300, 0)])
def test_neighbours_equal_brute_force_over_many_blocks(spark, monkeypatch, dims, rows, copies):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 30)
    monkeypatch.setattr(neighbours, "TURN_ROWS", 250)
    rng = np.random.default_rng(dims)
    x = np.round(rng.normal(size=(rows, dims)), 2)
    x[:copies] = x[0] + np.round(rng.normal(size=(copies, dims)) * 0.006, 2)  # a dense third
    df = spark.createDataFrame(pd.DataFrame({"k": range(rows), "v": list(x)}))
    found = nearest_neighbours(df, "k", "v", 5).collect()
    gap = neighbours._squared(x, x)
    np.fill_diagonal(gap, np.inf)
    want = np.argsort(gap, axis=1, kind="stable")[:, :5]
    assert {r["key"]: [n["key"] for n in r["neighbours"]] for r in found} == {
        i: list(w) for i, w in enumerate(want)
    }


def test_clusters_exclude_most_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 64)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(12, 34))[rng.integers(0, 12, 1500)] * 30 + rng.normal(size=(1500, 34))
    df = spark.createDataFrame(pd.DataFrame({"k": [f"r{i:04d}" for i in range(1500)], "v": list(x)}))
    report = {}
    found = nearest_neighbours(df, "k", "v", 3, report=report).collect()
    gap = neighbours._squared(x, x)
    np.fill_diagonal(gap, np.inf)
    want = np.argsort(gap, axis=1, kind="stable")[:, :3]
    assert {r["key"]: [n["key"] for n in r["neighbours"]] for r in found} == {f"r{i:04d}": [f"r{j:04d}" for j in w] for i, w in enumerate(want)}
    assert report["rows"] == 1500 and report["blocks"] > 10 and report["excluded"] > 0.75


@pytest.mark.parametrize("rows", [0, 1, 2, 5])
def test_fewer_rows_than_neighbours(spark, monkeypatch, rows):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 2)
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(rows)], "k int, v array<double>")
    found = {r["key"]: [n["key"] for n in r["neighbours"]] for r in nearest_neighbours(df, "k", "v", 5).collect()}
    assert found == {i: sorted((j for j in range(rows) if j != i), key=lambda j: (abs(i - j), j)) for i in range(rows)}


@pytest.fixture(scope="module")
def imbalanced(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    x[:14] = x[0]  # a third of the minority shares one vector
    label = (np.arange(400) < 40).astype(int)
    return x, spark.createDataFrame(pd.DataFrame({"k": range(400), "features": list(x), "Class": label}))


def test_smote_counts_and_determinism(imbalanced):
    _, df = imbalanced
    out = smote(df, "k", ratio=0.5)
    assert out.where("synthetic").count() == 140 and out.where("NOT synthetic").count() == 400
    rows = Counter(tuple(r["features"]) for r in out.where("synthetic").collect())
    again = Counter(tuple(r["features"]) for r in smote(df.repartition(9), "k", ratio=0.5).where("synthetic").collect())
    assert rows == again
    assert rows != Counter(tuple(r["features"]) for r in smote(df, "k", ratio=0.5, seed=1).where("synthetic").collect())


def test_smote_points_lie_between_two_minority_rows(imbalanced):
    x, df = imbalanced
    minority = x[:40]
    for r in smote(df, "k", ratio=0.5).where("synthetic").collect():
        p = np.array(r["features"])
        gap = np.linalg.norm(minority[:, None] - p, axis=2) + np.linalg.norm(minority[None] - p, axis=2)
        direct = np.linalg.norm(minority[:, None] - minority[None], axis=2)
        assert np.min(gap - direct) < 1e-9


def test_smote_refuses_a_majority_ratio_already_met(imbalanced):
    with pytest.raises(ValueError, match="already exceeds"):
        smote(imbalanced[1], "k", ratio=0.05)


def test_smote_needs_more_rows_than_neighbours(imbalanced):
    few = imbalanced[1].where("Class = 0 OR k < 5")
    with pytest.raises(ValueError, match="neighbours need"):
        smote(few, "k", ratio=0.5)


def test_resampling_leaves_the_test_split_alone(raw_df):
    prepared = training.prepare(raw_df)
    before = prepared.test.count()
    resampled = training.resample(prepared, 0.5)
    assert resampled.count() > prepared.train.count()
    assert prepared.test.count() == before == 40


def test_a_turn_of_shipped_rows_is_met_in_tiles():
    import tracemalloc

    rng = np.random.default_rng(4)
    at, others = np.round(rng.normal(size=(40, 30)), 1), np.round(rng.normal(size=(50_000, 30)), 1)
    others[30_000:30_050] = others[:50]  # ties across tiles
    norm = lambda x: np.sqrt((x**2).sum(1))
    order = rng.permutation(len(others))
    tracemalloc.start()
    found = list(neighbours._among(at, norm(at), np.full(40, 50.0), others, norm(others), order, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6, peak  # one distance per pair takes 16 MB, and its making three times that
    row, place, squared = (np.concatenate(x) for x in zip(*found))
    gap = neighbours._squared(at, others)
    for r in range(40):
        assert place[row == r].tolist() == np.lexsort((order, gap[r]))[:5].tolist()
