import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import evaluate as ev
from ledgerwatch.operators.evaluate import report_from_counts, tradeoff_metrics

# Published counts and metrics per threshold on the original test split.
TRADEOFFS = [
    (0.20, 0.4246, 0.8000, 0.5547, 76, 103, 19),
    (0.30, 0.5802, 0.8000, 0.6726, 76, 55, 19),
    (0.35, 0.6441, 0.8000, 0.7136, 76, 42, 19),
    (0.40, 0.6726, 0.8000, 0.7308, 76, 37, 19),
    (0.50, 0.7576, 0.7895, 0.7732, 75, 24, 20),
    (0.60, 0.8242, 0.7895, 0.8065, 75, 16, 20),
    (0.70, 0.8523, 0.7895, 0.8197, 75, 13, 20),
]
# Published classification report at 0.35.
REPORT = {
    "Legitimate": (0.9997, 0.9993, 0.9995, 56651),
    "Fraudulent": (0.6441, 0.8000, 0.7136, 95),
    "accuracy": (None, None, 0.9989, 56746),
    "macro avg": (0.8219, 0.8996, 0.8565, 56746),
    "weighted avg": (0.9991, 0.9989, 0.9990, 56746),
}


def test_published_tradeoffs_follow_from_their_counts(spark):
    df = spark.createDataFrame([(t, tp, fp, fn) for t, _, _, _, tp, fp, fn in TRADEOFFS], "t double, tp long, fp long, fn long")
    rows = df.select("t", *tradeoff_metrics(F.col("tp"), F.col("fp"), F.col("fn"))).orderBy("t").collect()
    assert [tuple(r) for r in rows] == [t[:4] for t in TRADEOFFS]


def test_published_report_follows_from_its_counts(spark):
    counts = spark.createDataFrame([(76, 42, 19, 56609)], "tp long, fp long, fn long, tn long")
    rows = {r["line"]: tuple(r)[1:] for r in report_from_counts(counts).collect()}
    for line, (p, r, f1, n) in REPORT.items():
        assert rows[line][3] == n
        assert rows[line][:3] == tuple(pytest.approx(v, abs=1.1e-4) if v is not None else None for v in (p, r, f1))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    y = (rng.random(3000) < 0.1).astype(int)
    p = np.round(np.clip(rng.normal(0.3 + 0.25 * y, 0.2), 0, 1), 3)
    return y, p, spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def brute_ap(y, p):
    total, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / y.sum()
        total += (recall - last) * y[hit].mean()
        last = recall
    return total


@pytest.fixture(params=[1, 7])
def ranges(spark, request):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_areas_equal_brute_force_under_any_ranges(scored, ranges):
    y, p, df = scored
    assert ev.roc_auc(df, "y", "p").first()[0] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert ev.average_precision(df, "y", "p").first()[0] == pytest.approx(brute_ap(y, p), abs=1e-12)
    assert ev.cumulative_counts(df, "y", "p").count() == len(set(p))


def test_rows_without_a_score_change_nothing(spark, scored, ranges):
    y, p, df = scored
    odd = spark.createDataFrame([(1, float("nan")), (0, None), (None, 0.5)], "y long, p double")
    more = df.unionByName(odd)
    assert ev.roc_auc(more, "y", "p").first()[0] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert ev.classification_metrics(more, "y", "p", 0.9).collect() == ev.classification_metrics(df, "y", "p", 0.9).collect()


def test_by_separates_evaluations(spark, scored):
    y, p, df = scored
    both = df.withColumn("m", F.lit("a")).unionByName(df.select("y", (1 - F.col("p")).alias("p"), F.lit("b").alias("m")))
    rows = {r["m"]: r for r in ev.full_metrics(both, "y", "p", by=["m"]).collect()}
    assert rows["a"]["roc_auc"] == pytest.approx(brute_auc(y, p), abs=1e-4)
    assert rows["b"]["roc_auc"] == pytest.approx(brute_auc(y, 1 - p), abs=1e-4)
    hit = p >= 0.5
    assert rows["a"]["precision"] == pytest.approx(y[hit].mean(), abs=1e-4)
    assert rows["a"]["accuracy"] == pytest.approx((hit == y).mean(), abs=1e-4)


def test_zero_division_is_zero_and_unknown_rows_are_left_out(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2), (None, 0.9), (1, None)], "y int, p double")
    row = ev.classification_metrics(df, "y", "p", 0.5).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)
    cells = {(r["actual"], r["predicted"]): r["transactions"] for r in ev.confusion_matrix(df, "y", "p", 0.5).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_one_class_only_has_no_area(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    assert ev.roc_auc(df, "y", "p").first()[0] is None
