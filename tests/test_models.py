from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerwatch.operators import explain
from ledgerwatch.operators.features import balanced_weights, select_features, weight_column
from ledgerwatch.operators.stages import preprocessing
from ledgerwatch.plans import scoring, training
from ledgerwatch.schemas import FEATURES

from leaf_values import leaf_boxes, leaf_shapley


def subset_value(x, known, boxes):
    """Expected output when only ``known`` features are seen, straight from the definition."""
    out = 0.0
    for i in range(len(boxes.value)):
        share = 1.0
        for j in range(boxes.feature.shape[1]):
            if boxes.cover[i, j] == 1.0 and np.isinf(boxes.low[i, j]) and np.isinf(boxes.high[i, j]):
                continue
            f = boxes.feature[i, j]
            inside = boxes.low[i, j] < x[f] <= boxes.high[i, j]
            share *= float(inside) if f in known else boxes.cover[i, j]
        out += boxes.value[i] * share
    return out


def brute_shapley(x, boxes):
    n = boxes.width
    out = np.zeros(n)
    for j in range(n):
        rest = [f for f in range(n) if f != j]
        for size in range(n):
            w = factorial(size) * factorial(n - size - 1) / factorial(n)
            for s in combinations(rest, size):
                out[j] += w * (subset_value(x, {*s, j}, boxes) - subset_value(x, set(s), boxes))
    return out


@pytest.fixture(scope="module")
def prepared(raw_df):
    return training.prepare(raw_df)


@pytest.fixture(scope="module")
def weighted(prepared):
    train = prepared.train
    return train.withColumn("weight", weight_column(balanced_weights(train))).persist()


def test_shapley_values_equal_the_definition(spark, tmp_path):
    """Leaf by leaf, subset by subset, and by one walk along the edges."""
    from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5))
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=300) * 0.3) > 0).astype(int)
    df = spark.createDataFrame([(Vectors.dense(a), int(b)) for a, b in zip(x, y)], ["features", "Class"])
    for estimator in (
        DecisionTreeClassifier(labelCol="Class", maxDepth=9, seed=1),
        RandomForestClassifier(labelCol="Class", numTrees=4, maxDepth=5, seed=1),
        GBTClassifier(labelCol="Class", maxIter=4, maxDepth=4, seed=1),
        DecisionTreeClassifier(labelCol="Class", maxDepth=0),
    ):
        model = estimator.fit(df)
        boxes = leaf_boxes(spark, model, str(tmp_path / "model"))
        want = leaf_shapley(x, boxes)
        np.testing.assert_allclose(want[:6], [brute_shapley(r, boxes) for r in x[:6]], atol=1e-10)
        trees = explain.tree_ensemble(spark, model)
        assert trees.base == pytest.approx(boxes.base, abs=1e-12)
        for cells in (2_000_000, 1):
            got = sum(explain.tree_shapley(x, tree, trees.width, cells) for tree in trees.trees)
            np.testing.assert_allclose(got, want, atol=1e-9)


@pytest.mark.parametrize("name", [training.TREE, training.FOREST])
def test_contributions_add_up_to_the_score(spark, prepared, weighted, name):
    model = training.estimators(weighted.count())[name].fit(weighted)
    trees = explain.tree_ensemble(spark, model)
    rows = (
        training.class_probability(model, prepared.test).withColumn("x", vector_to_array("features"))
        .select("p", explain.tree_contributions(spark, trees, F.col("x")).alias("c")).collect()
    )
    assert len(rows) == 40
    for r in rows:
        assert sum(r["c"]) + trees.base == pytest.approx(r["p"], abs=1e-9)


def test_stages_fit_save_load_and_cross_validate(spark, raw_df, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    learner = LogisticRegression(labelCol="Class", maxIter=5)
    whole = Pipeline(stages=[*preprocessing(select_features(raw_df.columns)).getStages(), learner])
    whole.write().save(str(tmp_path / "unfitted"))
    model = Pipeline.load(str(tmp_path / "unfitted")).fit(raw_df)
    model.write().save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    pick = lambda m: [(r["Time"], r["features"], r["probability"]) for r in m.transform(raw_df).sort("Time", "V1").collect()]
    assert pick(again) == pick(model) == pick(whole.fit(raw_df))
    made, scaled = again.stages[:2]
    assert made.getOrDefault(made.medianAmount) == raw_df.toPandas()["Amount"].median()
    grid = ParamGridBuilder().addGrid(learner.regParam, [0.01, 0.1]).build()
    judge = BinaryClassificationEvaluator(labelCol="Class")
    best = CrossValidator(estimator=whole, estimatorParamMaps=grid, evaluator=judge, numFolds=2, seed=1).fit(raw_df)
    assert len(best.avgMetrics) == 2 and best.bestModel.transform(raw_df).count() == raw_df.count()
    assert scaled.copy().getOrDefault(scaled.center) == scaled.getOrDefault(scaled.center)


def test_a_missing_value_becomes_nan(spark):
    from ledgerwatch.operators.stages import ExactRobustScaler

    df = spark.createDataFrame([(1.0, 2.0), (3.0, None), (None, 5.0)], "a double, b double")
    rows = ExactRobustScaler(inputCols=["a", "b"]).fit(df).transform(df).select(vector_to_array("features").alias("f")).collect()
    assert np.isnan(rows[1]["f"][1]) and np.isnan(rows[2]["f"][0]) and rows[0]["f"][0] == -1.0


def test_fits_side_by_side_give_the_same_models(spark, prepared):
    one = training.train_and_compare(prepared.train, prepared.test, names=[training.LOGISTIC, training.TREE])
    two = training.train_and_compare(prepared.train, prepared.test, names=[training.LOGISTIC, training.TREE], at_once=2)
    drop = lambda c: [tuple(r)[:-1] for r in c.table.collect()]
    assert drop(one) == drop(two) and one.best == two.best
    assert one.models[training.LOGISTIC].coefficients == two.models[training.LOGISTIC].coefficients
    assert one.models[training.TREE].toDebugString.split("\n")[1:] == two.models[training.TREE].toDebugString.split("\n")[1:]


def test_top_factors_sort_by_signed_value(spark):
    df = spark.createDataFrame([([0.2, -0.9, 0.0, 0.5],)], "c array<double>")
    found = df.select(explain.top_factors(F.col("c"), ["a", "b", "c", "d"], 3).alias("f")).first()["f"]
    assert [tuple(f) for f in found] == [
        ("d", explain.INCREASES, 0.5), ("a", explain.INCREASES, 0.2), ("c", explain.REDUCES, 0.0)
    ]


def test_fallback_factors(spark):
    one = spark.range(1)
    found = one.select(explain.importance_factors({"a": 0.1, "b": 0.7, "c": 0.2}, 2).alias("f")).first()["f"]
    assert [tuple(f) for f in found] == [("b", explain.GLOBAL, 0.7), ("c", explain.GLOBAL, 0.2)]
    assert one.select(explain.importance_factors({}).alias("f")).first()["f"] == []


def test_training_run_saves_a_scorer_that_scores(spark, raw_df, raw_pdf, tmp_path):
    source = str(tmp_path / "raw.csv")
    raw_pdf.to_csv(source, index=False)
    result = training.train_pipeline(
        spark, source, str(tmp_path / "cleaned"), str(tmp_path / "run"), ratio=0.3,
        names=(training.LOGISTIC, training.TREE),
    )
    table = result.table.toPandas()
    assert list(table["pr_auc"]) == sorted(table["pr_auc"], reverse=True)
    assert result.best == table["model"][0]
    assert table[["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]].stack().between(0, 1).all()
    scorer = scoring.load_scorer(spark, str(tmp_path / "run" / "model"))
    assert scorer.features == FEATURES and scorer.threshold == 0.35 and scorer.model_name == result.best
    direct = scoring.Scorer(scorer.pipeline, scorer.features)
    rows = scoring.score(raw_df.withColumn("transaction_id", F.lit("TX_1")), scorer).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["prediction"] in ("LEGITIMATE", "FRAUD") and r["risk_level"] in ("LOW", "MEDIUM", "HIGH")
        assert 0 <= r["fraud_probability"] <= 1 and 0 <= r["risk_score"] <= 100
        assert r["threshold_applied"] == 0.35 and isinstance(r["top_contributing_factors"], list)
    assert direct.threshold == scorer.threshold
    tables = scoring.evaluate_model(raw_df, scorer, str(tmp_path / "reports"))
    assert tables["threshold_tradeoffs"].count() == 7
    assert spark.read.csv(str(tmp_path / "reports" / "classification_report"), header=True).count() == 5


def test_missing_config_falls_back_to_defaults(spark, prepared, weighted, tmp_path):
    model = training.estimators(weighted.count())[training.TREE].fit(weighted)
    path = str(tmp_path / "m")
    PipelineModel(stages=[*prepared.preprocess.stages, model]).write().save(f"{path}/pipeline")
    scorer = scoring.load_scorer(spark, path)
    assert (scorer.threshold, scorer.low_max, scorer.medium_max) == (0.35, 30.0, 70.0)


def test_label_uses_the_unrounded_probability_and_band_the_rounded_score(spark):
    from ledgerwatch.functions import predicted_label, risk_level, risk_score, stored_probability

    df = spark.createDataFrame([(0.34999,), (0.35,), (0.30004,), (0.300051,), (0.7001,)], "p double")
    p = F.col("p")
    rows = df.select(predicted_label(p), stored_probability(p), risk_level(risk_score(p))).collect()
    assert [tuple(r) for r in rows] == [
        ("LEGITIMATE", 0.35, "MEDIUM"), ("FRAUD", 0.35, "MEDIUM"), ("LEGITIMATE", 0.3, "LOW"),
        ("LEGITIMATE", 0.3001, "MEDIUM"), ("FRAUD", 0.7001, "HIGH"),
    ]


def test_band_boundaries(spark):
    from ledgerwatch.functions import risk_level

    df = spark.createDataFrame([(s,) for s in (15.0, 30.0, 50.0, 70.0, 85.0)], "s double")
    assert [r[0] for r in df.select(risk_level(F.col("s"))).collect()] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_a_comparison_fits_its_learners_side_by_side(spark, sf_dir, monkeypatch):
    import threading

    from pyspark.ml.classification import LogisticRegression

    from checks.queries import comparison

    together = threading.Barrier(4, timeout=60)

    class Met:
        def fit(self, df):
            together.wait()
            return LogisticRegression(featuresCol="features", labelCol="Class", maxIter=2).fit(df)

    monkeypatch.setattr(training, "estimators", lambda rows, seed: {f"m{k}": Met() for k in range(4)})
    assert comparison(spark, sf_dir).count() == 4


def test_many_rows_are_looked_up_not_walked(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 6)).round(1)
    y = ((x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=3000)) > 0).astype(int)
    x[::50, 1] = np.nan
    df = spark.createDataFrame([(Vectors.dense(np.nan_to_num(a)), int(b)) for a, b in zip(x, y)], ["features", "Class"])
    trees = explain.tree_ensemble(spark, RandomForestClassifier(labelCol="Class", numTrees=5, maxDepth=10, seed=1).fit(df))
    assert any((np.diff(np.unique(t.earlier)) > 0).any() for t in trees.trees)  # features that a path splits on again
    want = [explain.tree_shapley(x[k : k + 100], t, trees.width) for t in trees.trees for k in range(0, 3000, 100)]
    walked = []
    monkeypatch.setattr(explain, "_walked", lambda *args: walked.append(args))
    monkeypatch.setattr(explain, "TURN", 700)
    got = [explain.tree_shapley(x, t, trees.width) for t in trees.trees]
    np.testing.assert_allclose(np.concatenate(got), np.concatenate(want), atol=1e-12)
    parts = list(explain._turns(iter([pd.Series(list(x[:400])), pd.Series([], dtype=object), pd.Series(list(x[400:1000])), pd.Series(list(x[1000:1200]))]), 6))
    assert [len(p) for p in parts] == [1000, 200] and np.array_equal(np.concatenate(parts), x[:1200], equal_nan=True)
    assert not walked


def test_scored_rows_are_spread(spark, prepared, weighted):
    model = training.estimators(weighted.count())[training.TREE].fit(weighted)
    pipeline = training.PipelineModel(stages=[model])
    scorer = scoring.Scorer(pipeline, prepared.features)
    test = prepared.test.coalesce(1)
    scored = scoring.score(test, scorer)
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert scoring.score(test, scorer, factors=0).rdd.getNumPartitions() == 1
    assert scored.count() == test.count() == scored.where("size(top_contributing_factors) = 4").count()


def test_rows_to_explain_are_spread(spark):
    df = spark.range(1000).coalesce(1)
    dealt = explain.spread(df)
    assert dealt.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert max(dealt.rdd.glom().map(len).collect()) < 200 and {r.id for r in dealt.collect()} == set(range(1000))
