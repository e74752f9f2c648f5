"""Preparing, fitting, comparing and saving fraud models."""

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.operators.clean import clean_dataset
from ledgerwatch.operators.evaluate import full_metrics
from ledgerwatch.operators.features import (
    balanced_weights, content_key, select_features, stratified_split, weight_column,
)
from ledgerwatch.operators.smote import smote
from ledgerwatch.operators.stages import preprocessing
from ledgerwatch.schemas import DECISION_THRESHOLD, ENGINEERED, LABEL, LOW_MAX, MEDIUM_MAX, SEED, TEST_SHARE
from ledgerwatch.session import scratch_path, shared_folder
from ledgerwatch.sources.raw import path_exists, read_cleaned, write_report

KEY = "row_key"
#: Partitions of the training rows, which the seeded samples of the tree learners depend on.
PARTS = 8
#: Learners that a training run fits side by side: all of them.
LEARNERS = 4
LOGISTIC, TREE, FOREST, BOOSTED = (
    "Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosted Trees",
)


@dataclass
class Prepared:
    """Split and transformed data: (key, features, label) on both sides."""

    train: DataFrame
    test: DataFrame
    preprocess: PipelineModel
    features: list[str]
    key: str


def prepare(
    df: DataFrame, key: str | None = None, test_size: float = TEST_SHARE, seed: int = SEED,
    approx: bool = False,
) -> Prepared:
    """Split, then fit every parameter on the training rows only."""
    columns = [c for c in df.columns if c != key]
    if key is None:
        df, key = content_key(df, KEY), KEY
    train, test = stratified_split(df, [key], test_size, seed)
    features = select_features(columns) + ENGINEERED
    stages = preprocessing(select_features(columns), approx).fit(train)

    def ready(part: DataFrame) -> DataFrame:
        return stages.transform(part).select(key, "features", F.col(LABEL).cast("int").alias(LABEL))

    return Prepared(ready(train), ready(test), stages, features, key)


def resample(
    prepared: Prepared, ratio: float = 0.1, k: int = 5, seed: int = SEED,
    cached: list[DataFrame] | None = None,
) -> DataFrame:
    """Training rows with synthetic fraud added; the test rows are not touched."""
    arrays = prepared.train.withColumn("features", vector_to_array("features"))
    return smote(arrays, prepared.key, "features", LABEL, ratio, k, seed, cached).withColumn(
        "features", array_to_vector("features")
    )


def estimators(train_rows: float, seed: int = SEED) -> dict[str, object]:
    """The four learners. ``train_rows`` scales the logistic penalty to that of C = 1."""
    common = {"featuresCol": "features", "labelCol": LABEL}
    return {
        LOGISTIC: LogisticRegression(
            **common, weightCol="weight", maxIter=1000, standardization=False, regParam=1.0 / train_rows
        ),
        # Ten rows per child stand in for twenty (forest: ten -> five) rows per split node.
        TREE: DecisionTreeClassifier(
            **common, weightCol="weight", maxDepth=8, minInstancesPerNode=10, seed=seed
        ),
        FOREST: RandomForestClassifier(
            **common, weightCol="weight", numTrees=100, maxDepth=12, minInstancesPerNode=5, seed=seed
        ),
        BOOSTED: GBTClassifier(**common, maxIter=150, maxDepth=5, stepSize=0.08, seed=seed),
    }


def class_probability(model, df: DataFrame) -> DataFrame:
    """``df`` with the fraud probability ``p``."""
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def _laid_out(df: DataFrame, parts: int) -> DataFrame:
    """Rows dealt by a hash of their content and sorted by it: fits do not depend on the input's layout."""
    key = F.xxhash64(vector_to_array("features"), F.col(LABEL))
    return df.withColumn("_key", key).repartition(parts, "_key").sortWithinPartitions("_key").drop("_key")


@dataclass
class Comparison:
    table: DataFrame
    models: dict[str, object] = field(default_factory=dict)
    best: str = ""


def train_and_compare(
    train: DataFrame, test: DataFrame, seed: int = SEED, names: Sequence[str] | None = None, parts: int = PARTS,
    at_once: int = 1,
) -> Comparison:
    """Fit each learner on ``train`` and compare them on ``test`` at 0.50.

    The test rows are scored once with each model and written before they are evaluated. The best has
    the largest PR-AUC, the name deciding between equals. ``parts`` is the number of partitions of the
    training rows, for the caller to raise with their number; fits depend on it and the seed only. With
    ``at_once`` over 1 so many learners are fitted side by side, in scheduler pools of their own, so that the
    many small jobs of boosting run beside the others; each fit's seconds then include its waiting.
    """
    spark = train.sparkSession
    shared_folder(spark)  # boosting checkpoints its running predictions there
    weights = balanced_weights(train)
    weighted = _laid_out(train.withColumn("weight", weight_column(weights)), parts).persist(StorageLevel.MEMORY_AND_DISK)
    rows = weighted.count()
    test = test.persist(StorageLevel.MEMORY_AND_DISK)
    chosen = {n: e for n, e in estimators(rows, seed).items() if names is None or n in names}

    def fitted(name: str) -> tuple[object, float]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name if at_once > 1 else None)
        start = time.perf_counter()
        model = chosen[name].fit(weighted)
        return model, round(time.perf_counter() - start, 2)

    with ThreadPool(max(1, at_once)) as pool:
        found = dict(zip(chosen, pool.map(inheritable_thread_target(spark)(fitted), chosen, 1), strict=True))
    models, seconds = {n: m for n, (m, _) in found.items()}, {n: t for n, (_, t) in found.items()}
    scored = None
    for name, model in models.items():
        part = class_probability(model, test).select(F.lit(name).alias("model"), LABEL, "p")
        scored = part if scored is None else scored.unionByName(part)
    folder = scratch_path(spark, "test-scores")
    scored.write.parquet(folder)
    scored = spark.read.schema(scored.schema).parquet(folder)
    lines = full_metrics(scored, LABEL, "p", 0.50, by=["model"]).collect()
    rows = sorted(
        ((*line, seconds[line["model"]]) for line in lines), key=lambda r: (-(r[6] or 0.0), r[0])
    )
    table = spark.createDataFrame(
        rows,
        "model string, accuracy double, precision double, recall double, f1 double,"
        " roc_auc double, pr_auc double, train_time_sec double",
    )
    weighted.unpersist()
    test.unpersist()
    return Comparison(table, models, rows[0][0])


def feature_means(train: DataFrame) -> list[float]:
    """Means of the assembled training features, which a linear model's contributions refer to."""
    return [float(x) for x in train.select(Summarizer.mean(F.col("features"))).first()[0]]


def threshold_config(
    name: str, features: Sequence[str], threshold: float = DECISION_THRESHOLD, means: Sequence[float] | None = None
) -> dict:
    return {
        "feature_means": None if means is None else list(means),
        "model_name": name,
        "optimal_threshold": threshold,
        "feature_names": list(features),
        "risk_levels": {"low_max": LOW_MAX, "medium_max": MEDIUM_MAX},
    }


CONFIG_SCHEMA = (
    "model_name string, optimal_threshold double, feature_names array<string>,"
    " risk_levels struct<low_max: double, medium_max: double>, feature_means array<double>"
)


def save_model(
    spark: SparkSession, path: str, preprocess: PipelineModel, classifier, config: Mapping
) -> None:
    """The whole pipeline and its one-row configuration below ``path``."""
    PipelineModel(stages=[*preprocess.stages, classifier]).write().overwrite().save(f"{path}/pipeline")
    row = [
        (
            config["model_name"], config["optimal_threshold"], config["feature_names"],
            (config["risk_levels"]["low_max"], config["risk_levels"]["medium_max"]), config.get("feature_means"),
        )
    ]
    spark.createDataFrame(row, CONFIG_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/config")


def train_pipeline(
    spark: SparkSession, raw: str, cleaned: str, target: str, fmt: str = "csv", ratio: float = 0.1,
    seed: int = SEED, names: Sequence[str] | None = None, at_once: int = LEARNERS,
) -> Comparison:
    """Clean if needed, prepare, resample, compare, and save the best model and the report."""
    df = read_cleaned(spark, cleaned) if path_exists(spark, cleaned) else clean_dataset(spark, raw, cleaned, fmt)[0]
    prepared = prepare(df, seed=seed)
    cached: list[DataFrame] = []
    result = train_and_compare(resample(prepared, ratio, seed=seed, cached=cached), prepared.test, seed, names, at_once=at_once)
    for frame in cached:
        frame.unpersist()
    write_report(result.table, f"{target}/model_comparison")
    save_model(
        spark, f"{target}/model", prepared.preprocess, result.models[result.best],
        threshold_config(result.best, prepared.features, means=feature_means(prepared.train)),
    )
    return result
