"""Scoring transactions with a saved model: one plan for batches and streams."""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import predicted_label, risk_level, risk_score, stored_probability
from ledgerwatch.operators.evaluate import (
    classification_report, confusion_matrix, full_metrics, pr_points, roc_points, threshold_tradeoffs,
)
from ledgerwatch.operators.explain import (
    TreeEnsemble, contribution_column, global_importance, hash_sample, importance_factors, importance_table,
    model_importances, spread, top_factors, tree_ensemble,
)
from ledgerwatch.operators.features import content_key
from ledgerwatch.operators.stages import ExactRobustScalerModel
from ledgerwatch.plans.training import CONFIG_SCHEMA, threshold_config
from ledgerwatch.schemas import DECISION_THRESHOLD, LABEL, LOW_MAX, MEDIUM_MAX
from ledgerwatch.session import scratch_path
from ledgerwatch.sources.raw import write_report


@dataclass
class Scorer:
    """A fitted pipeline with its thresholds; built once per job or streaming query."""

    pipeline: PipelineModel
    features: list[str]
    threshold: float = DECISION_THRESHOLD
    low_max: float = LOW_MAX
    medium_max: float = MEDIUM_MAX
    model_name: str = ""
    means: list[float] | None = None
    ensemble: TreeEnsemble | None = None

    @property
    def classifier(self):
        return self.pipeline.stages[-1]


def load_config(spark: SparkSession, path: str, features: list[str]) -> dict:
    """The saved configuration, or the defaults where there is none."""
    try:
        row = spark.read.schema(CONFIG_SCHEMA).json(f"{path}/config").first()
        stored = row.asDict(recursive=True) if row else {}
    except AnalysisException:
        stored = {}
    default = threshold_config("", features)
    bands = stored.get("risk_levels") or {}
    return {
        **default,
        **{k: v for k, v in stored.items() if v is not None and k != "risk_levels"},
        "risk_levels": {k: v if bands.get(k) is None else bands[k] for k, v in default["risk_levels"].items()},
    }


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    pipeline = PipelineModel.load(f"{path}/pipeline")
    inputs = next(s for s in pipeline.stages if isinstance(s, ExactRobustScalerModel)).getInputCols()
    config = load_config(spark, path, inputs)
    return Scorer(
        pipeline, inputs, config["optimal_threshold"],
        config["risk_levels"]["low_max"], config["risk_levels"]["medium_max"], config["model_name"],
        config.get("feature_means"),
    )


def _factors(spark: SparkSession, scorer: Scorer, n: int) -> Column:
    """Row contributions where the model allows them, else its importances."""
    model = scorer.classifier
    importances = model_importances(model, scorer.features)
    if importances and scorer.ensemble is None:
        scorer.ensemble = tree_ensemble(spark, model)
    found = contribution_column(spark, model, F.col("x"), scorer.means, scorer.ensemble) if (
        importances or scorer.means is not None
    ) else None
    return importance_factors(importances, n) if found is None else top_factors(found, scorer.features, n)


def score(payloads: DataFrame, scorer: Scorer, factors: int = 4) -> DataFrame:
    """Payload columns with prediction, probability, score, band, threshold and factors.

    The label uses the unrounded probability; the band uses the rounded score. Rows that a tree model explains
    are dealt over all cores first.
    """
    spark = payloads.sparkSession
    trees = factors and model_importances(scorer.classifier, scorer.features)
    ready = scorer.pipeline.transform(spread(payloads) if trees else payloads).withColumns(
        {"p": vector_to_array("probability")[1], "x": vector_to_array("features")}
    )
    p = F.col("p")
    return ready.select(
        *payloads.columns,
        predicted_label(p, scorer.threshold).alias("prediction"),
        stored_probability(p).alias("fraud_probability"),
        risk_score(p).alias("risk_score"),
        risk_level(risk_score(p), scorer.low_max, scorer.medium_max).alias("risk_level"),
        F.lit(scorer.threshold).alias("threshold_applied"),
        *([_factors(spark, scorer, factors).alias("top_contributing_factors")] if factors else []),
    )


def probabilities(df: DataFrame, scorer: Scorer, label: str = LABEL) -> DataFrame:
    """(label, p) of labelled rows, for the evaluation operators."""
    ready = scorer.pipeline.transform(df)
    return ready.select(F.col(label).cast("int").alias(label), vector_to_array("probability")[1].alias("p"))


def evaluation_tables(scored: DataFrame, label: str, p: str, threshold: float) -> dict[str, DataFrame]:
    """The evaluation tables of labelled probabilities."""
    return {
        "metrics": full_metrics(scored, label, p, threshold),
        "confusion_matrix": confusion_matrix(scored, label, p, threshold),
        "classification_report": classification_report(scored, label, p, threshold),
        "threshold_tradeoffs": threshold_tradeoffs(scored, label, p),
        "roc_points": roc_points(scored, label, p),
        "pr_points": pr_points(scored, label, p),
    }


def importances(test: DataFrame, scorer: Scorer, rows: int = 500, n: int = 15) -> DataFrame:
    """The n features with the largest mean absolute contribution over a fixed number of rows, chosen by
    a hash of their content; the model's own importances where it has no contributions."""
    spark = test.sparkSession
    sample = hash_sample(content_key(test, "_row"), "_row", rows)
    ready = scorer.pipeline.transform(sample).withColumn("x", vector_to_array("features"))
    own = model_importances(scorer.classifier, scorer.features)
    found = contribution_column(spark, scorer.classifier, F.col("x"), scorer.means, scorer.ensemble) if own or scorer.means else None
    if found is None:
        return importance_table(spark, own, n)
    return global_importance(ready.select(found.alias("contributions")), "contributions", scorer.features, n)


def evaluate_model(test: DataFrame, scorer: Scorer, target: str | None = None) -> dict[str, DataFrame]:
    """The evaluation tables and importances of a test split, written below ``target`` if given.

    The probabilities are written once to the shared folder, so that no table scores again.
    """
    spark = test.sparkSession
    stored = scratch_path(spark, "probabilities")
    probabilities(test, scorer).write.parquet(stored)
    tables = evaluation_tables(spark.read.parquet(stored), LABEL, "p", scorer.threshold)
    tables["importances"] = importances(test, scorer)
    if target is not None:
        for name, table in tables.items():
            if name in ("roc_points", "pr_points"):
                table.write.mode("overwrite").parquet(f"{target}/{name}")
            else:
                write_report(table, f"{target}/{name}")
    return tables
