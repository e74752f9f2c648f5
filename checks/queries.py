"""One query per operator, over the driver tables of a data folder."""

import functools
from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import (
    actual_label, amount_range, fixed, hour_bucket, hour_of_day, predicted_label, probability_decile,
    risk_level, risk_score, stored_probability,
)
from ledgerwatch.operators import clean, evaluate, explain, features, profile, validate
from ledgerwatch.operators.neighbours import nearest_neighbours
from ledgerwatch.operators.smote import smote
from ledgerwatch.operators.stages import preprocessing
from ledgerwatch.plans import exploration, kpi, measures, reports, scoring, training
from ledgerwatch.schemas import FEATURES, LABEL, PAYLOAD_SCHEMA, RAW_COLUMNS, V_COLUMNS
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import audit, derived, raw
from ledgerwatch.streaming import jobs

#: Metric of the comparison -> name in Spark ML.
EVALUATORS = {"accuracy": "accuracy", "precision": "precisionByLabel", "recall": "recallByLabel", "f1": "fMeasureByLabel"}
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def rounded(df: DataFrame, digits: int, *keep: str) -> DataFrame:
    """Every double column at a fixed number of digits."""
    doubles = [c for c, t in df.dtypes if t == "double" and c not in keep]
    return df.withColumns({c: fixed(F.col(c), digits) for c in doubles})


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 31 raw columns."""
    return derived.transactions_raw(spark, sf_dir).select(*RAW_COLUMNS)


def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.transactions_raw(spark, sf_dir).drop("label")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.transactions(spark, sf_dir).where("actual_class IS NOT NULL")


def payload_rows(embeddings: DataFrame) -> DataFrame:
    """Scoring inputs: whole label groups break one rule each, and some ids are too short."""
    base = derived.raw_rows(embeddings)
    label = F.col("label")
    return base.select(
        F.concat(F.lit("T"), F.col("row_id").cast("string")).alias("transaction_id"),
        "Time",
        F.when(label == 4, -F.col("Amount") - 1).when(label == 7, F.lit(float("inf")))
        .otherwise(F.col("Amount")).alias("Amount"),
        F.when(label == 8, 7).when(label == 2, F.lit(None)).otherwise(F.col(LABEL)).cast("int")
        .alias("actual_class"),
        *[
            F.when(label != 5, F.col("V1")).alias("V1") if v == "V1"
            else F.when(label == 6, F.lit(float("nan"))).otherwise(F.col("V2")).alias("V2") if v == "V2"
            else F.col(v)
            for v in V_COLUMNS
        ],
    )


# Sources and sinks


@query("s01_load_raw_csv")
def _(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    raw_table(spark, sf_dir).write.csv(path, header=True)
    return raw.load_raw(spark, path)


@query("s02_s03_cleaned_table")
def _(spark, sf_dir):
    path = scratch_path(spark, "cleaned")
    raw.write_cleaned(clean.drop_repeats(raw_table(spark, sf_dir)), path)
    return raw.read_cleaned(spark, path)


@query("s04_report_table")
def _(spark, sf_dir):
    path = scratch_path(spark, "report")
    table = evaluate.threshold_tradeoffs(labelled(spark, sf_dir), "actual_class", "fraud_probability")
    raw.write_report(table, path)
    return raw.read_report(spark, path, table.schema)


@query("s05_classification_report_file")
def _(spark, sf_dir):
    path = scratch_path(spark, "classification-report")
    table = evaluate.classification_report(labelled(spark, sf_dir), "actual_class", "fraud_probability", 0.35)
    raw.write_report(table, path)
    return raw.read_report(spark, path, table.schema)


@query("s06_s07_saved_model")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    path = scratch_path(spark, "model")
    scorer = fitted_scorer(spark, df)
    config = training.threshold_config(scorer.model_name, scorer.features)
    training.save_model(
        spark, path, training.PipelineModel(stages=scorer.pipeline.stages[:-1]), scorer.classifier, config
    )
    outputs = ("prediction", "fraud_probability", "risk_score", "risk_level", "threshold_applied")
    side = lambda scored, name: scored.select("row_id", F.struct(*outputs).alias(name))
    direct = side(scoring.score(df, scorer, factors=0), "direct")
    loaded = side(scoring.score(df, scoring.load_scorer(spark, path), factors=0), "loaded")
    same = F.col("direct").eqNullSafe(F.col("loaded"))
    return direct.join(loaded, "row_id", "full").select("row_id", same.cast("int").alias("same_as_saved"))


@query("s08_audit_table")
def _(spark, sf_dir):
    path = scratch_path(spark, "audit")
    audit.write_transactions(derived.transactions(spark, sf_dir), path)
    return kpi.record(audit.read_transactions(spark, path).drop(audit.DAY))


# Profiling, validation, cleaning


@query("c01_null_profile")
def _(spark, sf_dir):
    return rounded(profile.null_profile(derived.transactions_dirty(spark, sf_dir)), 6)


@query("c02_shape_profile")
def _(spark, sf_dir):
    return rounded(profile.shape_profile(derived.transactions_dirty(spark, sf_dir)), 4)


@query("c02b_numeric_summary")
def _(spark, sf_dir):
    return rounded(profile.numeric_summary(raw_table(spark, sf_dir)), 6)


@query("c02c_target_distribution")
def _(spark, sf_dir):
    return rounded(profile.target_distribution(raw_table(spark, sf_dir)), 6)


@query("c02c_target_summary")
def _(spark, sf_dir):
    return rounded(profile.target_summary(raw_table(spark, sf_dir)), 6)


@query("c03_impute")
def _(spark, sf_dir):
    return rounded(clean.impute(derived.transactions_dirty(spark, sf_dir)), 8)


@query("c04_drop_repeats")
def _(spark, sf_dir):
    return rounded(clean.handle_duplicates(clean.impute(derived.transactions_dirty(spark, sf_dir)))[0], 8)


@query("c05_outliers")
def _(spark, sf_dir):
    cleaned = clean.drop_repeats(clean.impute(derived.transactions_dirty(spark, sf_dir)))
    return rounded(clean.analyze_outliers(cleaned), 6).drop("recommendation")


@query("c06_clean_dataset")
def _(spark, sf_dir):
    source, target = scratch_path(spark, "dirty"), scratch_path(spark, "cleaned")
    derived.transactions_dirty(spark, sf_dir).write.parquet(source)
    return rounded(clean.clean_dataset(spark, source, target, fmt="parquet")[0], 8)


@query("vd1_validated_schema")
def _(spark, sf_dir):
    df = raw_table(spark, sf_dir)
    validate.validate_schema(df)
    return df


@query("vd1_schema_faults")
def _(spark, sf_dir):
    """What the check says of good rows, of rows with a wrong label and of a table short of a column."""
    df = raw_table(spark, sf_dir)
    wrong = df.withColumn(LABEL, F.when(F.col("Time") < 40_000, 99).otherwise(F.col(LABEL)))
    said = []
    for case, table in (("good", df), ("wrong label", wrong), ("no V14", df.drop("V14"))):
        try:
            validate.validate_schema(table)
            said.append((case, ""))
        except ValueError as error:
            said.append((case, str(error)))
    return spark.createDataFrame(said, "case string, said string")


@query("vd2_payload_reasons")
def _(spark, sf_dir):
    payloads = payload_rows(derived.table(spark, sf_dir, "embeddings"))
    return validate.with_reasons(payloads).select(
        "transaction_id", F.concat_ws(",", "reasons").alias("reasons"),
        (F.size("reasons") == 0).cast("int").alias("accepted"),
    )


@query("vd3_audit_violations")
def _(spark, sf_dir):
    tx = derived.transactions(spark, sf_dir)
    kind = derived.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type")
    broken = tx.join(kind, "id").withColumns(
        {
            "risk_level": F.when(F.col("event_type") == "error", "NONE").otherwise(F.col("risk_level")),
            "predicted_class": F.when(F.col("event_type") != "click", F.col("predicted_class")),
            "fraud_probability": F.col("fraud_probability") + (F.col("event_type") == "view").cast("int"),
            "risk_score": F.col("risk_score") - (F.col("event_type") == "purchase").cast("int"),
            "amount": F.when(F.col("event_type") != "signup", F.col("amount")),
            "transaction_id": F.when(F.col("event_type") == "error", F.concat(F.lit("U_"), F.col("amount").cast("int")))
            .otherwise(F.col("transaction_id")),
        }
    )
    return validate.audit_violations(broken)


# Projections and scalar functions


def feature_query(*names: str) -> Query:
    def run(spark, sf_dir):
        df = keyed_table(spark, sf_dir)
        made = features.add_features(df, features.fit_median_amount(df))
        return rounded(made.select("row_id", *names), 8)

    return run


QUERIES["f01_hour_of_day"] = feature_query("hour_of_day")
QUERIES["f02_cyclic_hour"] = feature_query("sin_hour", "cos_hour")
QUERIES["f03_log_amount"] = feature_query("log_amount")
QUERIES["f04_amount_ratio"] = feature_query("amount_ratio")


@query("f05_feature_selection")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    names = features.select_features(df.columns, exclude=["row_id"])
    return df.select("row_id", *names)


def model_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.with_model_probability(derived.table(spark, sf_dir, "events")).select("event_id", "p")


@query("f06_risk_score")
def _(spark, sf_dir):
    p = F.col("p")
    return model_probability(spark, sf_dir).select(
        "event_id", risk_score(p).alias("risk_score"), stored_probability(p).alias("fraud_probability")
    )


@query("f07_risk_level")
def _(spark, sf_dir):
    return model_probability(spark, sf_dir).select(
        "event_id", risk_level(risk_score(F.col("p"))).alias("risk_level")
    )


@query("f08_prediction")
def _(spark, sf_dir):
    return model_probability(spark, sf_dir).select("event_id", predicted_label(F.col("p")).alias("prediction"))


@query("f09_audit_record")
def _(spark, sf_dir):
    return kpi.record(derived.transactions(spark, sf_dir))


@query("f10_filters")
def _(spark, sf_dir):
    tx = derived.transactions(spark, sf_dir)
    return tx.where((F.col("risk_level") == F.upper(F.lit("high"))) & (F.col("amount") > 100.0)).select(
        "transaction_id", "amount", "risk_level"
    )


@query("f11_amount_range")
def _(spark, sf_dir):
    return derived.transactions(spark, sf_dir).select(
        "transaction_id", amount_range(F.col("amount")).alias("amount_range")
    )


@query("f12_probability_decile")
def _(spark, sf_dir):
    return derived.transactions(spark, sf_dir).select(
        "transaction_id", probability_decile(F.col("fraud_probability")).alias("probability_bin")
    )


@query("f14_actual_label")
def _(spark, sf_dir):
    return derived.transactions(spark, sf_dir).select(
        "transaction_id", actual_label(F.col("actual_class")).alias("actual_label")
    )


# Joins


@query("j03_minority_neighbours")
def _(spark, sf_dir):
    points = keyed_table(spark, sf_dir).where("Class = 1").select("row_id", F.array(*V_COLUMNS).alias("v"))
    near = nearest_neighbours(points, "row_id", "v", 5)
    return near.select("key", F.posexplode("neighbours").alias("place", "n")).select(
        F.col("key").alias("row_id"), F.col("place").cast("int").alias("place"),
        F.col("n.key").alias("neighbour"), fixed(F.col("n.distance"), 6).alias("distance"),
    )


@query("j05_late_labels")
def _(spark, sf_dir):
    tx = derived.transactions(spark, sf_dir)
    late = tx.where("actual_class IS NULL").select(
        "transaction_id", (F.col("amount") > 100).cast("int").alias("actual_class")
    )
    return audit.attach_labels(tx, late).select("transaction_id", "actual_class", "predicted_class")


# Split, scale, rebalance


@query("p01_split_counts")
def _(spark, sf_dir):
    train, test = features.stratified_split(keyed_table(spark, sf_dir), ["row_id"])
    both = train.select(F.lit("train").alias("part"), LABEL).unionByName(
        test.select(F.lit("test").alias("part"), LABEL)
    )
    return both.groupBy("part", F.col(LABEL).alias("class")).agg(F.count("*").alias("transactions"))


@query("p02_train_only_parameters")
def _(spark, sf_dir):
    train, _ = features.stratified_split(keyed_table(spark, sf_dir), ["row_id"])
    median = features.fit_median_amount(train)
    scaling = features.fit_robust_scaling(features.add_features(train, median), FEATURES)
    lines = [(c, scaling.center[c], scaling.scale[c], median) for c in FEATURES]
    return spark.createDataFrame(lines, "feature string, center double, scale double, median_amount double")


@query("p03_robust_scaling")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    names = [*V_COLUMNS, "Amount"]
    scaled = features.scale_features(df, features.fit_robust_scaling(df, names))
    return rounded(scaled.select("row_id", *names), 6)


@query("p03_approximate_scaling")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    names = [*V_COLUMNS, "Amount"]
    scaled = features.scale_features(df, features.fit_robust_scaling(df, names, approx=True))
    return scaled.select("row_id", *names)


@query("p04_preprocessed_features")
def _(spark, sf_dir):
    prepared = training.prepare(keyed_table(spark, sf_dir), "row_id")
    both = prepared.train.withColumn("part", F.lit("train")).unionByName(
        prepared.test.withColumn("part", F.lit("test"))
    )
    return both.withColumn("features", vector_to_array("features"))


def fitted_by_rule(spark: SparkSession, sf_dir: str):
    """(preprocessing fitted on four fifths of the rows by id, all rows): a split that SQL can state."""
    df = keyed_table(spark, sf_dir)
    return preprocessing(features.select_features(df.columns, ["row_id"])).fit(df.where("row_id % 5 <> 0")), df


@query("p02_fitted_parameters")
def _(spark, sf_dir):
    made, scaled = fitted_by_rule(spark, sf_dir)[0].stages
    median = made.getOrDefault(made.medianAmount)
    fitted = zip(scaled.getInputCols(), scaled.getOrDefault(scaled.center), scaled.getOrDefault(scaled.scale), strict=True)
    lines = [(c, float(m), float(s), float(median)) for c, m, s in fitted]
    return rounded(spark.createDataFrame(lines, "feature string, center double, scale double, median_amount double"), 6)


@query("p04_fitted_pipeline")
def _(spark, sf_dir):
    """Fitted on the training rows, saved, loaded and applied to all rows."""
    fitted, df = fitted_by_rule(spark, sf_dir)
    path = scratch_path(spark, "preprocessing")
    fitted.write().save(path)
    values = vector_to_array("features")
    ready = training.PipelineModel.load(path).transform(df)
    return rounded(ready.select("row_id", *[values[i].alias(c) for i, c in enumerate(FEATURES)]), 6)


@query("p05_smote_counts")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir).withColumn("features", F.array(*V_COLUMNS))
    return smote(df, "row_id", ratio=0.5).groupBy(F.col(LABEL).alias("class"), F.col("synthetic").cast("int").alias("synthetic")).agg(
        F.count("*").alias("transactions")
    )


@query("p05_smote_rows")
def _(spark, sf_dir):
    prepared = training.prepare(keyed_table(spark, sf_dir), "row_id")
    return training.resample(prepared, 0.5).withColumn("features", vector_to_array("features"))


@query("p06_class_weights")
def _(spark, sf_dir):
    df = raw_table(spark, sf_dir)
    weighted = df.withColumn("weight", features.weight_column(features.balanced_weights(df)))
    return weighted.groupBy(F.col(LABEL).alias("class"), fixed(F.col("weight"), 8).alias("weight")).agg(
        F.count("*").alias("transactions")
    )


# Models, scoring, explanation


def comparison(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    prepared = training.prepare(keyed_table(spark, sf_dir), "row_id")
    cached: list[DataFrame] = []
    train = training.resample(prepared, 0.5, cached=cached)
    table = training.train_and_compare(train, prepared.test, names=names or None, at_once=training.LEARNERS).table
    for frame in cached:
        frame.unpersist()
    return table


def fitted_scorer(spark: SparkSession, df: DataFrame, name: str = training.TREE, rounds: int | None = None) -> scoring.Scorer:
    """A model fitted on the split's training rows; ``rounds`` shortens boosting."""
    prepared = training.prepare(df, "row_id")
    weighted = prepared.train.withColumn(
        "weight", features.weight_column(features.balanced_weights(prepared.train))
    )
    estimator = training.estimators(weighted.count())[name]
    if rounds and name == training.BOOSTED:
        estimator.setMaxIter(rounds)
    model = estimator.fit(weighted)
    pipeline = training.PipelineModel(stages=[*prepared.preprocess.stages, model])
    return scoring.Scorer(pipeline, prepared.features, model_name=name)


QUERIES["m01_logistic_regression"] = lambda spark, sf_dir: comparison(spark, sf_dir, training.LOGISTIC)
QUERIES["m02_decision_tree"] = lambda spark, sf_dir: comparison(spark, sf_dir, training.TREE)
QUERIES["m03_random_forest"] = lambda spark, sf_dir: comparison(spark, sf_dir, training.FOREST)
QUERIES["m04_boosted_trees"] = lambda spark, sf_dir: comparison(spark, sf_dir, training.BOOSTED)
QUERIES["m05_model_comparison"] = lambda spark, sf_dir: comparison(spark, sf_dir)


@query("m05_metrics_agree")
def _(spark, sf_dir):
    """The comparison's metrics against those of Spark ML's own evaluators on the same test rows."""
    prepared = training.prepare(keyed_table(spark, sf_dir), "row_id")
    result = training.train_and_compare(training.resample(prepared, 0.5), prepared.test, names=[training.LOGISTIC, training.TREE], at_once=2)
    lines = []
    for r in result.table.collect():
        scored = training.class_probability(result.models[r["model"]], prepared.test)
        scored = scored.select(F.col(LABEL).cast("double").alias("label"), "p", (F.col("p") >= 0.5).cast("double").alias("prediction")).cache()
        judge = MulticlassClassificationEvaluator(metricLabel=1.0, beta=1.0)
        got = {m: judge.evaluate(scored, {judge.metricName: k}) for m, k in EVALUATORS.items()}
        got["roc_auc"] = BinaryClassificationEvaluator(rawPredictionCol="p", numBins=0).evaluate(scored)
        scored.unpersist()
        lines.append((r["model"], *[int(abs(r[m] - got[m]) <= 5.1e-5) for m in (*EVALUATORS, "roc_auc")]))
    return spark.createDataFrame(lines, "model string, " + ", ".join(f"{m} int" for m in (*EVALUATORS, "roc_auc")))


@query("m06_training_run")
def _(spark, sf_dir):
    source, cleaned, target = (scratch_path(spark, n) for n in ("raw", "cleaned", "run"))
    rare = keyed_table(spark, sf_dir).drop("row_id")
    rare.write.parquet(source)
    return training.train_pipeline(spark, source, cleaned, target, "parquet", ratio=0.5).table


@query("m07_scored_transactions")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    scored = scoring.score(df, fitted_scorer(spark, df, training.FOREST))
    p, factors = F.col("fraud_probability"), F.col("top_contributing_factors")
    flagged = (F.col("prediction") == "FRAUD") == (p >= F.col("threshold_applied"))
    return scored.select(
        "row_id", "threshold_applied",
        (flagged | (F.abs(p - F.col("threshold_applied")) < 1e-4)).cast("int").alias("label_follows"),
        (F.col("risk_level") == risk_level(F.col("risk_score"))).cast("int").alias("band_follows"),
        (F.abs(F.col("risk_score") - 100 * p) <= 0.0051).cast("int").alias("score_follows"),
        F.size(factors).cast("long").alias("factors"),
    )


@query("m07_logistic_factors")
def _(spark, sf_dir):
    """A saved and reloaded logistic model explains every row by its four largest contributions."""
    df = keyed_table(spark, sf_dir)
    path = scratch_path(spark, "logistic")
    prepared = training.prepare(df, "row_id")
    scorer = fitted_scorer(spark, df, training.LOGISTIC)
    means = training.feature_means(prepared.train)
    config = training.threshold_config(training.LOGISTIC, scorer.features, means=means)
    training.save_model(
        spark, path, training.PipelineModel(stages=scorer.pipeline.stages[:-1]), scorer.classifier, config
    )
    scored = scoring.score(df, scoring.load_scorer(spark, path))
    factors = F.col("top_contributing_factors")
    return scored.select(
        "row_id", F.size(factors).cast("long").alias("factors"),
        F.size(F.array_distinct(factors["feature"])).cast("long").alias("features"),
    )


def linear_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with contributions of a linear score whose weights are the class mean gaps."""
    df = keyed_table(spark, sf_dir)
    fraud = F.col(LABEL) == 1
    stats = df.agg(
        *[F.avg(v).alias(f"m_{v}") for v in V_COLUMNS],
        *[(F.avg(F.when(fraud, F.col(v))) - F.avg(F.when(~fraud, F.col(v)))).alias(f"w_{v}") for v in V_COLUMNS],
    ).first()
    weights, means = [stats[f"w_{v}"] for v in V_COLUMNS], [stats[f"m_{v}"] for v in V_COLUMNS]
    return df.withColumn(
        "contributions", explain.linear_contributions([F.col(v) for v in V_COLUMNS], weights, means)
    )


@query("x01_linear_factors")
def _(spark, sf_dir):
    rows = linear_view(spark, sf_dir).select(
        "row_id", F.posexplode(explain.top_factors(F.col("contributions"), V_COLUMNS)).alias("place", "f")
    )
    return rows.select("row_id", F.col("place").cast("int").alias("place"), "f.feature", "f.impact", "f.weight")


@query("x01_tree_factors")
def _(spark, sf_dir):
    """Contributions and the base add up to the score: the probability, or a boosted model's log-odds."""
    df = keyed_table(spark, sf_dir)
    found = None
    for name in (training.TREE, training.FOREST, training.BOOSTED):
        scorer = fitted_scorer(spark, df, name, rounds=20)
        trees = explain.tree_ensemble(spark, scorer.classifier)
        ready = scorer.pipeline.transform(explain.spread(df)).withColumn("x", vector_to_array("features"))
        total = F.aggregate(explain.tree_contributions(spark, trees, F.col("x")), F.lit(trees.base), lambda s, c: s + c)
        p = vector_to_array("probability")[1]
        score = F.ln(p / (1 - p)) if name == training.BOOSTED else p
        part = ready.select(F.lit(name).alias("model"), "row_id", (F.abs(total - score) <= 1e-9).cast("int").alias("adds_up"))
        found = part if found is None else found.unionByName(part)
    return found


@query("x02_importance_factors")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    scorer = fitted_scorer(spark, df, training.FOREST)
    importances = explain.model_importances(scorer.classifier, scorer.features)
    weights = explain.importance_factors(importances)["weight"]
    ordered = F.array_sort(weights) == F.reverse(weights)
    known = F.lit(round(max(importances.values()), 4)) == weights[0]
    return df.select("row_id", (ordered & known).cast("int").alias("largest_first"), F.size(weights).cast("long").alias("factors"))


@query("x03_global_importance")
def _(spark, sf_dir):
    table = explain.global_importance(linear_view(spark, sf_dir), "contributions", V_COLUMNS)
    return rounded(table, 6)


@query("x03_sampled_tree_importance")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    scorer = fitted_scorer(spark, df, training.FOREST)
    sample = explain.hash_sample(df, "row_id", 500)
    ready = scorer.pipeline.transform(sample).withColumn("x", vector_to_array("features"))
    trees = explain.tree_ensemble(spark, scorer.classifier)
    found = ready.withColumn("contributions", explain.tree_contributions(spark, trees, F.col("x")))
    return explain.global_importance(found, "contributions", scorer.features)


@query("x04_model_importances")
def _(spark, sf_dir):
    scorer = fitted_scorer(spark, keyed_table(spark, sf_dir), training.FOREST)
    return explain.importance_table(spark, explain.model_importances(scorer.classifier, scorer.features))


# Evaluation


def evaluation(function, *args, digits: int = 6, **kwargs) -> Query:
    def run(spark, sf_dir):
        return rounded(
            function(labelled(spark, sf_dir), "actual_class", "fraud_probability", *args, **kwargs),
            digits, "threshold",
        )

    return run


QUERIES["e01_classification_metrics"] = evaluation(evaluate.classification_metrics, 0.35)


@query("e10_evaluation_run")
def _(spark, sf_dir):
    """All tables of an evaluation, as lines of (section, name, value)."""
    found = scoring.evaluation_tables(labelled(spark, sf_dir), "actual_class", "fraud_probability", 0.35)
    metrics = found["metrics"].unpivot([], ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"], "name", "value")
    name = F.concat_ws("/", F.col("actual").cast("string"), F.col("predicted").cast("string"))
    cells = found["confusion_matrix"].select(name.alias("name"), F.col("transactions").cast("double").alias("value"))
    trade = found["threshold_tradeoffs"].select(F.format_number("threshold", 2).alias("name"), F.col("f1").alias("value"))
    points = [found[c].agg(F.lit(c).alias("name"), F.count("*").cast("double").alias("value")) for c in ("roc_points", "pr_points")]
    sections = [("metrics", metrics), ("confusion_matrix", cells), ("threshold_tradeoffs", trade), *[("points", p) for p in points]]
    parts = [part.select(F.lit(section).alias("section"), "name", "value") for section, part in sections]
    return functools.reduce(DataFrame.unionByName, parts)


QUERIES["e02_roc_auc"] = evaluation(evaluate.roc_auc, digits=8)
QUERIES["e03_average_precision"] = evaluation(evaluate.average_precision, digits=8)
QUERIES["e04_confusion_matrix"] = evaluation(evaluate.confusion_matrix, 0.35)
QUERIES["e05_threshold_tradeoffs"] = evaluation(evaluate.threshold_tradeoffs)
QUERIES["e06_classification_report"] = evaluation(evaluate.classification_report, 0.35)
QUERIES["e07_roc_points"] = evaluation(evaluate.roc_points, digits=8)
QUERIES["e08_pr_points"] = evaluation(evaluate.pr_points, digits=8)


@query("e09_calibration")
def _(spark, sf_dir):
    return reports.probability_deciles(derived.transactions(spark, sf_dir))


@query("e10_full_metrics_by_band")
def _(spark, sf_dir):
    return evaluate.full_metrics(
        labelled(spark, sf_dir), "actual_class", "fraud_probability", 0.5, by=["predicted_class"]
    )


# Reports, reads, writes

_NUMBERED = {
    "q01_total_transactions": reports.total_transactions,
    "q02_fraud_transactions": reports.fraud_transactions,
    "q03_legitimate_transactions": reports.legitimate_transactions,
    "q04_fraud_rate": reports.fraud_rate,
    "q05_fraud_exposure": reports.fraud_exposure,
    "q06_amounts_by_class": reports.amounts_by_class,
    "q07_risk_tiers": reports.risk_tiers,
    "q08_fraud_by_hour": reports.fraud_by_hour,
    "q09_triage_queue": lambda tx: kpi.record(reports.triage_queue(tx)),
    "q10_daily_trend": reports.daily_trend,
    "q11_monthly_trend": reports.monthly_trend,
    "q12_top_suspicious": lambda tx: kpi.record(reports.top_suspicious(tx)),
    "q13_probability_deciles": reports.probability_deciles,
    "k02_get_by_id": lambda tx: kpi.record(kpi.get_by_id(tx, "TX_211")),
    "k03_list_newest": lambda tx: kpi.record(kpi.list_transactions(tx, limit=500)),
    "k03_list_band_page": lambda tx: kpi.record(kpi.list_transactions(tx, 20, 50, "medium")),
    "k04_high_risk": lambda tx: kpi.record(kpi.high_risk(tx, 200)),
    "k05_fraud_summary": lambda tx: kpi.flat_summary(kpi.fraud_summary(tx)),
    "d01_d17_measures": lambda tx: rounded(measures.measures(tx), 8),
    "d01_d17_measures_by_risk_level": lambda tx: rounded(measures.measures(tx, ["risk_level"]), 8),
    "d01_d17_measures_sliced_by_hour": lambda tx: rounded(
        measures.measures(
            tx, [hour_bucket(F.col("transaction_time")).alias("hour_of_day")],
            F.col("risk_level").isin("HIGH", "MEDIUM"),
        ), 8,
    ),
    "d18_reporting_dataset": lambda tx: dataset(tx).drop("Top_Predictive_Feature"),
    "d19_hourly_fraud": lambda tx: rounded(measures.hourly_fraud(tx), 8),
    "d20_volume_by_prediction": measures.volume_by_prediction,
    "d21_amount_by_risk_level": measures.amount_by_risk_level,
    "d22_amount_range_by_risk_level": measures.amount_range_by_risk_level,
    "d23_fraud_by_amount_range": measures.fraud_by_amount_range,
    "d24_probability_scatter": measures.probability_scatter,
    "d25_triage_table": lambda tx: measures.triage_table(dataset(tx)).drop("Top_Predictive_Feature"),
    "d26_surveillance_table": lambda tx: measures.surveillance_table(dataset(tx)).drop("Top_Predictive_Feature"),
}


def dataset(tx: DataFrame) -> DataFrame:
    """The reporting dataset with its decimal amount as a double, for comparison."""
    return measures.reporting_dataset(tx).withColumn("Amount", F.col("Amount").cast("double"))


def over_transactions(function) -> Query:
    return lambda spark, sf_dir: function(derived.transactions(spark, sf_dir))


QUERIES |= {name: over_transactions(f) for name, f in _NUMBERED.items()}


@query("q11_monthly_trend_of_orders")
def _(spark, sf_dir):
    """The monthly report over several years: orders scored like events."""
    orders = derived.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_totalprice").alias("value"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderstatus").alias("event_type"),
    )
    return reports.monthly_trend(derived.audit_rows(orders))


def retried(events: DataFrame) -> DataFrame:
    """Events sent again: every error once more, with one unit added."""
    return events.where("event_type = 'error'").withColumn("value", F.col("value") + 1)


def stored_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A table without purchases, and a batch of retried errors and first-time purchases."""
    events = derived.table(spark, sf_dir, "events")
    stored = derived.audit_rows(events.where("event_type <> 'purchase'"))
    first = derived.audit_rows(events.where("event_type = 'purchase'")).withColumn("attempt", F.lit(0))
    again = derived.audit_rows(retried(events)).withColumn("attempt", F.lit(1))
    again = again.withColumn("actual_class", F.lit(None).cast("int"))
    return stored, first.unionByName(again)


@query("k01_upsert")
def _(spark, sf_dir):
    path = scratch_path(spark, "upsert")
    stored, batch = stored_and_batch(spark, sf_dir)
    audit.write_transactions(stored, path)
    audit.upsert(spark, path, batch, "attempt")
    return kpi.record(audit.read_transactions(spark, path).drop(audit.DAY))


@query("k01_snapshot_reader")
def _(spark, sf_dir):
    """A reader opened before an upsert: it still sees the version it opened."""
    path = scratch_path(spark, "snapshot")
    stored, batch = stored_and_batch(spark, sf_dir)
    audit.write_transactions(stored, path)
    reader = audit.read_transactions(spark, path)
    audit.upsert(spark, path, batch, "attempt")
    return kpi.record(reader.drop(audit.DAY))


@query("k02_point_lookup")
def _(spark, sf_dir):
    """One id in the stored table, by its bucket."""
    path = scratch_path(spark, "lookup")
    audit.write_transactions(derived.transactions(spark, sf_dir), path, buckets=4)
    return kpi.record(audit.find_transaction(spark, path, "TX_211").drop(audit.DAY))


@query("k01_upsert_keep_label")
def _(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    return kpi.record(audit.merge_records(stored, audit.latest_per_id(batch, "attempt"), keep_label=True))


# Dashboards and exploration over raw transactions


@query("d18_reporting_dataset_with_factor")
def _(spark, sf_dir):
    df = keyed_table(spark, sf_dir)
    scored = scoring.score(
        df.withColumn("transaction_id", F.concat(F.lit("TX_"), F.col("row_id")))
        .withColumn("actual_class", F.col(LABEL)),
        fitted_scorer(spark, df),
    )
    rows = kpi.audit_record(scored, "top_contributing_factors")
    return measures.reporting_dataset(rows, F.get("top_contributing_factors", F.lit(0))["feature"])


@query("d27_model_page")
def _(spark, sf_dir):
    return comparison(spark, sf_dir)


@query("a01_hourly_labels")
def _(spark, sf_dir):
    return rounded(exploration.hourly_labels(raw_table(spark, sf_dir)), 6)


@query("a02_amount_histogram")
def _(spark, sf_dir):
    return rounded(exploration.amount_histogram(raw_table(spark, sf_dir)), 6)


@query("a03_class_densities")
def _(spark, sf_dir):
    return rounded(exploration.class_densities(raw_table(spark, sf_dir)), 6)


@query("a04_amount_facts")
def _(spark, sf_dir):
    return rounded(exploration.amount_facts(raw_table(spark, sf_dir)), 6)


# Streams


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return jobs.file_stream(spark, path, spark.read.parquet(path).schema)


@query("t01_stream_scoring")
def _(spark, sf_dir):
    table, bad, state = (scratch_path(spark, n) for n in ("scored", "rejected", "state"))
    path = f"{sf_dir}/embeddings.parquet"
    stream = jobs.file_stream(spark, path, spark.read.parquet(path).schema)
    payloads = payload_rows(stream).withColumn("received_at", F.timestamp_seconds("Time"))
    scorer = fitted_scorer(spark, keyed_table(spark, sf_dir))
    jobs.score_stream(payloads, scorer, table, bad, state).awaitTermination()
    return kpi.record(audit.read_transactions(spark, table).drop(audit.DAY, "id"))


@query("t02_ingest_last_wins")
def _(spark, sf_dir):
    table, state = scratch_path(spark, "ingest"), scratch_path(spark, "state")
    events = event_stream(spark, sf_dir)
    rows = derived.audit_rows(events).withColumn("attempt", F.lit(0)).unionByName(
        derived.audit_rows(retried(event_stream(spark, sf_dir))).withColumn("attempt", F.lit(1))
    )
    jobs.upsert_stream(rows, table, "attempt", state).awaitTermination()
    return kpi.record(audit.read_transactions(spark, table).drop(audit.DAY))


@query("t02_ingest_first_wins")
def _(spark, sf_dir):
    sink, state, inbox = (scratch_path(spark, n) for n in ("first", "state", "inbox"))
    events = derived.table(spark, sf_dir, "events")
    for arrival in (events, retried(events)):  # the retries, one unit more, come in a later run
        arrival.write.mode("append").parquet(inbox)
        rows = derived.audit_rows(jobs.file_stream(spark, inbox, events.schema))
        timed = rows.withColumn("created_at", jobs.utc_instant(F.col("created_at")))
        writer = jobs.first_wins(timed, delay="60 days").writeStream.format("parquet").option("path", sink)
        writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink).select("id", "transaction_id", "amount", "risk_level")


@query("t03_daily_summary")
def _(spark, sf_dir):
    sink, state = scratch_path(spark, "summary"), scratch_path(spark, "state")
    rows = derived.audit_rows(event_stream(spark, sf_dir))
    timed = rows.withColumn("created_at", jobs.utc_instant(F.col("created_at")))
    jobs.summary_stream(timed, sink, state).awaitTermination()
    summary = kpi.flat_summary(jobs.latest_summary(spark, sink))
    return summary.withColumn("window_start", jobs.utc_date(F.col("window_start")))


@query("t03_closed_windows")
def _(spark, sf_dir):
    """Three arrivals of ten days; every fiftieth row of the first ten days comes with the second arrival."""
    sink, state, inbox = (scratch_path(spark, n) for n in ("closed", "state", "inbox"))
    events = derived.table(spark, sf_dir, "events")
    held = (F.col("ts") < "2024-01-11") & (F.col("event_id") % 50 == 0)
    arrivals = [
        events.where((F.col("ts") < "2024-01-11") & ~held), events.where(held | F.col("ts").between("2024-01-11", "2024-01-20 23:59:59.999999")),
        events.where(F.col("ts") >= "2024-01-21"),
    ]
    for arrival in arrivals:
        arrival.write.mode("append").parquet(inbox)
        rows = derived.audit_rows(jobs.file_stream(spark, inbox, events.schema))
        timed = rows.withColumn("created_at", jobs.utc_instant(F.col("created_at")))
        jobs.closed_windows_stream(timed, sink, state, delay="1 day").awaitTermination()
    closed = kpi.flat_summary(jobs.closed_summary(spark, sink)).withColumn("window_start", jobs.utc_date(F.col("window_start")))
    late = spark.read.parquet(f"{sink}/late").groupBy(jobs.utc_date(F.col("created_at")).alias("window_start")).agg(F.count("*").alias("late_rows"))
    return closed.join(late, "window_start", "left").fillna(0, ["late_rows"])


@query("t04_high_risk_alerts")
def _(spark, sf_dir):
    sink, state = scratch_path(spark, "alerts"), scratch_path(spark, "state")
    jobs.alert_stream(derived.audit_rows(event_stream(spark, sf_dir)), sink, state).awaitTermination()
    return kpi.record(spark.read.schema(derived.transactions(spark, sf_dir).schema).parquet(sink))


@query("t05_weekly_drift")
def _(spark, sf_dir):
    """Counts per week of a stream, against the first week."""
    sink, state = scratch_path(spark, "drift"), scratch_path(spark, "state")
    names = ["amount", "fraud_probability"]
    first = derived.transactions(spark, sf_dir).where("created_at < TIMESTAMP_NTZ'2024-01-08 00:00:00'")
    edges = exploration.drift_edges(first, names)
    jobs.drift_stream(derived.audit_rows(event_stream(spark, sf_dir)), edges, names, sink, state).awaitTermination()
    found = exploration.weekly_drift(exploration.bin_counts(first, edges, names), jobs.weekly_counts(spark, sink))
    return rounded(found.withColumn("alert", F.col("alert").cast("int")), 6)


@query("t05_feature_drift")
def _(spark, sf_dir):
    df = raw_table(spark, sf_dir)
    names = [*V_COLUMNS, "Amount"]
    index = exploration.drift_index(df.where("Time < 86400"), df.where("Time >= 86400"), names)
    return rounded(index, 6).withColumn("alert", F.col("alert").cast("int"))
