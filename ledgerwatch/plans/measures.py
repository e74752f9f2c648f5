"""Dashboard measures and the data sets behind its charts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions import (
    actual_label, amount_range, dec_sum, fixed, half_up, hour_bucket, is_fraud, ratio_or_zero,
)


def _aggregates() -> list[Column]:
    actual, level, amount = F.col("actual_class"), F.col("risk_level"), F.col("amount")
    return [
        F.count("*").alias("n"),
        F.count_if(is_fraud()).alias("fraud"),
        F.count_if(F.col("predicted_class") == "LEGITIMATE").alias("legit"),
        dec_sum(F.when(is_fraud(), amount)).alias("fraud_sum"),
        dec_sum(amount).alias("total_sum"),
        F.count(amount).alias("amounts"),
        F.count(F.when(is_fraud(), amount)).alias("fraud_amounts"),
        *[F.count_if(level == v).alias(v.lower()) for v in ("HIGH", "MEDIUM", "LOW")],
        F.count_if(is_fraud() & (actual == 1)).alias("tp"),
        F.count_if(is_fraud() & (actual == 0)).alias("fp"),
        F.count_if(actual == 1).alias("actual"),
    ]


def measures(tx: DataFrame, by: Sequence[Column | str] = (), where: Column | None = None) -> DataFrame:
    """All 17 measures at once; a slicer is a filter and a chart axis a grouping key.

    Rows without ground truth are neither true nor false positives. A measure's own filter
    narrows the slicer's.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in by]
    rows = tx if where is None else tx.where(where)
    grouped = rows.groupBy(*keys).agg(*_aggregates())
    named = grouped.columns[: len(keys)]
    c = F.col
    return grouped.select(
        *named,
        c("n").alias("total_transactions"),
        c("fraud").alias("fraud_transactions"),
        c("legit").alias("legitimate_transactions"),
        ratio_or_zero(c("fraud"), c("n")).alias("fraud_rate"),
        half_up(c("fraud_sum"), 2).alias("fraud_amount"),
        half_up(c("total_sum"), 2).alias("total_transaction_value"),
        fixed(F.try_divide(c("total_sum").cast("double"), c("amounts")), 6)
        .alias("average_transaction_amount"),
        fixed(F.try_divide(c("fraud_sum").cast("double"), c("fraud_amounts")), 6)
        .alias("average_fraud_amount"),
        c("high").alias("high_risk_transactions"),
        c("medium").alias("medium_risk_transactions"),
        c("low").alias("low_risk_transactions"),
        ratio_or_zero(c("high"), c("n")).alias("high_risk_rate"),
        c("tp").alias("true_positives"),
        c("fp").alias("false_positives"),
        ratio_or_zero(c("tp"), c("tp") + c("fp")).alias("operational_precision"),
        c("actual").alias("actual_fraud_count"),
        ratio_or_zero(c("tp"), c("actual")).alias("operational_recall"),
    )


def _hour() -> Column:
    return hour_bucket(F.col("transaction_time")).alias("hour_of_day")


def reporting_dataset(tx: DataFrame, top_feature: Column | None = None) -> DataFrame:
    """The dashboard's table; ``top_feature`` names the leading factor where one is known."""
    columns = {
        "Transaction_ID": F.col("transaction_id"),
        "Transaction_Time_Seconds": F.col("transaction_time"),
        "Hour_of_Day": _hour(),
        "Amount": F.col("amount").cast("decimal(18,2)"),
        "Actual_Class": F.col("actual_class"),
        "Actual_Label": actual_label(F.col("actual_class")),
        "Prediction": F.col("predicted_class"),
        "Fraud_Probability": F.col("fraud_probability"),
        "Risk_Score": F.col("risk_score"),
        "Risk_Level": F.col("risk_level"),
        "Top_Predictive_Feature": F.lit(None).cast("string") if top_feature is None else top_feature,
    }
    return tx.select(*[col.alias(name) for name, col in columns.items()])


def hourly_fraud(tx: DataFrame) -> DataFrame:
    return measures(tx, by=[_hour()]).select("hour_of_day", "fraud_transactions", "fraud_rate")


def volume_by_prediction(tx: DataFrame) -> DataFrame:
    return tx.groupBy("predicted_class").agg(F.count("*").alias("total_transactions"))


def amount_by_risk_level(tx: DataFrame) -> DataFrame:
    return tx.groupBy("risk_level").agg(half_up(dec_sum(F.col("amount")), 2).alias("total_amount"))


def amount_range_by_risk_level(tx: DataFrame) -> DataFrame:
    return tx.groupBy(amount_range(F.col("amount")).alias("amount_range"), "risk_level").agg(
        F.count("*").alias("transactions")
    )


def fraud_by_amount_range(tx: DataFrame) -> DataFrame:
    return tx.where(is_fraud()).groupBy(amount_range(F.col("amount")).alias("amount_range")).agg(
        F.count("*").alias("fraud_transactions")
    )


def probability_scatter(tx: DataFrame, points: int | None = None) -> DataFrame:
    """Amount against probability; ``points`` keeps that many rows, chosen by a hash of the id."""
    if points is not None:
        tx = tx.orderBy(F.xxhash64("transaction_id"), "transaction_id").limit(points)
    return tx.select("amount", "fraud_probability", "risk_level")


def triage_table(dataset: DataFrame) -> DataFrame:
    """High-risk rows of the reporting dataset, most probable first."""
    return (
        dataset.where("Risk_Level = 'HIGH'")
        .select("Transaction_ID", "Amount", "Fraud_Probability", "Risk_Score", "Top_Predictive_Feature")
        .orderBy(F.desc("Fraud_Probability"), "Transaction_ID")
    )


def surveillance_table(dataset: DataFrame) -> DataFrame:
    return dataset.select(
        "Transaction_ID", "Transaction_Time_Seconds", "Hour_of_Day", "Amount", "Prediction",
        "Fraud_Probability", "Risk_Score", "Risk_Level", "Top_Predictive_Feature",
    )
