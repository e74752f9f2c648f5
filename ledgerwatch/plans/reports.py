"""The thirteen risk reports over the audit table ``transactions``.

Amounts are summed as decimals, so a total does not depend on partitioning. Percentages and
averages are computed from those sums after the aggregate.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions import (
    dec_sum, fixed, half_up, hour_bucket, is_fraud, probability_decile, tier_order,
)


def _fraud_count() -> Column:
    return F.count_if(is_fraud())


def _fraud_amount() -> Column:
    return half_up(F.coalesce(dec_sum(F.when(is_fraud(), F.col("amount"))), F.lit(0).cast("decimal(20,6)")), 2)


def _mean(total: Column, n: Column, digits: int) -> Column:
    return fixed(total.cast("double") / n, digits)


def _percent(part: Column, whole: Column, digits: int) -> Column:
    return fixed(F.try_divide(part * 100.0, whole.cast("double")), digits)


def total_transactions(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count("*").alias("total_transactions"))


def fraud_transactions(tx: DataFrame) -> DataFrame:
    return tx.where(is_fraud()).agg(F.count("*").alias("total_fraud_transactions"))


def legitimate_transactions(tx: DataFrame) -> DataFrame:
    return tx.where("predicted_class = 'LEGITIMATE'").agg(
        F.count("*").alias("total_legitimate_transactions")
    )


def fraud_rate(tx: DataFrame) -> DataFrame:
    """Totals and fraud percentage; the latter is null on an empty table."""
    counts = tx.agg(
        F.count("*").alias("total_transactions"),
        F.sum(F.when(is_fraud(), 1).otherwise(0)).alias("fraud_transactions"),
    )
    rate = _percent(F.col("fraud_transactions"), F.col("total_transactions"), 4)
    return counts.select("*", rate.alias("fraud_rate_percentage"))


def fraud_exposure(tx: DataFrame) -> DataFrame:
    return tx.where(is_fraud()).agg(
        half_up(dec_sum(F.col("amount")), 2).alias("total_fraud_exposure_amount")
    )


def amounts_by_class(tx: DataFrame) -> DataFrame:
    amount = F.col("amount")
    groups = tx.groupBy("predicted_class").agg(
        F.count("*").alias("transaction_count"), F.count(amount).alias("known"),
        dec_sum(amount).alias("total"),
        F.min(amount).alias("low"), F.max(amount).alias("high"), F.stddev_samp(amount).alias("std"),
    )
    return groups.select(
        "predicted_class", "transaction_count",
        _mean(F.col("total"), F.col("known"), 2).alias("avg_amount"),
        fixed(F.col("low"), 2).alias("min_amount"),
        fixed(F.col("high"), 2).alias("max_amount"),
        fixed(F.col("std"), 2).alias("std_amount"),
    )


def risk_tiers(tx: DataFrame) -> DataFrame:
    """Volume, share, exposure, mean probability and fraud count per risk band."""
    groups = tx.groupBy("risk_level").agg(
        F.count("*").alias("volume"),
        dec_sum(F.col("amount")).alias("amount_sum"),
        dec_sum(F.col("fraud_probability")).alias("p_sum"),
        F.count("fraud_probability").alias("p_count"),
        _fraud_count().alias("fraud_count"),
    )
    whole = F.sum("volume").over(Window.partitionBy())
    return groups.select(
        "risk_level", "volume",
        _percent(F.col("volume"), whole, 2).alias("pct_of_total_volume"),
        half_up(F.col("amount_sum"), 2).alias("total_amount"),
        _mean(F.col("p_sum"), F.col("p_count"), 4).alias("avg_fraud_probability"),
        "fraud_count",
    ).orderBy(tier_order(F.col("risk_level")))


def fraud_by_hour(tx: DataFrame) -> DataFrame:
    groups = tx.groupBy(hour_bucket(F.col("transaction_time")).alias("hour_of_day")).agg(
        F.count("*").alias("total_hourly_volume"),
        _fraud_count().alias("fraud_count"), _fraud_amount().alias("fraud_amount"),
    )
    rate = _percent(F.col("fraud_count"), F.col("total_hourly_volume"), 3)
    return groups.select(
        "hour_of_day", "total_hourly_volume", "fraud_count",
        rate.alias("hourly_fraud_rate_pct"), "fraud_amount",
    ).orderBy("hour_of_day")


def triage_queue(tx: DataFrame, min_amount: float = 100.0, limit: int = 50) -> DataFrame:
    """High-risk rows above an amount, most suspicious first; the id breaks ties."""
    return (
        tx.where((F.col("risk_level") == "HIGH") & (F.col("amount") > min_amount))
        .select("transaction_id", "amount", "fraud_probability", "risk_score", "risk_level", "created_at")
        .orderBy(F.desc("fraud_probability"), F.desc("amount"), "transaction_id")
        .limit(limit)
    )


def daily_trend(tx: DataFrame) -> DataFrame:
    """Daily totals with the change against the previous day that has rows."""
    daily = tx.groupBy(F.to_date("created_at").alias("tx_date")).agg(
        F.count("*").alias("daily_volume"),
        _fraud_count().alias("daily_fraud_count"), _fraud_amount().alias("daily_fraud_amount"),
    )
    before = F.lag("daily_fraud_count").over(Window.partitionBy().orderBy("tx_date"))
    return (
        daily.withColumn("prev_day_fraud", before)
        .withColumn(
            "dod_fraud_change",
            F.col("daily_fraud_count") - F.coalesce(F.col("prev_day_fraud"), F.lit(0)),
        )
        .orderBy(F.desc("tx_date"))
    )


def monthly_trend(tx: DataFrame) -> DataFrame:
    groups = tx.groupBy(F.date_format("created_at", "yyyy-MM").alias("report_month")).agg(
        F.count("*").alias("total_transactions"),
        _fraud_count().alias("fraud_count"), _fraud_amount().alias("total_fraud_amount"),
    )
    rate = _percent(F.col("fraud_count"), F.col("total_transactions"), 4)
    return groups.select(
        "report_month", "total_transactions", "fraud_count",
        rate.alias("fraud_incidence_rate"), "total_fraud_amount",
    ).orderBy(F.desc("report_month"))


def top_suspicious(tx: DataFrame, ranks: int = 10) -> DataFrame:
    """The first ``ranks`` dense ranks per band by probability, then amount; ties all kept.

    Ranking whole bands would sort nearly all rows in one task, and a large group of ties
    would stay there. The ranks depend on distinct values only: the highest distinct
    probabilities of a band bound which rows can qualify, the distinct (probability, amount)
    pairs of those rows are ranked, and the few ranked pairs (bands x ranks) are joined back.
    """
    keys = ["risk_level", "fraud_probability", "amount"]
    by_p = Window.partitionBy("risk_level").orderBy(F.desc("fraud_probability"))
    floor_p = (
        tx.select("risk_level", "fraud_probability").distinct()
        .withColumn("r", F.row_number().over(by_p)).where(F.col("r") <= ranks)
        .groupBy(F.col("risk_level").alias("band")).agg(F.min("fraud_probability").alias("floor_p"))
    )
    able = tx.join(
        F.broadcast(floor_p),
        (F.col("risk_level") == F.col("band")) & (F.col("fraud_probability") >= F.col("floor_p")),
    ).drop("band", "floor_p")
    by_pair = Window.partitionBy("risk_level").orderBy(F.desc("fraud_probability"), F.desc("amount"))
    ranked = (
        able.select(*keys).distinct()
        .withColumn("tier_rank", F.row_number().over(by_pair)).where(F.col("tier_rank") <= ranks)
    )
    return (
        able.join(F.broadcast(ranked), keys)
        .select(
            "risk_level", "tier_rank", "transaction_id", "amount", "fraud_probability",
            "risk_score", "created_at",
        )
        .orderBy(tier_order(F.col("risk_level")), "tier_rank", "transaction_id")
    )


def probability_deciles(tx: DataFrame) -> DataFrame:
    """Volume, share, flagged rows and mean amount per probability decile."""
    groups = tx.groupBy(probability_decile(F.col("fraud_probability")).alias("probability_bin")).agg(
        F.count("*").alias("transaction_count"),
        _fraud_count().alias("confirmed_fraud_count"),
        dec_sum(F.col("amount")).alias("total"), F.count("amount").alias("known"),
        F.min("fraud_probability").alias("lowest"),
    )
    whole = F.sum("transaction_count").over(Window.partitionBy())
    return (
        groups.withColumn("pct_of_total", _percent(F.col("transaction_count"), whole, 2))
        .orderBy("lowest")
        .select(
            "probability_bin", "transaction_count", "pct_of_total", "confirmed_fraud_count",
            _mean(F.col("total"), F.col("known"), 2).alias("avg_amount"),
        )
    )


REPORTS = {
    "total_transactions": total_transactions,
    "fraud_transactions": fraud_transactions,
    "legitimate_transactions": legitimate_transactions,
    "fraud_rate": fraud_rate,
    "fraud_exposure": fraud_exposure,
    "amounts_by_class": amounts_by_class,
    "risk_tiers": risk_tiers,
    "fraud_by_hour": fraud_by_hour,
    "triage_queue": triage_queue,
    "daily_trend": daily_trend,
    "monthly_trend": monthly_trend,
    "top_suspicious": top_suspicious,
    "probability_deciles": probability_deciles,
}
