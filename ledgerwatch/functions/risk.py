"""Scores, bands, labels and the report bins."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerwatch.functions.numeric import fixed
from ledgerwatch.schemas import DECISION_THRESHOLD, LOW_MAX, MEDIUM_MAX


def risk_score(p: Column) -> Column:
    return fixed(p * 100, 2)


def stored_probability(p: Column) -> Column:
    return fixed(p, 4)


def risk_level(score: Column, low_max: float = LOW_MAX, medium_max: float = MEDIUM_MAX) -> Column:
    """Band of the *rounded* score; both bounds belong to the lower band. NaN has none."""
    return (
        F.when(F.isnan(score), None).when(score <= low_max, "LOW").when(score <= medium_max, "MEDIUM").otherwise("HIGH")
    )


def predicted_label(p: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """Label of the *unrounded* probability; NaN has none."""
    return F.when(F.isnan(p), None).when(p >= threshold, "FRAUD").otherwise("LEGITIMATE")


def actual_label(actual_class: Column) -> Column:
    return F.when(actual_class == 1, "FRAUD").when(actual_class == 0, "LEGITIMATE")


def is_fraud() -> Column:
    return F.col("predicted_class") == "FRAUD"


def hour_of_day(seconds: Column) -> Column:
    """Fractional hour of the day, in [0, 24)."""
    return F.pmod(seconds / 3600.0, F.lit(24.0))


def hour_bucket(seconds: Column) -> Column:
    return F.floor(hour_of_day(seconds)).cast("int")


def amount_range(amount: Column) -> Column:
    """Left-closed, right-open amount ranges."""
    return (
        F.when(amount < 50, "$0-$50")
        .when(amount < 200, "$50-$200")
        .when(amount < 500, "$200-$500")
        .otherwise("$500+")
    )


def probability_decile(p: Column) -> Column:
    """Left-closed deciles as text; the last one also holds 1.0."""
    label = None
    for i in range(1, 10):
        text = f"{(i - 1) / 10:.2f} - {i / 10:.2f}"
        label = F.when(p < i / 10, text) if label is None else label.when(p < i / 10, text)
    return label.otherwise("0.90 - 1.00")


def tier_order(level: Column) -> Column:
    return F.when(level == "HIGH", 1).when(level == "MEDIUM", 2).when(level == "LOW", 3).otherwise(4)


def iso_timestamp(ts: Column) -> Column:
    """ISO text; the fraction is left out where it is zero."""
    text = ts.cast("timestamp_ntz").cast("string")
    whole = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.when(F.length(text) > 19, F.concat(whole, F.lit("."), micros)).otherwise(whole)
