"""Column functions: every one builds a JVM-side expression."""

from ledgerwatch.functions.numeric import dec_sum, finite, fixed, half_up, ratio_or_zero
from ledgerwatch.functions.risk import (
    actual_label,
    amount_range,
    hour_of_day,
    hour_bucket,
    is_fraud,
    iso_timestamp,
    predicted_label,
    probability_decile,
    risk_level,
    risk_score,
    stored_probability,
    tier_order,
)

__all__ = [
    "actual_label", "amount_range", "dec_sum", "finite", "fixed", "half_up", "hour_bucket",
    "hour_of_day", "is_fraud", "iso_timestamp", "predicted_label", "probability_decile",
    "ratio_or_zero", "risk_level", "risk_score", "stored_probability", "tier_order",
]
