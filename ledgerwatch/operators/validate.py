"""Schema checks, scoring-input checks and audit-table constraints."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions import finite
from ledgerwatch.schemas import LABEL, PREDICTIONS, RAW_COLUMNS, RISK_LEVELS, V_COLUMNS


def validate_schema(
    df: DataFrame, required: Sequence[str] = tuple(RAW_COLUMNS), label: str = LABEL
) -> None:
    """Raise ValueError for absent columns or labels other than 0 and 1."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")
    ok = F.col(label).isin(0, 1)
    bad = df.where(~ok | F.col(label).isNull()).groupBy(label).count()
    shown = [(r[label], r["count"]) for r in bad.orderBy(F.desc("count"), label).limit(20).collect()]
    if shown:
        raise ValueError(f"labels other than 0 and 1 (label, rows): {shown}")


def _rule(holds: Column, reason: str) -> Column:
    """The reason, where the rule is broken or cannot be decided."""
    return F.when(~F.coalesce(holds, F.lit(False)), F.lit(reason))


def payload_reasons(df: DataFrame) -> Column:
    """Why a scoring input must be rejected; an empty array for a good one."""
    id_length = F.length("transaction_id")
    rules = [
        _rule(id_length.between(3, 64), "transaction_id"),
        _rule(finite(F.col("Time")) >= 0, "Time"),
        _rule(finite(F.col("Amount")) >= 0, "Amount"),
    ]
    if "actual_class" in df.columns:
        known = F.col("actual_class")
        rules.append(_rule(known.isNull() | known.isin(0, 1), "actual_class"))
    for v in V_COLUMNS:
        rules.append(_rule(finite(F.col(v)).isNotNull(), v) if v in df.columns else F.lit(v))
    return F.array_compact(F.array(*rules))


def with_reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", payload_reasons(df))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined); the quarantined rows carry their reasons."""
    marked = with_reasons(df)
    return (
        marked.where(F.size("reasons") == 0).drop("reasons"),
        marked.where(F.size("reasons") > 0),
    )


# Constraint name -> SQL condition that every row of the audit table meets.
AUDIT_CHECKS = {
    "risk_level": "risk_level IN ({})".format(", ".join(f"'{v}'" for v in RISK_LEVELS)),
    "predicted_class": "predicted_class IN ({})".format(", ".join(f"'{v}'" for v in PREDICTIONS)),
    "fraud_probability": "fraud_probability BETWEEN 0.0 AND 1.0",
    "risk_score": "risk_score BETWEEN 0.0 AND 100.0",
    "required": "transaction_id IS NOT NULL AND transaction_time IS NOT NULL"
    " AND amount IS NOT NULL AND created_at IS NOT NULL",
}


def audit_violations(df: DataFrame) -> DataFrame:
    """Rows breaking each constraint, and the ids stored more than once."""
    checks = df.agg(
        *[F.count_if(~F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in AUDIT_CHECKS.items()]
    ).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in AUDIT_CHECKS]
            )
        )
    )
    repeated = (
        df.groupBy("transaction_id").agg(F.count("*").alias("n")).where("n > 1")
        .agg(F.lit("unique_transaction_id").alias("rule"), F.count("*").alias("violations"))
    )
    return checks.unionByName(repeated)


def require_audit_rows(df: DataFrame) -> DataFrame:
    """The same rows; the job fails on the first one that breaks a row constraint."""
    strict = df
    for name, check in AUDIT_CHECKS.items():
        held = F.coalesce(F.expr(check), F.lit(False))
        strict = strict.where(F.when(held, F.lit(True)).otherwise(F.raise_error(F.lit(f"audit check {name}"))))
    return strict
