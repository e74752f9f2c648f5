"""Reads of the audit table: one record, pages, alerts and the KPI summary."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions import dec_sum, fixed, half_up, is_fraud, iso_timestamp, ratio_or_zero
from ledgerwatch.operators.selection import OrderStatistics

SORTED_PAGE_ROWS = 100_000


def record(df: DataFrame) -> DataFrame:
    """Audit rows with the insert time as ISO text."""
    return df.withColumn("created_at", iso_timestamp(F.col("created_at")))


def audit_record(scored: DataFrame, *keep: str) -> DataFrame:
    """Scored payloads in the columns of the audit table, without id and insert time."""
    actual = F.col("actual_class") if "actual_class" in scored.columns else F.lit(None).cast("int")
    return scored.select(
        "transaction_id",
        F.col("Time").alias("transaction_time"),
        F.col("Amount").alias("amount"),
        actual.alias("actual_class"),
        F.col("prediction").alias("predicted_class"),
        "fraud_probability", "risk_score", "risk_level", *keep,
    )


def get_by_id(tx: DataFrame, transaction_id: str) -> DataFrame:
    return tx.sparkSession.sql(
        "SELECT * FROM {tx} WHERE transaction_id = :id", args={"id": transaction_id}, tx=tx
    )


def _in_range(name: str, value: int, low: int, high: int | None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} must be between {low} and {high}: {value}")


def list_transactions(
    tx: DataFrame, skip: int = 0, limit: int = 50, risk_level: str | None = None
) -> DataFrame:
    """A page of the newest rows, optionally of one band; the id breaks ties.

    Rows without an insert time or an id have no place in the order and are on no page.
    Shallow pages are a top-k. A deep page is first located by exact selection on time, then
    on id among equal times, so it sorts the rows of the page and not those before it.
    """
    _in_range("skip", skip, 0, None)
    _in_range("limit", limit, 1, 500)
    rows = tx.where("created_at is not null and id is not null")
    rows = rows.where(F.col("risk_level") == risk_level.upper()) if risk_level else rows
    if skip + limit > SORTED_PAGE_ROWS:
        rows, skip = _seek(rows, skip, limit)
    return rows.orderBy(F.desc("created_at"), "id").offset(skip).limit(limit)


def _micros(rows: DataFrame) -> Column:
    if dict(rows.dtypes)["created_at"] == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("created_at"))
    return F.unix_micros("created_at")


def _seek(rows: DataFrame, skip: int, limit: int) -> tuple[DataFrame, int]:
    """(rows that include the page, how many of them come before it)."""
    micros = _micros(rows)
    newest_first = OrderStatistics(rows, {"t": -micros})
    total = newest_first.count("t")
    if skip >= total:
        return rows.limit(0), 0
    last = min(skip + limit, total) - 1
    found = newest_first.locate({"t": [skip, last]})
    first_t, last_t = found["t", skip], found["t", last]
    kept, before = (-micros).between(first_t.value, last_t.value), skip - first_t.below
    if before:
        tied = rows.where(-micros == first_t.value)
        cut = OrderStatistics(tied, {"id": F.col("id")}).locate({"id": [before]})["id", before]
        kept = kept & ~((-micros == first_t.value) & (F.col("id") < cut.value))
    return rows.where(kept), 0


def high_risk(tx: DataFrame, limit: int = 50) -> DataFrame:
    """The most probable high-risk rows; the id breaks ties."""
    _in_range("limit", limit, 1, 200)
    return tx.where("risk_level = 'HIGH'").orderBy(F.desc("fraud_probability"), "id").limit(limit)


def fraud_summary(tx: DataFrame) -> DataFrame:
    """The KPI summary from one aggregate; all zero on an empty table."""
    return summary_from(tx.agg(*summary_aggregates()))


def summary_aggregates() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.count_if(is_fraud()).alias("fraud"),
        dec_sum(F.when(is_fraud(), F.col("amount"))).alias("exposure"),
        dec_sum(F.col("amount")).alias("total"),
        F.count("amount").alias("known"),
        *[F.count_if(F.col("risk_level") == v).alias(v.lower()) for v in ("LOW", "MEDIUM", "HIGH")],
    ]


def summary_from(aggregate: DataFrame, *keys: str) -> DataFrame:
    zero = F.lit(0.0)
    return aggregate.select(
        *keys,
        F.col("n").alias("total_transactions"),
        F.col("fraud").alias("fraud_transactions"),
        (F.col("n") - F.col("fraud")).alias("legitimate_transactions"),
        fixed(ratio_or_zero(F.col("fraud"), F.col("n")) * 100, 2).alias("fraud_rate_pct"),
        F.coalesce(half_up(F.col("exposure"), 2), zero).alias("total_fraud_exposure_amount"),
        fixed(ratio_or_zero(F.col("total"), F.col("known")), 2).alias("avg_transaction_amount"),
        F.create_map(
            F.lit("LOW"), F.col("low"), F.lit("MEDIUM"), F.col("medium"), F.lit("HIGH"), F.col("high")
        ).alias("risk_distribution"),
    )


def flat_summary(summary: DataFrame) -> DataFrame:
    """The band counts of a summary as three columns."""
    bands = F.col("risk_distribution")
    return summary.select(
        *[c for c in summary.columns if c != "risk_distribution"],
        *[bands[v].alias(f"risk_{v.lower()}") for v in ("LOW", "MEDIUM", "HIGH")],
    )
