"""Transaction tables derived from the event and embedding tables of a data folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import predicted_label, risk_level, risk_score, stored_probability
from ledgerwatch.schemas import RAW_COLUMNS, V_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sixteenth_power(u: float) -> float:
    for _ in range(4):
        u *= u
    return u


def with_model_probability(events: DataFrame) -> DataFrame:
    """A skewed, tie-rich probability per event: u ** 16 by squaring, u one of 997 steps in [0, 1).

    The 997 powers are one constant array, so a filter on a column made from ``p`` does not
    repeat the arithmetic for every use.
    """
    powers = F.expr("array({})".format(", ".join(f"{_sixteenth_power(k / 997.0)!r}D" for k in range(997))))
    step = F.pmod(F.col("event_id") * 7919 + 104729, F.lit(997)).cast("int")
    return events.withColumn("u", step / F.lit(997.0)).withColumn("p", F.get(powers, step))


def audit_rows(events: DataFrame) -> DataFrame:
    """Events as rows of the scored audit table, event by event."""
    confirmed = ((F.col("u") > 0.95) & (F.col("event_id") % 5 != 0)) | (F.col("event_id") % 211 == 0)
    scored = with_model_probability(events).withColumn("risk_score", risk_score(F.col("p")))
    return scored.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("TX_"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
        .cast("double").alias("transaction_time"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "view", F.lit(None))
        .when(confirmed, 1).otherwise(0).cast("int").alias("actual_class"),
        predicted_label(F.col("p")).alias("predicted_class"),
        stored_probability(F.col("p")).alias("fraud_probability"),
        "risk_score",
        risk_level(F.col("risk_score")).alias("risk_level"),
        F.col("ts").alias("created_at"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_rows(table(spark, sf_dir, "events"))


def raw_rows(embeddings: DataFrame) -> DataFrame:
    """31 raw columns plus ``row_id`` and the group ``label`` they came from."""
    vec_id = F.col("vec_id")
    return embeddings.select(
        vec_id.alias("row_id"),
        F.pmod(vec_id * 347, F.lit(172800)).cast("double").alias("Time"),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(V_COLUMNS)],
        (F.pmod(vec_id * 7919 + 13, F.lit(50000)) / F.lit(100.0)).alias("Amount"),
        F.when(F.col("label") == 9, 1).otherwise(0).alias("Class"),
        F.col("label"),
    )


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_rows(table(spark, sf_dir, "embeddings"))


def transactions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table with nulls, NaN, infinities and repeated rows in whole label groups."""
    raw = transactions_raw(spark, sf_dir)
    dirty = raw.withColumns(
        {
            "V1": F.when(F.col("label") != 5, F.col("V1")),
            "V2": F.when(F.col("label") == 6, F.lit(float("nan"))).otherwise(F.col("V2")),
            "Amount": F.when(F.col("label") == 7, F.lit(float("inf"))).otherwise(F.col("Amount")),
        }
    )
    return dirty.union(dirty.where("label = 3")).select(*RAW_COLUMNS)
