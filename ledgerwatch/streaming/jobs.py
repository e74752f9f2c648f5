"""Stream scoring, idempotent ingest, rolling KPIs and alerts.

Each job reuses the batch plan inside ``foreachBatch`` or as a streaming aggregate. Sinks are
keyed by id or by batch number, so a batch that is run again leaves the same result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerwatch.operators.validate import with_reasons
from ledgerwatch.plans.exploration import bin_counts, week_of
from ledgerwatch.plans.kpi import audit_record, summary_aggregates, summary_from
from ledgerwatch.plans.scoring import Scorer, score
from ledgerwatch.sources.audit import upsert, utc_day
from ledgerwatch.sources.raw import is_folder, path_exists


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files at ``path`` as a stream with an explicit schema.

    A plain path must be a folder; a single file is given as a pattern that matches only itself.
    """
    path = path.rstrip("/")
    if path.endswith(".parquet") and not is_folder(spark, path):
        path = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def utc_instant(ts: Column) -> Column:
    """A zone-less UTC time as a timestamp, whatever the session's zone."""
    return F.timestamp_micros(
        F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)
    )


def utc_date(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


#: By default a job takes what is there and ends; {"processingTime": "1 minute"} runs on.
ONCE = {"availableNow": True}


def _start(writer, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def upsert_stream(stream: DataFrame, table: str, order: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Audit rows into the table; the last record of an id wins, across batches too."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, table, batch, order)

    return _start(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def first_wins(stream: DataFrame, time: str = "created_at", delay: str = "1 hour") -> DataFrame:
    """Rows whose id did not come before within the watermark delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["transaction_id"])


def score_stream(
    payloads: DataFrame, scorer: Scorer, table: str, quarantine: str, checkpoint: str,
    received: str = "received_at", trigger: dict = ONCE,
) -> StreamingQuery:
    """Validate, score and store payloads; rejected ones go to ``quarantine`` with reasons."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = with_reasons(batch).persist()
        (
            marked.where(F.size("reasons") > 0).withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(quarantine)
        )
        known = marked.where(F.size("reasons") == 0).drop("reasons")
        timed = known.withColumns({"created_at": F.col(received), "received": F.col(received)})
        good = score(timed, scorer, factors=0)
        rows = audit_record(good, "created_at", "received")
        upsert(spark, table, rows, "received")
        marked.unpersist()

    return _start(payloads.writeStream.foreachBatch(write), checkpoint, trigger)


def windowed_summary(
    tx: DataFrame, time: str = "created_at", length: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """The KPI summary per tumbling window, for streams and batches."""
    return tx.withWatermark(time, delay).groupBy(F.window(time, length)).agg(*summary_aggregates())


def summary_stream(tx: DataFrame, sink: str, checkpoint: str, trigger: dict = ONCE, **window: str) -> StreamingQuery:
    """Keep the changed windows of every batch below ``sink``; read with ``latest_summary``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(sink)
        )

    writer = windowed_summary(tx, **window).writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, checkpoint, trigger)


def latest_summary(spark: SparkSession, sink: str) -> DataFrame:
    """The newest state of every window."""
    rows = spark.read.parquet(sink)
    fields = [c for c in rows.columns if c not in {"window", "batch_id"}]
    newest = rows.groupBy("window").agg(F.max(F.struct("batch_id", *fields)).alias("s")).select(
        F.col("window.start").alias("window_start"), *[F.col(f"s.{c}").alias(c) for c in fields]
    )
    return summary_from(newest, "window_start")


def _of_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's rows; a batch that is run again replaces its own."""
    numbered = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def closed_windows_stream(
    tx: DataFrame, sink: str, checkpoint: str, trigger: dict = ONCE, time: str = "created_at", length: str = "1 day",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Each window's KPI summary once, when it closes; rows that come later are kept apart.

    A window closes when the newest time seen lies ``delay`` behind its end. Every batch adds the sums of its
    rows per window below ``sink``/parts, rows of windows that closed before it to ``sink``/late, and the windows it
    closes to ``sink``/closed, then notes the time reached in ``sink``/reached. All are keyed by batch number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reached = None
        if path_exists(spark, f"{sink}/reached"):
            before = spark.read.parquet(f"{sink}/reached").where(F.col("batch_id") < batch_id)
            reached = before.agg(F.max("reached")).first()[0]
        rows = batch.withColumn("window", F.window(time, length)).persist()
        late = F.lit(False) if reached is None else F.col("window.end") <= F.lit(reached)
        _of_batch(rows.where(late).drop("window"), f"{sink}/late", batch_id)
        _of_batch(rows.where(~late).groupBy("window").agg(*summary_aggregates()), f"{sink}/parts", batch_id)
        newest = rows.agg((F.max(time) - F.expr(f"INTERVAL {delay}")).alias("t")).first()["t"]
        rows.unpersist()
        now = max((t for t in (reached, newest) if t is not None), default=None)
        if now is None:
            return
        parts = spark.read.parquet(f"{sink}/parts").where(F.col("batch_id") <= batch_id)
        closing = (F.col("window.end") <= F.lit(now)) & (F.lit(True) if reached is None else F.col("window.end") > F.lit(reached))
        sums = [F.sum(c).alias(c) for c in parts.columns if c not in ("window", "batch_id")]
        _of_batch(parts.where(closing).groupBy("window").agg(*sums), f"{sink}/closed", batch_id)
        _of_batch(spark.range(1).select(F.lit(now).alias("reached")), f"{sink}/reached", batch_id)

    return _start(tx.writeStream.foreachBatch(write), checkpoint, trigger)


def closed_summary(spark: SparkSession, sink: str) -> DataFrame:
    """The summaries of the windows closed so far."""
    rows = spark.read.parquet(f"{sink}/closed")
    return summary_from(rows.withColumn("window_start", F.col("window.start")), "window_start")


def drift_stream(
    tx: DataFrame, edges: DataFrame, features: Sequence[str], sink: str, checkpoint: str, trigger: dict = ONCE,
    time: str = "created_at",
) -> StreamingQuery:
    """Bin counts per week, added up batch by batch; read with ``weekly_counts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        week = week_of(utc_day(batch, time)).alias("week")
        _of_batch(bin_counts(batch, edges, features, week), sink, batch_id)

    return _start(tx.writeStream.foreachBatch(write), checkpoint, trigger)


def weekly_counts(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).groupBy("week", "feature", "bin").agg(F.sum("n").alias("n"))


def alert_stream(tx: DataFrame, sink: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """High-risk rows, appended as they come; the file sink writes each batch once."""
    alerts = tx.where("risk_level = 'HIGH'")
    return _start(alerts.writeStream.format("parquet").option("path", sink), checkpoint, trigger)
