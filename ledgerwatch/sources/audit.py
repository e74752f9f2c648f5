"""The audit table of scored transactions: layout, versions, upsert, lookup and late labels.

Files lie by insert day, in UTC whatever the session's zone, and by id bucket. The number of buckets
is a property of the table, set by its first write from the rows of its largest day. An upsert reads
and rewrites only the buckets and days it touches, once, as a new version of the table (see
``snapshots``): a reader sees the version it opened, whole, and an upsert that breaks off changes
nothing.
"""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.operators.validate import require_audit_rows
from ledgerwatch.schemas import TRANSACTIONS_SCHEMA
from ledgerwatch.session import scratch_path
from ledgerwatch.sources import snapshots
from ledgerwatch.sources.snapshots import ConflictingWrite

COLUMNS = TRANSACTIONS_SCHEMA.fieldNames()
DAY, BUCKET = "created_date", "id_bucket"
PARTITIONS = (DAY, BUCKET)
#: Rows of a day that a bucket is meant to hold.
BUCKET_ROWS = 1_000_000


def utc_day(df: DataFrame, time: str = "created_at") -> Column:
    """The UTC day of an instant, or the day of a zone-less time."""
    if dict(df.dtypes)[time] == "timestamp_ntz":
        return F.to_date(time)
    return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))


def id_bucket(transaction_id: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(transaction_id), buckets).cast("int")


def buckets_for(rows: DataFrame) -> int:
    """Buckets that bound those of the largest day to about ``BUCKET_ROWS`` rows."""
    largest = rows.groupBy(DAY).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    return 1 + largest // BUCKET_ROWS


def write_transactions(df: DataFrame, path: str, mode: str = "overwrite", buckets: int | None = None) -> int:
    """A new version of the table at ``path`` from audit rows; returns its number.

    ``overwrite`` replaces all rows, ``append`` adds to them. A day of any size is split over tasks of even
    size. ``buckets`` sets the number of id buckets of a new or replaced table.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append: {mode}")
    spark = df.sparkSession
    base = snapshots.latest(spark, path)
    known = snapshots.manifest(spark, path, base) if base and mode == "append" else None
    rows = df.select(*COLUMNS).withColumn(DAY, utc_day(df))
    if known is not None:
        buckets = known.agg(F.max("buckets")).first()[0]
    entries = _write(rows, path, buckets or buckets_for(rows))
    return snapshots.commit(spark, path, entries if known is None else known.unionByName(entries), base)


def _write(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write audit rows as new files; returns their manifest lines.

    Bloom filters on the id let a lookup skip files of the right bucket that do not hold it.
    """
    spark = rows.sparkSession
    name, folder = snapshots.new_write(path)
    checked = require_audit_rows(rows.select(*COLUMNS, DAY))
    checked = checked.withColumn(BUCKET, id_bucket(F.col("transaction_id"), F.lit(buckets)))
    (
        checked.hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS)
        .option("parquet.bloom.filter.enabled#transaction_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(folder)
    )
    written = spark.read.schema(f"id long, {DAY} date, {BUCKET} int").parquet(folder)
    lines = written.groupBy(*PARTITIONS).agg(F.count("*").alias("rows"), F.max("id").alias("highest_id"))
    return lines.select(F.lit(name).alias(snapshots.WRITE), "*", F.lit(buckets).alias("buckets"))


def write_transactions_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    require_audit_rows(df.select(*COLUMNS)).write.options(**options).jdbc(url, table, mode=mode)


def _opened(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """The manifest of a version, by default the latest."""
    version = snapshots.latest(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no audit table at {path}")
    return snapshots.manifest(spark, path, version)


def _rows(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    rows = snapshots.files(spark, path, entries, PARTITIONS)
    if rows is None:
        rows = spark.createDataFrame([], TRANSACTIONS_SCHEMA)
        rows = rows.withColumns({DAY: F.lit(None).cast("date"), BUCKET: F.lit(None).cast("int")})
    return rows


def read_transactions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The audit columns of one version, by default the latest, and the stored day, which prunes files.

    The frame stays with that version, whatever is written later.
    """
    return _rows(spark, path, _opened(spark, path, version)).drop(BUCKET)


def find_transaction(spark: SparkSession, path: str, transaction_id: str, version: int | None = None) -> DataFrame:
    """The row of an id: only its bucket's files are listed, and their Bloom filters are asked first."""
    wanted = id_bucket(F.lit(transaction_id), F.col("buckets"))
    entries = _opened(spark, path, version).where(F.col(BUCKET) == wanted)
    return _rows(spark, path, entries).drop(BUCKET).where(F.col("transaction_id") == transaction_id)


def latest_per_id(batch: DataFrame, order: str) -> DataFrame:
    """The last record of every id by ``order``; ``created_at`` is the id's first.

    The last record is kept by a running maximum, so a much repeated id combines in the
    map tasks instead of gathering in one.
    """
    fields = [c for c in batch.columns if c not in {"transaction_id", "created_at", order}]
    return (
        batch.groupBy("transaction_id")
        .agg(F.max(F.struct(order, *fields)).alias("last"), F.min("created_at").alias("created_at"))
        .select("transaction_id", "created_at", *[F.col(f"last.{c}").alias(c) for c in fields])
    )


def merge_records(existing: DataFrame, latest: DataFrame, keep_label: bool = False) -> DataFrame:
    """``existing`` with one record per id of ``latest`` written over it or added.

    A known row keeps its id and insert time and takes every other field, an absent label
    included; ``keep_label`` keeps a known label instead. A stored day stays as it is.
    """
    held = [c for c in existing.columns if c == DAY]
    supplied = [c for c in COLUMNS if c in latest.columns and c not in {"id", "transaction_id", "created_at"}]
    new = latest.select("transaction_id", *[F.col(c).alias(f"new_{c}") for c in latest.columns if c != "transaction_id"])
    both = existing.select(*COLUMNS, *held, F.lit(True).alias("known")).join(
        new.withColumn("touched", F.lit(True)), "transaction_id", "full"
    )
    values = {c: F.col(c) for c in COLUMNS}
    for c in supplied:
        values[c] = F.when(F.col("touched"), F.col(f"new_{c}")).otherwise(F.col(c))
    if keep_label and "actual_class" in supplied:
        values["actual_class"] = F.coalesce("new_actual_class", "actual_class")
    for c in ("id", "created_at"):
        if f"new_{c}" in both.columns:
            values[c] = F.when(F.col("known"), F.col(c)).otherwise(F.col(f"new_{c}"))
    return both.select(*[v.alias(c) for c, v in values.items()], *held)


def _numbered(rows: DataFrame, highest: int) -> DataFrame:
    """``rows`` with gapless ids above ``highest``.

    The rows and their places are written once; a part's numbers follow those of the parts before.
    """
    spark = rows.sparkSession
    folder = scratch_path(spark, "numbered")
    placed = rows.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    sizes = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_place") - F.col("_first") + F.col("_before") + highest + 1
    return placed.join(sizes, "_part").withColumn("id", number).drop("_part", "_place", "_first", "_before")


def upsert(
    spark: SparkSession, path: str, batch: DataFrame, order: str, keep_label: bool = False, attempts: int = 3
) -> int:
    """Merge a batch into the table at ``path`` as a new version; returns its number.

    Only the buckets and days that the batch touches are rewritten. If another writer commits first,
    the merge starts again from that version, ``attempts`` times in all. Running the same batch
    again changes no row. Rows new to the table get the batch's ``id`` or, where it has none, a
    number above all present ones.
    """
    latest = latest_per_id(batch, order).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for left in range(attempts - 1, -1, -1):
            base = snapshots.latest(spark, path)
            try:
                return snapshots.commit(spark, path, _merged(spark, path, latest, base, keep_label), base)
            except ConflictingWrite:
                if not left:
                    raise
    finally:
        latest.unpersist()
    raise ValueError(f"attempts must be positive: {attempts}")


def _merged(spark: SparkSession, path: str, latest: DataFrame, base: int | None, keep_label: bool) -> DataFrame:
    """Write the touched partitions with the batch merged in; returns the manifest of the whole table."""
    if base is None:
        existing, rest, highest = spark.createDataFrame([], TRANSACTIONS_SCHEMA), None, 0
        if dict(latest.dtypes)["created_at"] == "timestamp_ntz":
            existing = existing.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
        existing = existing.withColumn(DAY, F.lit(None).cast("date"))
        buckets = buckets_for(latest.withColumn(DAY, utc_day(latest)))
    else:
        entries = snapshots.manifest(spark, path, base)
        buckets, highest = entries.agg(F.max("buckets"), F.coalesce(F.max("highest_id"), F.lit(0))).first()
        buckets = buckets or buckets_for(latest.withColumn(DAY, utc_day(latest)))  # no row yet
        bucket = id_bucket(F.col("transaction_id"), F.lit(buckets))
        # Buckets are fixed in number, and days are partitions: few enough to list.
        held = [r[0] for r in latest.select(bucket).distinct().collect()]
        near = _rows(spark, path, entries.where(F.col(BUCKET).isin(held)))
        stored = near.join(latest.select("transaction_id"), "transaction_id", "semi").select(*PARTITIONS)
        new = latest.select(utc_day(latest).alias(DAY), bucket.alias(BUCKET))
        touched = spark.createDataFrame(stored.unionByName(new).distinct().collect(), f"{DAY} date, {BUCKET} int")
        existing = _rows(spark, path, entries.join(F.broadcast(touched), [*PARTITIONS], "semi")).drop(BUCKET)
        rest = entries.join(F.broadcast(touched), [*PARTITIONS], "anti")
    rows = latest
    if "id" not in latest.columns:
        known = latest.join(existing.select("transaction_id"), "transaction_id", "semi")
        fresh = _numbered(latest.join(existing.select("transaction_id"), "transaction_id", "anti"), highest)
        rows = known.withColumn("id", F.lit(None).cast("long")).unionByName(fresh)
    merged = merge_records(existing, rows, keep_label)
    entries = _write(merged.withColumn(DAY, F.coalesce(DAY, utc_day(merged))), path, buckets)
    return entries if rest is None else rest.unionByName(entries)


def attach_labels(tx: DataFrame, labels: DataFrame, order: str | None = None) -> DataFrame:
    """Late ground truth: (transaction_id, actual_class) written over the stored label.

    Of several labels for an id the last by ``order`` counts, the larger among equals.
    """
    last = F.max(F.struct(*([order] if order else []), "actual_class"))["actual_class"]
    known = labels.where("actual_class is not null").groupBy("transaction_id").agg(last.alias("late_class"))
    return (
        tx.join(known, "transaction_id", "left")
        .withColumn("actual_class", F.coalesce("late_class", "actual_class"))
        .select(*tx.columns)
    )
