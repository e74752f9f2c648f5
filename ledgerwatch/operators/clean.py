"""Cleaning of raw transactions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions import finite, ratio_or_zero
from ledgerwatch.operators.selection import exact_quantiles
from ledgerwatch.operators.validate import validate_schema
from ledgerwatch.schemas import LABEL
from ledgerwatch.sources.raw import load_raw, read_cleaned, write_cleaned

RETAIN = (
    "Keep every outlier: large amounts are both genuine spending and fraud; the log amount "
    "and robust scaling limit their pull on a model."
)


def impute(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Infinities become missing, then every missing number becomes its column's median.

    Medians are taken only for the columns that need one, all in the same passes.
    """
    numeric = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    floating = [c for c, t in numeric.items() if isinstance(t, (T.DoubleType, T.FloatType))]
    known = df.withColumns({c: finite(F.col(c)) for c in floating})
    candidates = [c for c in numeric if c != label]
    counts = known.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in candidates]).first()
    holes = [c for c in candidates if counts[c]]
    if not holes:
        return known
    medians = exact_quantiles(known, holes, [0.5])
    fill = {c: m for c, (m,) in medians.items() if m is not None}
    return known.withColumns(
        {c: F.coalesce(F.col(c), F.lit(m).cast(numeric[c])) for c, m in fill.items()}
    )


def _with_copies(df: DataFrame, name: str = "_copies") -> DataFrame:
    """The distinct rows with how often each occurs: one shuffle of whole rows, combined in the map tasks first."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(name))


def count_duplicates(df: DataFrame) -> int:
    """Rows that repeat an earlier row in every column."""
    return _with_copies(df).agg(F.sum(F.col("_copies") - 1)).first()[0] or 0


def drop_repeats(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def handle_duplicates(df: DataFrame, drop: bool = True, cached: list[DataFrame] | None = None) -> tuple[DataFrame, int]:
    """(the table without whole-row repeats, how many there were), from one pass over the rows.

    The distinct rows are persisted; they are appended to ``cached``, for the caller to unpersist.
    """
    if not drop:
        return df, count_duplicates(df)
    distinct = _with_copies(df).persist()
    if cached is not None:
        cached.append(distinct)
    n = distinct.agg(F.sum(F.col("_copies") - 1)).first()[0] or 0
    return distinct.drop("_copies"), n


def analyze_outliers(df: DataFrame, amount: str = "Amount", label: str = LABEL) -> DataFrame:
    """One row about the amounts above the upper fence. No row is ever dropped."""
    q1, q3 = exact_quantiles(df, [amount], [0.25, 0.75])[amount]
    q1, q3 = (float("nan") if q is None else q for q in (q1, q3))
    iqr = q3 - q1
    above = F.col(amount) > F.lit(q3 + 1.5 * iqr)
    fraud = F.sum(F.when(above, F.col(label))) if label in df.columns else F.lit(0)
    counts = df.agg(
        F.count("*").alias("n"), F.count_if(above).alias("out"),
        F.coalesce(fraud, F.lit(0)).cast("long").alias("fraud"),
    )
    return counts.select(
        F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(iqr).alias("iqr"),
        F.lit(q3 + 1.5 * iqr).alias("upper_bound"),
        F.col("out").alias("total_outliers"),
        F.round(ratio_or_zero(F.col("out"), F.col("n")) * 100, 2).alias("outlier_percentage"),
        F.col("fraud").alias("fraud_count_in_outliers"),
        F.round(F.col("fraud") / F.greatest(F.lit(1), F.col("out")) * 100, 2)
        .alias("fraud_rate_in_outliers"),
        F.lit(RETAIN).alias("recommendation"),
    )


def clean_dataset(
    spark: SparkSession, source: str, target: str, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """Validate, impute, drop repeats and write; returns (cleaned table, outlier summary).

    The summary reads the written table, so the cleaning runs once.
    """
    raw = load_raw(spark, source, fmt)
    validate_schema(raw)
    write_cleaned(drop_repeats(impute(raw)), target)
    cleaned = read_cleaned(spark, target)
    return cleaned, analyze_outliers(cleaned)
