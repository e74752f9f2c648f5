"""Profiles of a raw transaction table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions import ratio_or_zero
from ledgerwatch.operators.selection import exact_quantiles
from ledgerwatch.schemas import LABEL


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: type, missing count and percentage, and the missing cells of the table."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    types = [f.dataType.simpleString() for f in df.schema.fields]
    cells = sum((F.col(f"n{i}") for i in range(len(df.columns))), F.lit(0))
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[i]).alias("data_type"),
                F.col(f"n{i}").alias("missing_count"),
                (ratio_or_zero(F.col(f"n{i}"), F.col("rows")) * 100).alias("missing_percent"),
                cells.alias("total_missing_cells"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(lines))


def shape_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, and the rows that repeat an earlier one."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.round(ratio_or_zero(F.sum(F.col("copies") - 1), F.sum("copies")) * 100, 4)
        .alias("duplicate_percentage"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        value = F.when(~is_missing(df, c), F.col(c).cast("double"))
        aggs += [
            F.count(value).alias(f"count{i}"), F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"{part}{i}").alias(part) for part in ("count", "mean", "std", "min")],
            *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c])],
            F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def target_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and percentage per class (null labels are not a class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("transactions"))
    whole = F.sum("transactions").over(Window.partitionBy())
    return counts.select(
        F.col(label),
        "transactions",
        (F.col("transactions") * 100.0 / whole).alias("percentage"),
    )


def target_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Fraud and legitimate counts, fraud percentage and whole imbalance ratio."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("fraud_count"),
        F.count_if(F.col(label) == 0).alias("legitimate_count"),
        F.count(label).alias("n"),
    )
    return counts.select(
        "fraud_count",
        "legitimate_count",
        (ratio_or_zero(F.col("fraud_count"), F.col("n")) * 100).alias("fraud_percentage"),
        F.floor(F.col("legitimate_count") / F.greatest(F.lit(1), F.col("fraud_count")))
        .alias("imbalance_ratio"),
    )
