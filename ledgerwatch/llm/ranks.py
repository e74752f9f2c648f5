"""Positions of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import staged


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``part`` (int), ``pos`` (from 0, in order, within the group) and ``size`` (rows of the group).

    Rows are dealt by ranges of group and order and written once; a range counts its own rows, and a
    group adds up its ranges, so no group is sorted in one task. ``group`` columns hold no nulls;
    nulls come first in ``order``, whose columns together are distinct within a group.
    """
    dealt = rows.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*group, *order]])
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()), name)
    held = dealt.groupBy("part", *group).agg(F.count("*").alias("_rows"))  # a row per range and group
    whole = Window.partitionBy(*group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "part", *group, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("size")
    )
    inside = Window.partitionBy("part", *group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = dealt.withColumn("_inside", F.row_number().over(inside) - 1).join(held, ["part", *group])
    return placed.withColumn("pos", (F.col("_before") + F.col("_inside")).cast("long")).drop("_before", "_inside")
