"""Classifier quality from a label column (0/1) and a score column, exact at any size.

Every function takes ``by``: the columns (such as a model name) that separate independent
evaluations. Rows without a label or a score, NaN included, are left out.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions import fixed, ratio_or_zero
from ledgerwatch.schemas import TRADEOFF_THRESHOLDS
from ledgerwatch.session import scratch_path


def _known(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))


def cumulative_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: its positives and negatives, those at or above it, and the totals.

    Rows are first collapsed to one per score and dealt out by score range, a range per task, which
    is written once. Running sums go two levels deep: totals per range (as many as tasks), then
    rows inside a range, so no task holds the whole curve.
    """
    spark = df.sparkSession
    scores = _known(df, label, score).groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    dealt = scores.repartitionByRange(F.desc("threshold")).withColumn("range", F.spark_partition_id())
    folder = scratch_path(spark, "score-ranges")
    dealt.write.parquet(folder)
    ranged = spark.read.schema(dealt.schema).parquet(folder)
    above = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = (
        ranged.groupBy(*by, "range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            *by, "range",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p0"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n0"),
            F.sum("p").over(whole).alias("all_pos"), F.sum("n").over(whole).alias("all_neg"),
        )
    )
    run = Window.partitionBy(*by, "range").orderBy(F.desc("threshold"))
    run = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(offsets, [*by, "range"]).select(
        *by, "threshold", "pos", "neg",
        (F.sum("pos").over(run) + F.col("p0")).alias("tp"),
        (F.sum("neg").over(run) + F.col("n0")).alias("fp"),
        "all_pos", "all_neg",
    )


def roc_auc(df, label, score, by=()) -> DataFrame:
    """Area under the ROC curve; a tie counts half."""
    curve = cumulative_counts(df, label, score, by)
    area = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(area), F.max(F.col("all_pos").cast("double") * F.col("all_neg"))).alias("roc_auc")
    )


def average_precision(df, label, score, by=()) -> DataFrame:
    """Step-wise sum of precision over recall gains."""
    curve = cumulative_counts(df, label, score, by)
    step = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return curve.groupBy(*by).agg(
        F.try_divide(F.sum(step), F.max("all_pos").cast("double")).alias("pr_auc")
    )


def roc_points(df, label, score, by=()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin at an infinite threshold."""
    curve = cumulative_counts(df, label, score, by)
    points = curve.select(
        *by, "threshold",
        F.try_divide(F.col("fp").cast("double"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_pos")).alias("tpr"),
    )
    origin = _known(df, label, score).groupBy(*by).agg(F.lit(float("inf")).alias("threshold"))
    return points.unionByName(origin.select(*by, "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")))


def pr_points(df, label, score, by=()) -> DataFrame:
    """(threshold, precision, recall, baseline) per distinct score, and the end at recall 0."""
    curve = cumulative_counts(df, label, score, by)
    baseline = F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))
    points = curve.select(
        *by, "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_pos")).alias("recall"),
        baseline.alias("baseline"),
    )
    end = (
        _known(df, label, score).groupBy(*by)
        .agg((F.count_if(F.col(label) == 1) / F.count("*")).alias("baseline"))
        .select(
            *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
            F.lit(0.0).alias("recall"), "baseline",
        )
    )
    return points.unionByName(end)


def _cells(label: str, flagged: Column) -> list[Column]:
    pos, neg = F.col(label) == 1, F.col(label) == 0
    return [
        F.count_if(pos & flagged).alias("tp"), F.count_if(neg & flagged).alias("fp"),
        F.count_if(pos & ~flagged).alias("fn"), F.count_if(neg & ~flagged).alias("tn"),
    ]


def _f1(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(2 * precision * recall, precision + recall)


def classification_metrics(df, label, score, threshold=0.5, by=()) -> DataFrame:
    """Accuracy, precision, recall and F1, 0 where a denominator is empty."""
    counts = _known(df, label, score).groupBy(*by).agg(*_cells(label, F.col(score) >= threshold))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return counts.select(
        *by,
        fixed(ratio_or_zero(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        fixed(precision, 4).alias("precision"),
        fixed(recall, 4).alias("recall"),
        fixed(_f1(precision, recall), 4).alias("f1"),
    )


def full_metrics(df, label, score, threshold=0.5, by=()) -> DataFrame:
    """The comparison line: classification metrics with both areas, four digits."""
    curve = cumulative_counts(df, label, score, by)
    flagged = F.col("threshold") >= threshold
    pos, neg = F.col("pos"), F.col("neg")
    none = F.lit(0)
    counts = curve.groupBy(*by).agg(
        F.sum(F.when(flagged, pos).otherwise(none)).alias("tp"),
        F.sum(F.when(flagged, neg).otherwise(none)).alias("fp"),
        F.sum(F.when(flagged, none).otherwise(pos)).alias("fn"),
        F.sum(F.when(flagged, none).otherwise(neg)).alias("tn"),
        F.try_divide(
            F.sum(neg * (F.col("tp") - pos / 2)), F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
        ).alias("roc"),
        F.try_divide(
            F.sum(pos * F.col("tp") / (F.col("tp") + F.col("fp"))), F.max("all_pos").cast("double")
        ).alias("pr"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return counts.select(
        *by,
        fixed(ratio_or_zero(tp + tn, tp + fp + fn + tn), 4).alias("accuracy"),
        fixed(precision, 4).alias("precision"),
        fixed(recall, 4).alias("recall"),
        fixed(_f1(precision, recall), 4).alias("f1"),
        fixed(F.col("roc"), 4).alias("roc_auc"),
        fixed(F.col("pr"), 4).alias("pr_auc"),
    )


def confusion_matrix(df, label, score, threshold, by=()) -> DataFrame:
    """All four cells with their share of the actual class in percent."""
    counts = _known(df, label, score).groupBy(*by).agg(*_cells(label, F.col(score) >= threshold))
    cells = [(0, 0, "tn", "fp"), (0, 1, "fp", "tn"), (1, 0, "fn", "tp"), (1, 1, "tp", "fn")]
    return counts.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"),
                        F.col(cell).alias("transactions"),
                        F.try_divide(F.col(cell) * 100.0, (F.col(cell) + F.col(other)).cast("double"))
                        .alias("row_percent"),
                    )
                    for actual, predicted, cell, other in cells
                ]
            )
        ),
    )


def threshold_tradeoffs(
    df, label, score, thresholds: Sequence[float] = tuple(TRADEOFF_THRESHOLDS), by=()
) -> DataFrame:
    """Counts and metrics at every threshold, from one pass over the scores."""
    aggs = []
    for i, t in enumerate(thresholds):
        aggs += [c.alias(f"{n}{i}") for c, n in zip(_cells(label, F.col(score) >= t), ("tp", "fp", "fn", "tn"))]
    counts = _known(df, label, score).groupBy(*by).agg(*aggs)
    lines = counts.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("threshold"),
                        *[F.col(f"{n}{i}").alias(n) for n in ("tp", "fp", "fn", "tn")],
                    )
                    for i, t in enumerate(thresholds)
                ]
            )
        ),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return lines.select(*by, "threshold", *tradeoff_metrics(tp, fp, fn), "tp", "fp", "fn", "tn")


def tradeoff_metrics(tp: Column, fp: Column, fn: Column) -> list[Column]:
    precision = tp / F.greatest(F.lit(1), tp + fp)
    recall = tp / F.greatest(F.lit(1), tp + fn)
    f1 = 2 * (precision * recall) / F.greatest(F.lit(1e-6), precision + recall)
    return [
        fixed(precision, 4).alias("precision"), fixed(recall, 4).alias("recall"), fixed(f1, 4).alias("f1")
    ]


def classification_report(df, label, score, threshold, by=()) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy, macro and weighted lines."""
    counts = _known(df, label, score).groupBy(*by).agg(*_cells(label, F.col(score) >= threshold))
    return report_from_counts(counts, by)


def report_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    sides = counts.select(
        *by,
        ratio_or_zero(tn, tn + fn).alias("p0"), ratio_or_zero(tn, tn + fp).alias("r0"),
        ratio_or_zero(tp, tp + fp).alias("p1"), ratio_or_zero(tp, tp + fn).alias("r1"),
        (tn + fp).alias("n0"), (tp + fn).alias("n1"),
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("acc"),
    ).select("*", _f1(F.col("p0"), F.col("r0")).alias("f0"), _f1(F.col("p1"), F.col("r1")).alias("f1"))
    n0, n1 = F.col("n0"), F.col("n1")

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("line"),
            fixed(precision, 4).alias("precision"), fixed(recall, 4).alias("recall"),
            fixed(f1, 4).alias("f1_score"), support.alias("support"),
        )

    def mean(stem, w0, w1):
        return ratio_or_zero(F.col(f"{stem}0") * w0 + F.col(f"{stem}1") * w1, w0 + w1)

    one, blank = F.lit(1), F.lit(None).cast("double")
    return sides.select(
        *by,
        F.inline(
            F.array(
                line("Legitimate", F.col("p0"), F.col("r0"), F.col("f0"), n0),
                line("Fraudulent", F.col("p1"), F.col("r1"), F.col("f1"), n1),
                line("accuracy", blank, blank, F.col("acc"), n0 + n1),
                line("macro avg", *[mean(m, one, one) for m in "prf"], n0 + n1),
                line("weighted avg", *[mean(m, n0, n1) for m in "prf"], n0 + n1),
            )
        ),
    )
