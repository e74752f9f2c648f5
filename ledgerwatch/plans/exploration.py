"""Exploratory data sets over cleaned raw transactions, and feature drift."""

from collections.abc import Sequence
from math import log10, pi, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions import hour_bucket, ratio_or_zero
from ledgerwatch.operators.selection import exact_quantiles
from ledgerwatch.schemas import LABEL

DENSITY_FEATURES = ["V14", "V17", "V12", "V4"]


def hourly_labels(df: DataFrame) -> DataFrame:
    """Transactions, fraud and fraud percentage per hour, on ground truth."""
    return (
        df.groupBy(hour_bucket(F.col("Time")).alias("hour"))
        .agg(F.count(LABEL).alias("total"), F.sum(LABEL).alias("fraud"))
        .withColumn("fraud_rate_pct", F.try_divide(F.col("fraud") * 100.0, F.col("total").cast("double")))
    )


def amount_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Per class: ``bins`` bins of equal width on a log scale, positive amounts only."""
    positive = df.where("Amount > 0")
    ends = positive.groupBy(LABEL).agg(F.min("Amount").alias("lo"), F.max("Amount").alias("hi"))
    out = None
    for row in ends.where(F.col(LABEL).isin(0, 1)).orderBy(LABEL).collect():
        low, high = log10(row["lo"]), log10(row["hi"])
        width = (high - low) / bins or 1.0
        at = F.least(F.floor((F.log10("Amount") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        part = (
            positive.where(F.col(LABEL) == row[LABEL])
            .groupBy(F.col(LABEL), at.cast("int").alias("bin")).agg(F.count("*").alias("transactions"))
            .select(
                LABEL, "bin",
                F.pow(F.lit(10.0), F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
                F.pow(F.lit(10.0), F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
                "transactions",
            )
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no positive amount with a known class")
    return out


def class_densities(
    df: DataFrame, features: Sequence[str] = tuple(DENSITY_FEATURES), grid: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density per feature and class on an even grid.

    Scott's bandwidth, the grid reaching ``cut`` bandwidths past the data. Every row adds to
    every grid point of its class; the sums combine before the shuffle, which carries only
    features x classes x grid rows per task.
    """
    long = df.where(F.col(LABEL).isin(0, 1)).select(
        F.col(LABEL),
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in features]))
        .alias("v"),
    ).select(LABEL, "v.*").where(F.col("x").isNotNull() & ~F.isnan("x"))
    stats = long.groupBy("feature", LABEL).agg(
        F.count("*").alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("lo"), F.max("x").alias("hi")
    ).collect()  # features x 2 rows
    param = {}
    for s in stats:
        if s["sd"]:
            h = s["sd"] * s["n"] ** -0.2
            low, high = s["lo"] - cut * h, s["hi"] + cut * h
            param[s["feature"], s[LABEL]] = (h, low, (high - low) / (grid - 1), s["n"])

    def pick(i: int):
        col = None
        for (f, c), p in param.items():
            cond = (F.col("feature") == f) & (F.col(LABEL) == c)
            col = F.when(cond, F.lit(float(p[i]))) if col is None else col.when(cond, F.lit(float(p[i])))
        return col

    if not param:
        raise ValueError("no feature varies within a class")
    z = (F.col("low") + F.col("point") * F.col("step") - F.col("x")) / F.col("h")
    return (
        long.withColumns({"h": pick(0), "low": pick(1), "step": pick(2), "n": pick(3)})
        .where(F.col("h").isNotNull())
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .groupBy("feature", LABEL, "point", "h", "low", "step", "n")
        .agg(F.sum(F.exp(z * z * -0.5)).alias("k"))
        .select(
            "feature", LABEL, "point",
            (F.col("low") + F.col("point") * F.col("step")).alias("x"),
            (F.col("k") / (F.col("n") * F.col("h") * F.lit(sqrt(2 * pi)))).alias("density"),
        )
    )


def amount_facts(df: DataFrame) -> DataFrame:
    """Median amount per class and the shares under 2 and over 1,000."""
    series = {str(c): F.when(F.col(LABEL) == c, F.col("Amount").cast("double")) for c in (0, 1)}
    medians = exact_quantiles(df, series, [0.5])
    median = F.when(F.col(LABEL) == 1, F.lit(medians["1"][0])).otherwise(F.lit(medians["0"][0]))
    return (
        df.where(F.col(LABEL).isin(0, 1)).groupBy(LABEL)
        .agg(
            F.count("*").alias("transactions"),
            F.count_if(F.col("Amount") < 2).alias("small"), F.count_if(F.col("Amount") > 1000).alias("large"),
        )
        .select(
            LABEL, "transactions", median.cast("double").alias("median_amount"),
            (ratio_or_zero(F.col("small"), F.col("transactions")) * 100).alias("pct_under_2"),
            (ratio_or_zero(F.col("large"), F.col("transactions")) * 100).alias("pct_over_1000"),
        )
    )


def drift_index(
    baseline: DataFrame, recent: DataFrame, features: Sequence[str], bins: int = 10,
    floor_share: float = 1e-4, alert_above: float = 0.25,
) -> DataFrame:
    """Population stability index per feature, binned at the baseline's quantiles."""
    edges = exact_quantiles(baseline, features, [i / bins for i in range(1, bins)])
    known = [f for f in features if edges[f][0] is not None]
    cuts = [f"e{j}" for j in range(bins - 1)]
    table = baseline.sparkSession.createDataFrame(
        [(i, f, *edges[f]) for i, f in enumerate(known)],
        "i int, feature string, " + ", ".join(f"{c} double" for c in cuts),
    )

    def counted(df: DataFrame, name: str) -> DataFrame:
        values = df.select(F.posexplode(F.array(*[F.col(f).cast("double") for f in known])).alias("i", "v"))
        at = sum(((F.col("v") > F.col(c)).cast("int") for c in cuts), F.lit(0))
        return (
            values.where(F.col("v").isNotNull() & ~F.isnan("v")).join(F.broadcast(table), "i")
            .groupBy("feature", at.alias("bin")).agg(F.count("*").alias(name))
        )

    both = counted(baseline, "e").join(counted(recent, "a"), ["feature", "bin"], "full").fillna(0, ["e", "a"])
    whole = Window.partitionBy("feature")
    share = both.select(
        "feature", "bin",
        (F.col("e") / F.sum("e").over(whole)).alias("e"), (F.col("a") / F.sum("a").over(whole)).alias("a"),
    )
    # A bin empty on both sides adds floor - floor = 0, so absent bins need no row.
    e, a = F.greatest(F.col("e"), F.lit(floor_share)), F.greatest(F.col("a"), F.lit(floor_share))
    return share.groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi")).select(
        "feature", "psi", (F.col("psi") > alert_above).alias("alert")
    )


def drift_edges(baseline: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, edges): the baseline's quantiles; a feature without a value is left out."""
    edges = exact_quantiles(baseline, features, [i / bins for i in range(1, bins)])
    lines = [(f, [float(e) for e in edges[f]]) for f in features if edges[f][0] is not None]
    return baseline.sparkSession.createDataFrame(lines, "feature string, edges array<double>")


def bin_counts(df: DataFrame, edges: DataFrame, features: Sequence[str], *by: Column) -> DataFrame:
    """Rows per feature and bin (and ``by``). Counts of parts of a table add up to those of the whole."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    rows = df.select(*by, F.explode(pairs).alias("x")).select("*", "x.feature", "x.v").drop("x")
    rows = rows.where("v is not null and not isnan(v)").join(F.broadcast(edges), "feature")  # a line per feature
    bin = F.size(F.filter("edges", lambda e: e < F.col("v"))).alias("bin")
    keys = [c for c in rows.columns if c not in ("feature", "v", "edges")]
    return rows.groupBy(*keys, "feature", bin).agg(F.count("*").alias("n"))


def week_of(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.date_sub(day, F.weekday(day))


def weekly_drift(baseline: DataFrame, weeks: DataFrame, floor_share: float = 1e-4, alert_above: float = 0.25) -> DataFrame:
    """(week, feature, transactions, psi, alert) from bin counts of the baseline and of each week.

    Both are sums of ``bin_counts``; a week's index is against the baseline's shares, each at least ``floor_share``.
    """
    whole = Window.partitionBy("feature")
    expected = baseline.select("feature", "bin", (F.col("n") / F.sum("n").over(whole)).alias("e"))
    asked = weeks.select("week", "feature").distinct().join(expected, "feature")
    both = asked.join(weeks, ["week", "feature", "bin"], "full").fillna(0, ["e", "n"])
    own = Window.partitionBy("week", "feature")
    both = both.withColumn("total", F.sum("n").over(own))
    e, a = F.greatest("e", F.lit(floor_share)), F.greatest(F.col("n") / F.col("total"), F.lit(floor_share))
    found = both.groupBy("week", "feature").agg(F.sum("n").alias("transactions"), F.sum((a - e) * F.ln(a / e)).alias("psi"))
    return found.withColumn("alert", F.col("psi") > alert_above)
