"""Engineered features, the stratified split, and exact robust scaling."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.selection import exact_quantiles, pick_smallest_hashes
from ledgerwatch.schemas import FALLBACK_MEDIAN_AMOUNT, LABEL, SEED, TEST_SHARE


def fit_median_amount(train: DataFrame) -> float:
    """The median amount of the training rows, the only fitted feature parameter."""
    if "Amount" not in train.columns:
        return FALLBACK_MEDIAN_AMOUNT
    median = exact_quantiles(train, ["Amount"], [0.5])["Amount"][0]
    return FALLBACK_MEDIAN_AMOUNT if median is None else median


def feature_sql(columns: Sequence[str], median_amount: float) -> dict[str, str]:
    """Name -> SQL expression of the five engineered features."""
    if "Time" in columns:
        hour = "pmod(Time / 3600.0D, 24.0D)"
        out = {
            "hour_of_day": hour,
            "sin_hour": f"sin(2 * pi() * {hour} / 24.0D)",
            "cos_hour": f"cos(2 * pi() * {hour} / 24.0D)",
        }
    else:
        out = {"hour_of_day": "12.0D", "sin_hour": "0.0D", "cos_hour": "-1.0D"}
    if "Amount" in columns:
        out["log_amount"] = "log1p(greatest(0.0D, Amount))"
        out["amount_ratio"] = f"Amount / {max(1.0, median_amount)!r}D"
    else:
        out |= {"log_amount": "0.0D", "amount_ratio": "1.0D"}
    return out


def add_features(df: DataFrame, median_amount: float) -> DataFrame:
    return df.withColumns({c: F.expr(e) for c, e in feature_sql(df.columns, median_amount).items()})


def select_features(columns: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    """All columns but the raw time, the label and the caller's keys."""
    return [c for c in columns if c not in {"Time", LABEL, *exclude}]


def split_sizes(class_counts: Mapping[int, int], test_size: float) -> dict[int, int]:
    """Test rows per class: the test share rounded up, spread by largest remainder.

    The remainders are those of the training share, as in the usual stratified shuffle.
    """
    total = sum(class_counts.values())
    train_total = total - ceil(total * test_size)
    exact = {c: n * train_total / total for c, n in class_counts.items()}
    train = {c: floor(x) for c, x in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (train[c] - exact[c], c))
    for c in by_remainder[: train_total - sum(train.values())]:
        train[c] += 1
    return {c: n - train[c] for c, n in class_counts.items()}


def content_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """A 128-bit key of the row's whole content, for de-duplicated tables without a key."""
    cols = [part for c in df.columns for part in (F.col(c).isNull(), F.col(c))]  # hashing skips nulls
    return df.withColumn(
        name, F.concat(F.hex(F.xxhash64(*cols)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *cols)))
    )


def class_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    """Rows of class 0 and of class 1; any other label is an error."""
    if label not in df.columns:
        raise ValueError(f"no label column {label}")
    one = F.col(label)
    n = df.agg(
        F.count("*").alias("all"), F.count_if(one == 0).alias("c0"), F.count_if(one == 1).alias("c1")
    ).first()
    if n["all"] != n["c0"] + n["c1"]:
        raise ValueError(f"{n['all'] - n['c0'] - n['c1']} rows have a label other than 0 and 1")
    return {0: n["c0"], 1: n["c1"]}


def split_predicate(
    df: DataFrame, key: Sequence[str], test_size: float = TEST_SHARE, seed: int = SEED,
    label: str = LABEL,
) -> Column:
    """Condition of the test rows: exact counts per class, stable under any partitioning."""
    counts = class_counts(df, label)
    if any(n < 2 for n in counts.values()):
        raise ValueError(f"every class needs at least 2 rows: {counts}")
    sizes = split_sizes(counts, test_size)
    wanted = {str(c): (F.col(label) == c, n) for c, n in sizes.items()}
    return pick_smallest_hashes(df, key, wanted, seed)


def stratified_split(
    df: DataFrame, key: Sequence[str], test_size: float = TEST_SHARE, seed: int = SEED,
    label: str = LABEL,
) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    test = split_predicate(df, key, test_size, seed, label)
    return df.where(~test), df.where(test)


@dataclass(frozen=True)
class RobustScaling:
    """Median and interquartile range per feature, in feature order."""

    center: dict[str, float]
    scale: dict[str, float]

    def sql(self) -> dict[str, str]:
        return {c: f"(`{c}` - ({m!r}D)) / {self.scale[c]!r}D" for c, m in self.center.items()}


def fit_robust_scaling(df: DataFrame, features: Sequence[str], approx: bool = False) -> RobustScaling:
    """Exact quartiles of all features; a zero range scales by 1.

    ``approx=True`` takes one pass with a bounded rank error instead.
    """
    probs = [0.25, 0.5, 0.75]
    if approx:
        row = df.agg(*[F.percentile_approx(c, probs, 10000).alias(c) for c in features]).first()
        quartiles = {c: row[c] or [None] * 3 for c in features}
    else:
        quartiles = exact_quantiles(df, features, probs)
    empty = [c for c, q in quartiles.items() if q[1] is None]
    if empty:
        raise ValueError(f"features without any value: {empty}")
    return RobustScaling(
        {c: float(q[1]) for c, q in quartiles.items()},
        {c: float(q[2] - q[0]) or 1.0 for c, q in quartiles.items()},
    )


def scale_features(df: DataFrame, scaling: RobustScaling) -> DataFrame:
    return df.withColumns({c: F.expr(e) for c, e in scaling.sql().items()})


def balanced_weights(df: DataFrame, label: str = LABEL) -> dict[int, float]:
    """n / (classes * n_c) per class."""
    counts = class_counts(df, label)
    present = {c: n for c, n in counts.items() if n}
    return {c: sum(present.values()) / (len(present) * n) for c, n in present.items()}


def weight_column(weights: Mapping[int, float], label: str = LABEL) -> Column:
    return F.when(F.col(label) == 1, F.lit(weights.get(1))).otherwise(F.lit(weights.get(0)))
