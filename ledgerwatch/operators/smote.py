"""Synthetic minority over-sampling (Chawla et al., 2002) on feature arrays."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.features import class_counts
from ledgerwatch.operators.neighbours import nearest_neighbours
from ledgerwatch.operators.selection import OrderStatistics, key_hash
from ledgerwatch.schemas import LABEL, SEED

ROWS_PER_STEP = 4096
_GRAIN = 1 << 30


def needed_rows(counts: dict[int, int], ratio: float) -> int:
    """Synthetic rows that lift the minority to ``ratio`` of the majority."""
    majority, minority = counts[0], counts[1]
    needed = int(majority * ratio) - minority
    if needed < 0:
        raise ValueError(f"the minority already exceeds {ratio} of the majority: {minority} of {majority}")
    return needed


def minority_vectors(train: DataFrame, key: str, features: str, label: str = LABEL) -> DataFrame:
    """Distinct minority vectors with the number of rows that share them and their first key."""
    return (
        train.where(F.col(label) == 1)
        .groupBy(F.col(features).alias("vector"))
        .agg(F.min(key).alias("key"), F.count("*").alias("copies"))
    )


def neighbour_slots(vectors: DataFrame, k: int, cached: list[DataFrame] | None = None) -> DataFrame:
    """(key, vector, copies, slots): the k neighbour vectors of one row of each vector.

    Rows sharing a vector are neighbours at distance zero of each other, and a neighbour
    vector fills as many slots as it has rows.
    """
    near = nearest_neighbours(vectors, "key", "vector", k, cached)
    links = near.select("key", F.explode("neighbours").alias("near")).select(
        "key", F.col("near.distance").alias("distance"), F.col("near.key").alias("near_key")
    )
    other = vectors.select(
        F.col("key").alias("near_key"), F.col("vector").alias("near_vector"),
        F.least(F.col("copies"), F.lit(k)).cast("int").alias("near_copies"),
    )
    slots = (
        links.join(other, "near_key").groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("distance", "near_key", "near_vector", "near_copies"))).alias("near"))
    )
    twins = F.array_repeat(F.col("vector"), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    spread = F.flatten(
        F.transform(
            F.coalesce("near", F.array()), lambda s: F.array_repeat(s["near_vector"], s["near_copies"])
        )
    )
    return vectors.join(slots, "key", "left").select(
        "key", "vector", "copies", F.slice(F.concat(twins, spread), 1, k).alias("slots")
    )


def synthetic_rows(
    train: DataFrame, key: str, features: str = "features", label: str = LABEL,
    ratio: float = 0.1, k: int = 5, seed: int = SEED, cached: list[DataFrame] | None = None,
) -> DataFrame:
    """Only the new rows: (features, label).

    Every minority row is the base of needed // m points; the remainder goes to the rows with
    the smallest key hashes. Each point lies on the segment from its base to one of the
    base's k neighbours; neighbour and place come from a hash, so a repeated task makes the
    same points.
    """
    counts = class_counts(train, label)
    needed, m = needed_rows(counts, ratio), counts[1]
    if needed and m <= k:
        raise ValueError(f"{k} neighbours need more than {k} minority rows: {m}")
    vectors = minority_vectors(train, key, features, label)
    base, rest = divmod(needed, m) if m else (0, 0)
    h = key_hash(["key"], seed)
    extra = F.lit(0)
    if rest:
        cut = OrderStatistics(vectors, {"h": h}, weight=F.col("copies")).locate({"h": [rest - 1]})["h", rest - 1]
        # Rows tied at the cut share it in key order; only equal hashes can tie.
        tied = vectors.where(h == cut.value).select("key", "copies").orderBy("key").collect()
        left, shares = rest - cut.below, {}
        for r in tied:
            shares[r["key"]] = min(left, r["copies"])
            left -= shares[r["key"]]
        at_cut = F.lit(0)
        for name, share in shares.items():
            at_cut = F.when(F.col("key") == F.lit(name), F.lit(share)).otherwise(at_cut)
        extra = F.when(h < cut.value, F.col("copies")).when(h == cut.value, at_cut).otherwise(0)
    planned = neighbour_slots(vectors, k, cached).withColumn("points", F.col("copies") * base + extra)
    last = F.floor((F.col("points") - 1) / ROWS_PER_STEP).cast("long")
    steps = (
        planned.where("points > 0")
        .withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        # Steps of a vector with many copies are made by different tasks.
        .repartition("key", "step")
    )
    first = F.col("step") * ROWS_PER_STEP
    final = F.least(first + ROWS_PER_STEP, F.col("points")) - 1
    made = steps.withColumn("i", F.explode(F.sequence(first, final)))
    pick = F.pmod(F.xxhash64(F.lit(seed + 1), "key", "i"), F.size("slots")).cast("int")
    gap = F.pmod(F.xxhash64(F.lit(seed + 2), "key", "i"), F.lit(_GRAIN)) / F.lit(float(_GRAIN))
    chosen = made.withColumns({"near": F.col("slots")[pick], "gap": gap})
    return chosen.select(
        F.expr("zip_with(vector, near, (a, b) -> a + gap * (b - a))").alias(features),
        F.lit(1).alias(label),
    )


def smote(
    train: DataFrame, key: str, features: str = "features", label: str = LABEL,
    ratio: float = 0.1, k: int = 5, seed: int = SEED, cached: list[DataFrame] | None = None,
) -> DataFrame:
    """Training rows and the synthetic ones, told apart by ``synthetic``. Train split only."""
    new = synthetic_rows(train, key, features, label, ratio, k, seed, cached)
    old = train.select(F.col(features), F.col(label).cast("int").alias(label))
    return old.withColumn("synthetic", F.lit(False)).unionByName(new.withColumn("synthetic", F.lit(True)))
