"""Why a score is high: Shapley contributions per feature, and global importance.

Linear models are explained in column expressions. Tree models need their node tables, which
are bounded by trees x nodes and broadcast; a vectorised helper evaluates batches of rows.
"""

import sys
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import (
    DecisionTreeClassificationModel, GBTClassificationModel, LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions import fixed
from ledgerwatch.session import scratch_path

# Executors get these functions with the task and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Wording of the direction of a factor.
INCREASES = "Increases Fraud Risk"
REDUCES = "Reduces Fraud Risk"
GLOBAL = "High Relative Model Importance"

#: About so many rows are explained together, which bounds what a worker holds.
TURN = 1 << 15


def linear_contributions(values: Sequence[Column], weights: Sequence[float], means: Sequence[float]) -> Column:
    """w * (x - mean) per feature, in feature order."""
    return F.array(
        *[F.lit(float(w)) * (x - F.lit(float(m))) for x, w, m in zip(values, weights, means)]
    )


def top_factors(contributions: Column, names: Sequence[str], n: int = 4) -> Column:
    """The n largest *signed* contributions as (feature, impact, weight)."""
    ranked = F.array_sort(
        F.zip_with(
            contributions,
            F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(names)]),
            lambda c, f: F.struct((-c).alias("down"), f["i"].alias("i"), f["f"].alias("f")),
        )
    )
    return F.transform(
        F.slice(ranked, 1, n),
        lambda r: F.struct(
            r["f"].alias("feature"),
            F.when(r["down"] < 0, INCREASES).otherwise(REDUCES).alias("impact"),
            fixed(F.abs(r["down"]), 4).alias("weight"),
        ),
    )


def importance_factors(importances: Mapping[str, float], n: int = 4) -> Column:
    """The fallback factors: the model's own importances, the same for every row."""
    best = sorted(importances.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
    if not best:
        return F.array().cast("array<struct<feature: string, impact: string, weight: double>>")
    return F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), F.lit(GLOBAL).alias("impact"),
                F.lit(round(float(w), 4)).alias("weight"),
            )
            for f, w in best
        ]
    )


class TreePaths(NamedTuple):
    """Edges of one tree, those of a node before those below it; edge 0 stands for the root.

    ``earlier`` is the edge above on the same path that splits on the same feature, 0 if there is none; ``cover``
    is the share of training weight that the path's splits on that feature let through, ``share`` that of all
    its splits. ``value`` is the output of the leaf the edge leads to, 0 if it leads to a split.
    """

    parent: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    earlier: np.ndarray
    cover: np.ndarray
    share: np.ndarray
    value: np.ndarray


class TreeEnsemble(NamedTuple):
    trees: list[TreePaths]
    width: int

    @property
    def base(self) -> float:
        """What a row of which nothing is known gets."""
        return float(sum((t.value * t.share).sum() for t in self.trees))


def _tree_kind(model) -> tuple[str, list[float]]:
    if isinstance(model, GBTClassificationModel):
        # The probability is a logistic of twice the margin: attribute log-odds.
        return "margin", [2.0 * w for w in model.treeWeights]
    if isinstance(model, RandomForestClassificationModel):
        return "share", [1.0 / model.getNumTrees] * model.getNumTrees
    if isinstance(model, DecisionTreeClassificationModel):
        return "share", [1.0]
    raise TypeError(f"not a tree model: {type(model).__name__}")


def tree_ensemble(spark: SparkSession, model, path: str | None = None) -> TreeEnsemble:
    """Read the nodes of a (saved) tree model; their number is bounded by its parameters."""
    kind, weights = _tree_kind(model)
    if path is None:
        path = scratch_path(spark, "tree-model")
        model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
    else:
        nodes = nodes.withColumn("treeID", F.lit(0))
    tables: dict[int, dict] = {}
    for r in nodes.collect():
        tables.setdefault(r["treeID"], {})[r["id"]] = r
    return TreeEnsemble([_paths(tables[k], kind, weights[k]) for k in sorted(tables)], model.numFeatures)


def _paths(table: dict, kind: str, tree_weight: float) -> TreePaths:
    def weight(node) -> float:
        return float(sum(node["impurityStats"])) if kind == "share" else float(node["impurityStats"][0])

    def output(node) -> float:
        if node["leftChild"] >= 0:
            return 0.0
        out = node["impurityStats"][1] / sum(node["impurityStats"]) if kind == "share" else node["prediction"]
        return tree_weight * out

    rows = [(0, 0, 0, np.inf, True, 0, 1.0, 1.0, output(table[0]))]
    level = [(table[0], 0, {})]  # node, its edge, and by feature the last edge on the path that splits on it
    while level:
        below = []
        for node, edge, last in level:
            if node["leftChild"] < 0:
                continue
            f, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            for child, left in ((table[node["leftChild"]], True), (table[node["rightChild"]], False)):
                let, earlier = weight(child) / weight(node), last.get(f, 0)
                cover = let * (rows[earlier][6] if earlier else 1.0)
                below.append((child, len(rows), {**last, f: len(rows)}))
                rows.append((edge, rows[edge][1] + 1, f, cut, left, earlier, cover, rows[edge][7] * let, output(child)))
        level = below
    kinds = (np.int64, np.int64, np.int64, float, bool, np.int64, float, float, float)
    return TreePaths(*[np.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)])


def tree_shapley(x: np.ndarray, tree: TreePaths, width: int, cells: int = 2_000_000) -> np.ndarray:
    """Path-dependent Shapley values of the rows of ``x`` in one tree.

    In a leaf a feature subset pays the product of indicators (known features) and covers (unknown
    ones). The Shapley weights are the integral over t in [0, 1] of t**s (1-t)**r, so feature j receives
    (inside_j - cover_j) * integral of the product of the other features' cover * (1 - t) + inside * t, a polynomial that
    Gauss-Legendre nodes integrate exactly. Many rows look their values up by pattern, few are walked one by one.
    """
    deepest = int(tree.depth.max())
    if not deepest:
        return np.zeros((len(x), width))
    t, w = np.polynomial.legendre.leggauss((deepest + 1) // 2)
    t, w = (t + 1) / 2, w / 2
    if 1 << deepest > 2 * len(x):
        return _walked(x, tree, width, t, w, cells)
    return np.concatenate([_looked_up(part, tree, width, t, w) for part in np.array_split(x, -(-len(x) // (2 * TURN)))])


def _looked_up(x: np.ndarray, tree: TreePaths, width: int, t: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Values by pattern: what a leaf pays depends only on which of its path's features let the row through.

    Down the tree each row has a code with a bit per feature of the path, and each code the product of
    its features' terms. For a split above one or two leaves all codes and both directions are worked out at
    once, and rows take their values from there. For features that do not let a row through these are all alike.
    """
    u, deepest = 1 - t, int(tree.depth.max())
    bits = (np.arange(1 << deepest) >> np.arange(deepest)[:, None]) % 2 == 1
    below = np.full(len(tree.parent), -1)
    below[tree.parent[1::2]] = np.arange(1, len(tree.parent), 2)  # a split's two edges follow each other, left first
    columns = np.ascontiguousarray(x.T)
    out, taken = np.zeros((width, len(x))), np.empty(len(x))
    stack = [(0, np.zeros(len(x), np.intp), np.ones((len(t), 1)), [])]  # edge, codes, products, last edge by feature
    while stack:
        edge, code, product, path = stack.pop()
        left, n = below[edge], len(path)
        right, feature = left + 1, tree.feature[left]
        goes = columns[feature] <= tree.threshold[left]
        place = path.index(tree.earlier[left]) if tree.earlier[left] else -1
        if place >= 0:
            inside, z = bits[place, : 1 << n], tree.cover[path[place]]
            term = np.where(inside, (z * u + t)[:, None], (z * u)[:, None])
        if below[left] < 0 or below[right] < 0:
            others = product / term if place >= 0 else product
            a, b, y, z = tree.value[left], tree.value[right], tree.cover[left], tree.cover[right]
            pays = [a * y * u + b * (z * u + t), a * (y * u + t) + b * z * u]  # to the right, to the left
            gains = [b - a * y - b * z, a - a * y - b * z]
            if place >= 0:
                pays = [np.where(inside, p[:, None], ((a * y + b * z) * u)[:, None]) for p in pays]
                gains = [np.where(inside, g, -a * y - b * z) for g in gains]
            else:
                pays = [p[:, None] for p in pays]
            covers = tree.cover[path][:, None]
            weights = np.concatenate([-(w / u)[None], (1 - covers) * w / (covers * u + t)])
            sums = weights @ np.concatenate([others * p for p in pays], 1)
            values = np.where(np.tile(bits[:n, : 1 << n], 2), sums[1:], sums[0])
            whole = w @ others
            own = np.concatenate([whole * g for g in gains])
            at = code + (goes.astype(np.intp) << n)
            for k, f in [*enumerate(tree.feature[path].tolist()), (n, feature)]:
                if k != place:
                    np.take(own if k == n else values[k], at, out=taken, mode="clip")
                    out[f] += taken
        for e in (left, right):
            if below[e] < 0:
                continue
            through, z = goes if e == left else ~goes, tree.cover[e]
            if place >= 0:
                more = product / term * np.where(inside, (z * u + t)[:, None], (z * u)[:, None])
                stack.append((e, np.where(through, code, code & ~(1 << place)), more, [e if k == place else p for k, p in enumerate(path)]))
            else:
                more = np.concatenate([product * (z * u)[:, None], product * (z * u + t)[:, None]], 1)
                stack.append((e, code | (through.astype(np.intp) << n), more, [*path, e]))
    return out.T


def _walked(x: np.ndarray, tree: TreePaths, width: int, t: np.ndarray, w: np.ndarray, cells: int) -> np.ndarray:
    """One walk down and one up, all rows at every edge. On the way down each edge extends its parent's product by
    its feature's term, after taking out the term of the edge that split on it before; on the way up the
    leaves' products add up per edge, and an edge's feature receives the sum below it with its own term unwound.
    """
    deepest, out = int(tree.depth.max()), np.zeros((len(x), width))
    edges, cuts = len(tree.parent), np.searchsorted(tree.depth, np.arange(deepest + 2))
    place = np.zeros((edges, width))
    place[np.arange(1, edges), tree.feature[1:]] = 1.0
    again = tree.earlier > 0
    step = max(1, cells // (edges * len(t)))
    for first in range(0, len(x), step):
        rows = x[first : first + step]
        inside = (rows[:, tree.feature] <= tree.threshold) == tree.left
        inside[:, 0] = True
        product = np.empty((edges, len(t), len(rows)))
        term = np.empty_like(product)
        product[0] = term[0] = 1.0
        for d in range(1, deepest + 1):
            e = np.arange(cuts[d], cuts[d + 1])
            old = tree.earlier[e]
            inside[:, e] &= inside[:, old]  # edge 0 lets everything through
            term[e] = tree.cover[e, None, None] * (1 - t)[:, None] + inside[:, e].T[:, None, :] * t[:, None]
            product[e] = product[tree.parent[e]] / term[old] * term[e]
        product *= tree.value[:, None, None]
        for d in range(deepest, 1, -1):
            e = np.arange(cuts[d], cuts[d + 1], 2)  # a split's two edges follow each other
            product[tree.parent[e]] += product[e] + product[e + 1]
        slack = inside.T - tree.cover[:, None]
        gain = slack * np.einsum("q,eqr->er", w, product / term)
        gain[again] -= slack[tree.earlier[again]] * np.einsum("q,eqr->er", w, product[again] / term[tree.earlier[again]])
        gain[0] = 0.0
        out[first : first + step] = gain.T @ place
    return out


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over a few tasks per core, whatever files they came in, as explaining costs far more than moving."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def _turns(batches: Iterator[pd.Series], width: int) -> Iterator[np.ndarray]:
    """Rows of several batches together, about ``TURN`` at a time, as what is looked up is worked out once per turn."""
    waiting, held = [], 0
    for rows in batches:
        waiting.append(np.stack(rows.to_numpy()) if len(rows) else np.zeros((0, width)))
        held += len(rows)
        if held >= TURN:
            yield np.concatenate(waiting)
            waiting, held = [], 0
    if waiting:
        yield np.concatenate(waiting)


def tree_contributions(spark: SparkSession, ensemble: TreeEnsemble, features: Column) -> Column:
    """Shapley value per feature of an ``array<double>`` column."""
    shared = spark.sparkContext.broadcast(ensemble)

    @F.pandas_udf("array<double>")
    def contributions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees, width = shared.value
        for x in _turns(batches, width):
            total = np.zeros((len(x), width))
            for tree in trees:
                total += tree_shapley(x, tree, width)
            yield pd.Series(list(total), dtype=object)

    return contributions(features)


def model_importances(model, names: Sequence[str]) -> dict[str, float]:
    """The model's feature importances; empty for a model that has none."""
    found = getattr(model, "featureImportances", None)
    return {} if found is None else dict(zip(names, [float(v) for v in found.toArray()]))


def importance_table(spark: SparkSession, importances: Mapping[str, float], n: int = 15) -> DataFrame:
    lines = sorted(importances.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
    return spark.createDataFrame(lines, "feature string, importance double")


def hash_sample(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """A fixed number of rows, chosen by a hash of their key."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(rows)


def global_importance(df: DataFrame, contributions: str, names: Sequence[str], n: int = 15) -> DataFrame:
    """Features by mean absolute contribution, the n largest."""
    return (
        df.select(F.posexplode(contributions).alias("i", "c"))
        .groupBy("i").agg(F.avg(F.abs("c")).alias("mean_abs_contribution"))
        .select(
            F.element_at(F.array(*[F.lit(f) for f in names]), F.col("i") + 1).alias("feature"),
            "mean_abs_contribution",
        )
        .orderBy(F.desc("mean_abs_contribution"), "feature").limit(n)
    )


def contribution_column(
    spark: SparkSession, model, features: Column, means: Sequence[float] | None = None,
    ensemble: TreeEnsemble | None = None,
) -> Column | None:
    """Contributions for any of the supported classifiers; None where only importances exist."""
    if isinstance(model, LogisticRegressionModel):
        if means is None:
            return None
        weights = model.coefficients.toArray()
        return linear_contributions([features[i] for i in range(len(weights))], weights, means)
    return tree_contributions(spark, ensemble or tree_ensemble(spark, model), features)
