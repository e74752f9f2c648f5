"""Shapley values of tree ensembles leaf by leaf, as an independent reference for the walk along the edges."""

from typing import NamedTuple

import numpy as np
from pyspark.sql import functions as F

from ledgerwatch.operators.explain import _tree_kind


class LeafBoxes(NamedTuple):
    """Leaves of a tree ensemble as boxes: one line per leaf, one slot per split feature.

    A row is inside slot j of a leaf when low < x[feature] <= high; ``cover`` is the share of
    training weight that the slot's splits let through; unused slots always hold.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    width: int

    @property
    def base(self) -> float:
        return float((self.value * self.cover.prod(axis=1)).sum())


def leaf_boxes(spark, model, path: str) -> LeafBoxes:
    """Read the nodes of a (saved) tree model; their number is bounded by its parameters."""
    kind, weights = _tree_kind(model)
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
    else:
        nodes = nodes.withColumn("treeID", F.lit(0))
    trees: dict[int, dict] = {}
    for r in nodes.collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    leaves: list[tuple[dict, float]] = []

    def weight(node) -> float:
        return float(sum(node["impurityStats"])) if kind == "share" else float(node["impurityStats"][0])

    for tree, table in trees.items():
        stack = [(table[0], {})]
        while stack:
            node, path_slots = stack.pop()
            if node["leftChild"] < 0:
                if kind == "share":
                    out = node["impurityStats"][1] / sum(node["impurityStats"])
                else:
                    out = node["prediction"]
                leaves.append((path_slots, weights[tree] * out))
                continue
            split = node["split"]
            f, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
            for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
                low, high, cover = path_slots.get(f, (-np.inf, np.inf, 1.0))
                low, high = (low, min(high, cut)) if left else (max(low, cut), high)
                share = weight(table[child]) / weight(node)
                stack.append((table[child], {**path_slots, f: (low, high, cover * share)}))
    depth = max(1, max(len(s) for s, _ in leaves))
    n = len(leaves)
    feature = np.zeros((n, depth), dtype=np.int64)
    low, high, cover = np.full((n, depth), -np.inf), np.full((n, depth), np.inf), np.ones((n, depth))
    for i, (slots, _) in enumerate(leaves):
        for j, (f, (a, b, c)) in enumerate(slots.items()):
            feature[i, j], low[i, j], high[i, j], cover[i, j] = f, a, b, c
    return LeafBoxes(feature, low, high, cover, np.array([v for _, v in leaves]), model.numFeatures)


def leaf_shapley(x: np.ndarray, boxes: tuple, cells: int = 4_000_000) -> np.ndarray:
    """Path-dependent Shapley values of the rows of ``x``.

    In a leaf a feature subset pays the product of indicators (known features) and covers
    (unknown ones). The Shapley weights are the integral over t in [0, 1] of t**s (1-t)**r,
    so feature j receives (inside_j - cover_j) * integral of the other features'
    cover * (1 - t) + inside * t, a polynomial that Gauss-Legendre nodes integrate exactly.
    """
    feature, low, high, covers, value, width = boxes
    depth = feature.shape[1]
    t, w = np.polynomial.legendre.leggauss((depth + 1) // 2)
    t, w = (t + 1) / 2, w / 2
    out = np.zeros((len(x), width))
    step = max(1, cells // (max(1, len(x)) * depth))
    for a in range(0, len(value), step):
        s = slice(a, a + step)
        seen = x[:, feature[s]]
        inside = ((seen > low[s]) & (seen <= high[s])).astype(float)
        cover = covers[s][None]
        total = np.zeros_like(inside)
        for tq, wq in zip(t, w):
            term = cover * (1 - tq) + inside * tq
            total += wq * term.prod(axis=2, keepdims=True) / term
        gain = (inside - cover) * total * value[s][None, :, None]
        flat = feature[s].ravel()
        place = np.zeros((len(flat), width))
        place[np.arange(len(flat)), flat] = 1.0
        out += gain.reshape(len(x), -1) @ place
    return out


