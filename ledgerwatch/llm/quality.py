"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of whole texts come from byte classes and word hashes in NumPy. Standardised, they pass
through ``FEATURES`` random cosines, which approximate a Gaussian kernel. Each task sums its part of
the normal equations; the sums meet row by row, so no task holds more than a few of them. The
calibration pools adjacent violators over scores on a fixed grid. What the driver solves and
broadcasts has a fixed size, however many rows are labelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import separators, staged, text_slices, word_hashes

FEATURES = 300
WIDTH = 4.0
RIDGE = 1e-3
GRID = 2000
_SPACE = separators((0x20, 0x20), (0x09, 0x0D))
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[48:58] = 3
_CLASS[33:48] = _CLASS[58:65] = _CLASS[91:97] = _CLASS[123:127] = 4
_CLASS[[44, 46, 39, 45]] = 5
_CLASS[128:] = 6
_WEIGHT = np.random.default_rng(3).integers(1, 1 << 40, 256)
STATISTICS = 24


def statistics(data: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The statistics of one text, given its bytes and word hashes."""
    out = np.zeros(STATISTICS)
    n, m = len(data), len(words)
    out[0], out[1] = np.log1p(n), np.log1p(m)
    if not n:
        return out
    kind = _CLASS[data]
    out[2:8] = np.bincount(kind, minlength=7)[1:] / n
    out[8] = (n - m) / max(1, m)
    ends = np.flatnonzero(data == 10)
    line = np.concatenate([[0], ends[ends < n - 1] + 1])
    size = np.diff(np.append(line, n))
    long = size >= 16
    for k, c in enumerate((1, 4, 3)):
        share = np.add.reduceat((kind == c).astype(np.int64), line) / size
        out[9 + k] = share[long].max() if long.any() else share.max()
    out[12] = (data == 124).sum() / n
    out[13] = np.log1p(len(line))
    letters = kind[(kind == 1) | (kind == 2)]
    out[14] = (letters == 1).mean() if len(letters) else 0.0
    if m:
        same = words[1:] == words[:-1]
        out[15] = same.sum() / m
        distinct, count = np.unique(words, return_counts=True)
        out[16] = len(distinct) / m
        out[17] = len(distinct) / np.sqrt(m)
        out[18] = count.max() / m
        run = np.diff(np.concatenate([[-1], np.flatnonzero(~same), [m - 1]]))
        out[19] = np.log1p(run.max())
        if m >= 4:
            grams = words[:-3] + words[1:-2] * np.uint64(3) + words[2:-1] * np.uint64(5) + words[3:] * np.uint64(7)
            out[20] = len(np.unique(grams)) / len(grams)
        else:
            out[20] = 1.0
        block = max(1, min(m, 24))
        near = np.add.reduceat(np.append(same, False).astype(np.int64), np.arange(0, m, block)) / block
        out[21] = near.max()
    if len(line) > 1:
        key = np.add.reduceat(_WEIGHT[data] * (np.arange(n) - np.repeat(line, size) + 1), line)
        out[22] = 1 - len(np.unique(key)) / len(key)
    out[23] = np.log1p(size.max())
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, data, offsets in text_slices(batch.column(1)):
            hashes, at = word_hashes(data, offsets, _SPACE)
            for k in range(len(offsets) - 1):
                rows.append(statistics(data[offsets[k] : offsets[k + 1]], hashes[at[k] : at[k + 1]]).tolist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def measure(documents: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of each whole text; a null text is empty."""
    kind = dict(documents.dtypes)["doc_id"]
    return staged(documents.select("doc_id", "text").mapInArrow(_measured, f"doc_id {kind}, x array<double>"), "statistics")


class Model:
    def __init__(self):
        rng = np.random.default_rng(11)
        self.turn = rng.normal(0, 1 / WIDTH, (STATISTICS, FEATURES))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.mean = np.zeros(STATISTICS)
        self.scale = np.ones(STATISTICS)
        self.weights: np.ndarray | None = None
        self.knots = np.array([0.0])
        self.levels = np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.turn + self.phase) * np.sqrt(2 / FEATURES)
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.interp(self.raw(x), self.knots, self.levels)


def _stack(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), STATISTICS)


def _sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = shared.value, np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                phi = model.features(_stack(part.column(0)))
                y = np.array(part.column(1), np.float64)
                total[:, :-1] += phi.T @ phi
                total[:, -1] += phi.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[i] = sums.get(i, 0) + np.array(row.values, np.float64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["i", "row"])


def isotonic(value: np.ndarray, count: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing rates for groups in ascending order of value: pools adjacent violators."""
    blocks: list[list[float]] = []
    for c, p in zip(count, positive, strict=True):
        blocks.append([p, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, c2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + c2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), p / c) for p, c, k in blocks])


def fit(measured: DataFrame, labels: DataFrame) -> Model:
    """Fit on rows of ``labels`` (doc_id, quality 0 or 1; other values are ignored) by their statistics.

    Without such rows every score is 0.5. A document labelled more than once counts as often.
    """
    spark = measured.sparkSession
    marks = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("double").alias("y"))
    train = staged(measured.join(marks, "doc_id").select("x", "y"), "labelled")
    model = Model()
    columns = [F.get("x", F.lit(k)) for k in range(STATISTICS)]
    moments = train.agg(F.count("*"), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).head()
    if not moments[0]:
        return model
    model.mean = np.array(moments[1 : 1 + STATISTICS], float)
    model.scale = np.maximum(np.array(moments[1 + STATISTICS :], float), 1e-9)
    shared = spark.sparkContext.broadcast(model)
    sums = train.mapInArrow(_sums(shared), "i int, row array<double>").repartition("i").mapInArrow(_added, "i int, row array<double>")
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    for i, row in sums.collect():
        total[i] = row
    ridge = RIDGE * moments[0] / FEATURES * np.eye(FEATURES + 1)
    model.weights = np.linalg.solve(total[:, :-1] + ridge, total[:, -1])

    trained = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(trained.value.raw(np.stack(x.to_numpy())))

    cell = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), raw("x"))) * GRID).cast("int")
    cells = train.select(cell.alias("cell"), "y").groupBy("cell").agg(F.count("*").alias("n"), F.sum("y").alias("p"))
    cells = sorted(cells.collect())  # at most 3 * GRID + 1 rows
    value = np.array([r[0] / GRID for r in cells])
    model.knots = value
    model.levels = isotonic(value, [r[1] for r in cells], [r[2] for r in cells])
    return model


def score(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id and calibrated score, 0 to 1, of every row; repeated rows score alike."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.score(_stack(batch.slice(at, 2000).column(1))) for at in range(0, batch.num_rows, 2000)]
            values = np.clip(np.concatenate(parts), 0, 1) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "score"])

    return measured.select("doc_id", "x").mapInArrow(run, f"doc_id {dict(measured.dtypes)['doc_id']}, score double")
