"""Exact k nearest neighbours among the rows of one frame, by cells around pivots.

Pivots are the rows with the smallest key hashes, at most ``PIVOTS``. Every row joins the cell of its
nearest pivot; a cell is cut into blocks of about ``BLOCK_ROWS``. A block first finds neighbours among its own
rows, which bounds how far each row's k-th neighbour can be: no farther than the k-th found there, nor
than its distance to the pivot and the k-th distance of any row to that pivot together. By the triangle
inequality a row can matter to a block only if it is no farther from the block's pivot than the
block's reach, the largest sum of a row's distance to the pivot and its bound; only such rows are shipped.
There, rows meet only the part of them whose distance to the pivot differs by no more than their bound.

Shipped rows arrive in turns, so a task holds one block and one turn. How much is excluded depends on
the data: much where rows cluster, little where all distances are alike, as with independent values in
many dimensions; ``report`` says how much.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors get these functions with the task and need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
CELL_ROWS = 128
PIVOTS = 4096
TURN_ROWS = 65536
SLICE = 256
#: Shipped rows whose distances to a slice of a block are held at once.
TILE = 8192
#: Bounds are widened by this share against rounding.
SLACK = 1e-9


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap
    return out


def _smallest(d: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row by row the places of the k smallest finite ``d``, nearest first, ties by ``order``; as (row, place)."""
    most = min(k, d.shape[1])
    kth = np.partition(d, most - 1, axis=1)[:, most - 1]
    row, place = np.nonzero((d <= kth[:, None]) & np.isfinite(d))
    by = np.lexsort((order[place], d[row, place], row))
    row, place = row[by], place[by]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], place[rank < k]


def _within(at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, squared distance) of up to k other rows of a block whose rows are in key order."""
    parts = []
    for start in range(0, len(at), SLICE):
        d = _squared(at[start : start + SLICE], at)
        d[np.arange(len(d)), start + np.arange(len(d))] = np.inf
        row, place = _smallest(d, np.arange(len(at)), k)
        parts.append((start + row, place, d[row, place]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _among(
    at: np.ndarray, radius: np.ndarray, bound: np.ndarray, others: np.ndarray, far: np.ndarray, order: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, squared distance) of up to k shipped rows within a row's bound.

    ``far`` are the shipped rows' distances to the pivot; only those within the bound of ``radius`` are met.
    """
    by_far, by_radius = np.argsort(far, kind="stable"), np.argsort(radius, kind="stable")
    sorted_far = far[by_far]
    for start in range(0, len(at), SLICE):
        rows = by_radius[start : start + SLICE]
        wide = bound[rows] * (1 + SLACK) + 4 * SLACK * radius[rows]
        first = np.searchsorted(sorted_far, (radius[rows] - wide).min(), "left")
        last = np.searchsorted(sorted_far, (radius[rows] + wide).max(), "right")
        parts = []
        for tile in range(first, last, TILE):
            places = by_far[tile : min(last, tile + TILE)]
            d = _squared(at[rows], others[places])
            d[d > (wide * wide * (1 + SLACK))[:, None]] = np.inf
            row, place = _smallest(d, order[places], k)
            parts.append((row, places[place], d[row, place]))
        if not parts:
            continue
        row, place, squared = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.lexsort((order[place], squared, row))
        row, place, squared = row[by], place[by], squared[by]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        yield rows[row[best]], place[best], squared[best]


def _grouped(n: int, row: np.ndarray, *columns: np.ndarray) -> list[list[np.ndarray]]:
    """The columns cut by row, for rows 0 .. n - 1."""
    by = np.argsort(row, kind="stable")
    cuts = np.searchsorted(row[by], np.arange(1, n))
    return [np.split(c[by], cuts) for c in columns]


def nearest_neighbours(
    points: DataFrame, key: str, vector: str, k: int, cached: list[DataFrame] | None = None, report: dict | None = None
) -> DataFrame:
    """(key, neighbours): the k nearest other rows, nearest first, as (distance, key).

    Ties in distance go to the smaller key. Keys are unique; vectors are arrays of equal
    length without nulls. Frames persisted on the way are appended to ``cached``, for the
    caller to unpersist once the result has been used. ``report`` gets the rows, cells, blocks, rows
    shipped, and the share of the pairs of a block and a row outside it that were not shipped.
    """
    cached = [] if cached is None else cached
    base = points.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    key_type = base.schema["key"].dataType.simpleString()
    found_type = f"array<struct<squared: double, key: {key_type}>>"
    n = base.count()
    if not n:
        return base.select("key", F.array().cast(f"array<struct<distance: double, key: {key_type}>>").alias("neighbours"))
    cells = min(PIVOTS, -(-n // CELL_ROWS))
    chosen = base.orderBy(F.xxhash64("key"), "key").limit(cells).select("vector").collect()
    pivots = np.array([r[0] for r in chosen], float)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nearest = np.full((len(pivots), k + 1), np.inf)  # the smallest distances of this task's rows to each pivot
        for batch in batches:
            at = np.stack(batch["vector"].to_numpy())
            cell, radius = [], []
            for start in range(0, len(at), SLICE):
                d = np.sqrt(_squared(at[start : start + SLICE], pivots))
                cell.append(np.argmin(d, axis=1))
                radius.append(d.min(axis=1))
                nearest = np.partition(np.concatenate([nearest, d.T], axis=1), k, axis=1)[:, : k + 1]
            yield batch.assign(cell=np.concatenate(cell), radius=np.concatenate(radius), nearest=None)
        known = [x[np.isfinite(x)] for x in nearest]
        yield pd.DataFrame({"key": None, "vector": None, "cell": range(len(known)), "radius": None, "nearest": known})

    rows = base.mapInPandas(placed, f"key {key_type}, vector array<double>, cell int, radius double, nearest array<double>")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    cached.append(rows)
    # a line per task and pivot, of k + 1 numbers; the last is the distance within which k rows lie besides any one
    close = rows.where("nearest is not null").select("cell", F.explode("nearest").alias("d"))
    close = close.groupBy("cell").agg(F.sort_array(F.collect_list("d")).alias("d"))
    close = close.select("cell", F.when(F.size("d") > k, F.get("d", F.lit(k))).otherwise(F.lit(float("inf"))).alias("close"))
    held = rows.where("nearest is null").drop("nearest")
    sizes = held.groupBy("cell").agg(F.count("*").alias("size")).join(close, "cell")  # a line per pivot, at most PIVOTS
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("size") / BLOCK_ROWS)).cast("int")
    held = held.join(F.broadcast(sizes), "cell").withColumn("part", part)

    def settle(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("key", ignore_index=True)
        at, radius = np.stack(block["vector"].to_numpy()), block["radius"].to_numpy(float)
        row, place, squared = _within(at, k)
        kth = np.full(len(at), np.inf)
        last = np.bincount(row, minlength=len(at))
        ends = np.cumsum(last) - 1
        kth[last == k] = np.sqrt(squared[ends[last == k]])
        bound = np.minimum(kth, radius + block["close"].to_numpy(float))
        return pd.DataFrame(
            {
                "cell": block["cell"][:1], "part": block["part"][:1], "keys": [block["key"].tolist()], "at": [at.tobytes()],
                "radius": [radius.tobytes()], "bound": [bound.tobytes()], "reach": [float((radius + bound).max())],
                "row": [row.astype(np.int32).tobytes()], "place": [place.astype(np.int32).tobytes()], "squared": [squared.tobytes()],
            }
        )

    schema = f"cell int, part int, keys array<{key_type}>, at binary, radius binary, bound binary, reach double, row binary, place binary, squared binary"
    blocks = held.groupBy("cell", "part").applyInPandas(settle, schema).persist(StorageLevel.MEMORY_AND_DISK)
    cached.append(blocks)

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for names, row, place, squared in zip(batch["keys"], batch["row"], batch["place"], batch["squared"]):
                names = list(names)
                where, d = _grouped(len(names), np.frombuffer(row, np.int32), np.frombuffer(place, np.int32), np.frombuffer(squared))
                yield pd.DataFrame({"key": names, "best": [[(x, names[j]) for x, j in zip(a.tolist(), b.tolist())] for a, b in zip(d, where)]})

    best = blocks.select("keys", "row", "place", "squared").mapInPandas(own, f"key {key_type}, best {found_type}")
    reaches = [tuple(r) for r in blocks.select("cell", "part", "reach", F.size("keys").alias("n")).collect()]  # a line per block
    if len(reaches) > 1:
        best = best.unionByName(_shipped(held, blocks, pivots, reaches, n, k, key_type, found_type, report, cached))
    elif report is not None:
        report.update(rows=n, cells=cells, blocks=1, shipped=0, excluded=1.0)
    return (
        best.groupBy("key")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
        .select("key", _distances(F.col("best")))
    )


def _shipped(held, blocks, pivots, reaches, n, k, key_type, found_type, report, cached) -> DataFrame:
    """(key, best) of every row among the rows shipped to its block from others."""
    spark = held.sparkSession
    table = spark.sparkContext.broadcast((pivots, reaches))  # PIVOTS vectors, and a line per block
    turns = -(-n // TURN_ROWS)

    def ship(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, lines = table.value
        cell = np.array([x[0] for x in lines])
        part = np.array([x[1] for x in lines])
        reach = np.array([x[2] for x in lines]) * (1 + SLACK)
        for turn, batch in enumerate(batches, TaskContext.get().partitionId()):
            turn %= turns
            at = np.stack(batch["vector"].to_numpy())
            own = (batch["cell"].to_numpy(), batch["part"].to_numpy())
            near = np.empty((len(lines), len(at)), bool)  # distances are held for a slice of rows only
            for i in range(0, len(at), SLICE):
                near[:, i : i + SLICE] = (np.sqrt(_squared(at[i : i + SLICE], centres))[:, cell] <= reach).T
            for b in range(len(lines)):
                go = np.flatnonzero(near[b] & ~((own[0] == cell[b]) & (own[1] == part[b])))
                if len(go):
                    far = np.sqrt(_squared(at[go], centres[cell[b]][None])[:, 0])
                    yield pd.DataFrame(
                        {
                            "cell": [cell[b]], "part": [part[b]], "turn": [turn], "rows": [len(go)], "keys": [batch["key"].iloc[go].tolist()],
                            "at": [at[go].tobytes()], "far": [far.tobytes()],
                        }
                    )

    schema = f"cell int, part int, turn int, rows int, keys array<{key_type}>, at binary, far binary"
    sent = held.select("key", "vector", "cell", "part").mapInPandas(ship, schema)
    if report is not None:
        sent = sent.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(sent)
        by_block = {(r["cell"], r["part"]): r["n"] for r in sent.groupBy("cell", "part").agg(F.sum("rows").alias("n")).collect()}
        pairs = sum(size * by_block.get((c, p), 0) for c, p, _, size in reaches)
        outside = sum(size * (n - size) for *_, size in reaches)
        report.update(rows=n, cells=len(pivots), blocks=len(reaches), shipped=sum(by_block.values()), excluded=1 - pairs / outside)

    def meet(home: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        if not len(home) or not len(met):
            return pd.DataFrame({"key": [], "best": []}, dtype=object)
        block = home.iloc[0]
        keys = list(block["keys"])
        at = np.frombuffer(block["at"]).reshape(len(keys), -1)
        names = [x for part in met["keys"] for x in part]
        others = np.concatenate([np.frombuffer(x) for x in met["at"]]).reshape(len(names), -1)
        far = np.concatenate([np.frombuffer(x) for x in met["far"]])
        order = np.empty(len(names), np.int64)
        order[np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)] = np.arange(len(names))
        found = list(_among(at, np.frombuffer(block["radius"]), np.frombuffer(block["bound"]), others, far, order, k))
        if not found:
            return pd.DataFrame({"key": [], "best": []}, dtype=object)
        row, place, squared = (np.concatenate(x) for x in zip(*found, strict=True))
        where, d = _grouped(len(keys), row, place, squared)
        best = [[(x, names[j]) for x, j in zip(a.tolist(), b.tolist())] for a, b in zip(d, where)]
        return pd.DataFrame({"key": keys, "best": best})

    homes = blocks.select("cell", "part", "keys", "at", "radius", "bound")
    homes = homes.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    return (
        homes.groupBy("cell", "part", "turn").cogroup(sent.groupBy("cell", "part", "turn"))
        .applyInPandas(meet, f"key {key_type}, best {found_type}")
    )


def _distances(best: Column) -> Column:
    return F.transform(
        best, lambda b: F.struct(F.sqrt(b["squared"]).alias("distance"), b["key"].alias("key"))
    ).alias("neighbours")
