"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2c). They are turned onto their principal
axes, given grid cells of side epsilon on the leading ones and sorted by cell (Spark's range
partitioning), then cut into sequences of ``SEQUENCE`` vectors. Two sequences meet only if their
intervals of first-axis cells touch (an equality join on cells) and their boxes on the leading axes
come within epsilon. A pair of sequences is halved recursively; halves whose boxes are farther than
epsilon are skipped. At the leaves the distance on the leading axes excludes most pairs, and what is
left is decided by the cosine of the given vectors in double precision.

Vectors of one width are compared with each other: order, sequences and cells are per width. The axes of
the ``WIDTHS`` commonest widths of at most ``WIDEST`` components are worked out, others keep their own.

Equal vectors become one with a multiplicity first. A pair of sequences gives a count per
vector and a spanning forest of its links, not the links, so a dense group costs no rows. Pairs are worked
off in turns, whose sequences are shipped and forgotten again: disk grows with the vectors, not their square.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import components, scratch, staged

COSINE = 0.9
SEQUENCE = 4096
LEAF = 256
GRID_AXES = 4
LEAD_AXES = 16
SLACK = 1e-7
#: Bounds of the sums for principal axes, which hold WIDTHS * WIDEST * WIDEST numbers at most.
WIDTHS, WIDEST = 16, 2048

#: Bytes of neighbouring sequences that a task gets together, and of all that are shipped at once.
GROUP, SHIPPED = 8 << 20, 512 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_FOUND = "node long, n long, root long"
_KEYED = "vec_id long, cls binary, vector array<double>"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A null cls for vectors that link with nothing."""
    for batch in batches:
        ids, classes, vectors = batch.column(0).to_pylist(), [], []
        for x in batch.column(1):
            v = x.values
            ok = v is not None and len(v) and not v.null_count
            v = np.asarray(v.to_numpy(zero_copy_only=False), np.float64) if ok else None
            if ok:
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = math.sqrt(float(v @ v))
                if not math.isfinite(norm) or norm == 0:
                    top = float(np.abs(v).max())
                    ok = math.isfinite(top) and top > 0
                    if ok:  # squares under- or overflow: scale first, which leaves the cosine
                        v = v / top
            if ok:
                v = v + 0.0
                classes.append(hashlib.blake2b(v.tobytes(), digest_size=16).digest())
                vectors.append(v)
            else:
                classes.append(None)
                vectors.append(None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(classes, pa.binary()), pa.array(vectors, pa.list_(pa.float64()))], names=["vec_id", "cls", "vector"]
        )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _by_width(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(width, rows) of the vectors of each width in a batch."""
    widths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        yield int(width), np.flatnonzero(widths == width)


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for width, rows in _by_width(batch.column(0)):
            u = _unit(_matrix(batch.column(0).take(pa.array(rows))))
            totals[width] = u.T @ u + totals.get(width, 0)
    for width, total in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["w", "i", "row"]
        )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for w, i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            sums[w, i] = sums.get((w, i), 0) + np.asarray(row.values, np.float64)
    columns = [pa.array([k[j] for k in sums], pa.int32()) for j in (0, 1)]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["w", "i", "row"])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """By width, columns of axes, most spread first, for the commonest widths; the sums do not grow with the rows."""
    sizes = vectors.groupBy(F.size("vector").alias("w")).count().where(F.col("w") <= WIDEST)
    widths = [r[0] for r in sizes.orderBy(F.desc("count"), "w").limit(WIDTHS).collect()]
    if not widths:
        return {}
    sums = vectors.where(F.size("vector").isin(widths)).select("vector").mapInArrow(_spread, "w int, i int, row array<double>")
    totals = {w: np.zeros((w, w)) for w in widths}
    for w, i, row in sums.repartition("w", "i").mapInArrow(_added, "w int, i int, row array<double>").toLocalIterator():
        totals[w][i] = row
    return {w: np.linalg.eigh(total)[1][:, ::-1][:, :LEAD_AXES].copy() for w, total in totals.items()}


def _lead(axes: dict[int, np.ndarray], width: int, n: int) -> np.ndarray:
    """The first ``n`` axes of a width, or all of them if it has fewer."""
    return axes[width][:, :n] if width in axes else np.eye(width, min(n, width))


_CELLS = ", ".join(f"c{k} int" for k in range(GRID_AXES))


def _placed(axes, epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, GRID_AXES), np.int32)
            for width, rows in _by_width(batch.column(2)):
                y = _unit(_matrix(batch.column(2).take(pa.array(rows)))) @ _lead(axes.value, width, GRID_AXES)
                cells[rows, : y.shape[1]] = np.floor(y / epsilon)
            arrays = [*batch.columns, pc.list_value_length(batch.column(2)).cast(pa.int32()), *[pa.array(cells[:, k]) for k in range(GRID_AXES)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "copies", "vector", "w", *[f"c{k}" for k in range(GRID_AXES)]])

    return run


_SEQUENCE = "sequence long, w int, first int, last int, low array<double>, high array<double>, nodes array<long>, copies array<long>, vectors binary"


def _sequences(axes):
    """Packs rows that come sorted by sequence; a sequence has at most ``SEQUENCE`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(part: pa.Table) -> pa.RecordBatch:
            x = _matrix(part.column(2).combine_chunks())
            y, c = _unit(x) @ _lead(axes.value, x.shape[1], LEAD_AXES), part.column(3).to_pylist()
            row = {
                "sequence": part.column(4)[0].as_py(), "w": x.shape[1], "first": min(c), "last": max(c), "low": y.min(0).tolist(), "high": y.max(0).tolist(),
                "nodes": part.column(0).to_pylist(), "copies": part.column(1).to_pylist(), "vectors": x.tobytes(),
            }
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row))

        waiting: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            ids = batch.column(4).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1, [len(ids)]])
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if high == low:
                    continue
                if waiting and ids[low] != now:
                    yield packed(pa.Table.from_batches(waiting))
                    waiting = []
                now = ids[low]
                waiting.append(batch.slice(int(low), int(high - low)))
        if waiting:
            yield packed(pa.Table.from_batches(waiting))

    return run


def _numbered(k: Column) -> Column:
    """One number for the k-th of something and its vectors' width, in order of k."""
    return F.shiftleft(k, 31).bitwiseOR(F.col("w"))


def _ranked(placed: DataFrame, cells: list[str]) -> DataFrame:
    """node, copies, vector, c0, sequence, place: grid order by width, cut every ``SEQUENCE`` rows and between widths.

    The sorted rows are written once; a part's ranks follow those of the parts before it.
    """
    ordered = placed.repartitionByRange("w", *cells, "node").sortWithinPartitions("w", *cells, "node")
    ordered = staged(ordered.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "grid-order")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    sizes = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    sizes = sizes.select("part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.col("place") - F.col("first") + F.col("before")
    ranked = ordered.join(sizes, "part").select("node", "copies", "vector", "c0", _numbered(F.floor(rank / SEQUENCE)).alias("sequence"), "place")
    return ranked.repartition("sequence").sortWithinPartitions("sequence", "place")


class _Forest:
    """Connected components of the vectors of one pair of sequences."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(self.root, high, low)
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


def join_sequences(x: np.ndarray, y: np.ndarray | None, lead: np.ndarray, cosine: float, weight_x: np.ndarray, weight_y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links per row of x, per row of y, and the roots of both together; y None joins x with itself."""
    epsilon2 = (math.sqrt(2 - 2 * cosine) + SLACK) ** 2
    same = y is None
    ux = _unit(x)
    uy = ux if same else _unit(y)
    px, py = ux @ lead, (ux if same else uy) @ lead
    sx, sy = np.einsum("ij,ij->i", px, px), np.einsum("ij,ij->i", py, py)
    shift = 0 if same else len(ux)
    nx, ny = np.zeros(len(ux), np.int64), np.zeros(len(uy), np.int64)
    forest = _Forest(len(ux) + (0 if same else len(uy)))

    def leaf(a: int, b: int, c: int, d: int) -> None:
        far = sx[a:b, None] + sy[None, c:d] - 2 * (px[a:b] @ py[c:d].T)
        i, j = np.nonzero(far <= epsilon2)
        if same and a == c:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return
        if len(i) * 4 > (b - a) * (d - c):
            ok = (ux[a:b] @ uy[c:d].T)[i, j]
            near = np.abs(ok - cosine) < 1e-12
            if near.any():
                ok[near] = np.einsum("ij,ij->i", ux[a + i[near]], uy[c + j[near]])
        else:
            ok = np.einsum("ij,ij->i", ux[a + i], uy[c + j])
        hit = ok >= cosine
        i, j = a + i[hit], c + j[hit]
        if len(i):
            np.add.at(nx, i, weight_y[j])
            np.add.at(nx if same else ny, j, weight_x[i])
            forest.link(i, shift + j)

    def walk(a: int, b: int, c: int, d: int) -> None:
        if same and c < a:
            return
        gap = np.maximum(0, np.maximum(px[a:b].min(0) - py[c:d].max(0), py[c:d].min(0) - px[a:b].max(0)))
        if float(gap @ gap) > epsilon2:
            return
        if b - a <= LEAF and d - c <= LEAF:
            leaf(a, b, c, d)
            return
        m, k = a + _half(b - a), c + _half(d - c)
        for p, q in ((a, m), (m, b)):
            for r, s in ((c, k), (k, d)):
                if p < q and r < s:
                    walk(p, q, r, s)

    walk(0, len(ux), 0, len(uy))
    return nx, ny, forest.root


def _half(n: int) -> int:
    """Halves on leaf borders, so that both sides of a self-join are cut alike."""
    if n <= LEAF:
        return n
    leaves = -(-n // LEAF)
    return LEAF * (leaves // 2)


def _joined(axes, cosine: float):
    """Joins the pairs of sequences of each block, whose sequences come as rows one after another."""

    def block(pairs: list[dict], held: dict[int, tuple]) -> pa.RecordBatch:
        nodes, counts, links = [], [], []
        for a, b in ((p["a"], p["b"]) for p in pairs):
            (na, wa, x), (nb, wb, y) = held[a], held[b]
            count_a, count_b, root = join_sequences(x, None if a == b else y, _lead(axes.value, x.shape[1], LEAD_AXES), cosine, wa, wb)
            own, n = (na, count_a) if a == b else (np.concatenate([na, nb]), np.concatenate([count_a, count_b]))
            hit = n > 0
            nodes.append(own[hit])
            counts.append(n[hit])
            links.append(np.stack([own[hit], own[root[hit]]], 1))
        node, at = np.unique(np.concatenate(nodes), return_inverse=True)
        n = np.zeros(len(node), np.int64)
        np.add.at(n, at, np.concatenate(counts))
        link = np.unique(np.concatenate(links), axis=0)
        link = link[link[:, 0] != link[:, 1]]
        columns = np.concatenate([node, link[:, 0]]), np.concatenate([n, np.zeros(len(link), np.int64)]), np.concatenate([node, link[:, 1]])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pairs, held = None, [], {}
        for batch in batches:
            for k in range(batch.num_rows):
                key = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                if held and key != now:
                    yield block(pairs, held)
                    held = {}
                if not held:
                    now, pairs = key, batch.column(2)[k].as_py()
                nodes, copies = (batch.column(j)[k].values.to_numpy() for j in (4, 5))
                vectors = np.frombuffer(batch.column(6)[k].as_py(), np.float64).reshape(len(nodes), -1)
                held[batch.column(3)[k].as_py()] = nodes.copy(), copies.copy(), vectors
        if held:
            yield block(pairs, held)

    return run


@contextmanager
def _shuffles_cleaned(spark: SparkSession):
    """Meanwhile the shuffle files of a query go when it ends, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _found(sequences: DataFrame, pairs: DataFrame, axes, cosine: float) -> DataFrame:
    """node, n, root of all pairs of sequences: shares of a node's links, and what it is connected to.

    Neighbouring sequences form groups of ``GROUP`` bytes, and a task gets the pairs of two groups with
    each of their sequences once. What is shipped grows with the square of the vectors all the same, so it goes
    in turns of as many bytes as all sequences have, ``SHIPPED`` at least.
    """
    spark = sequences.sparkSession
    size = F.size("nodes").cast("long") * F.col("w") * 8
    n, total = sequences.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).head()
    several = max(1, int(n / math.sqrt(8 * spark.sparkContext.defaultParallelism)))  # leaves a few blocks for each core
    width = F.greatest(F.lit(1), F.least(F.lit(several), F.floor(F.lit(GROUP) / (F.col("w") * 8 * SEQUENCE))))
    member = sequences.select("sequence", size.alias("bytes"), _numbered(F.floor(F.shiftright("sequence", 31) / width)).alias("group"))
    of = lambda c: member.select(F.col("sequence").alias(c), F.col("group").alias(f"group_{c}"))
    blocks = pairs.join(of("a"), "a").join(of("b"), "b").groupBy(F.least("group_a", "group_b").alias("g"), F.greatest("group_a", "group_b").alias("h"))
    blocks = staged(blocks.agg(F.collect_list(F.struct("a", "b")).alias("pairs")), "blocks")
    both = F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.array(p["a"], p["b"]))))
    needed = blocks.select("g", "h", "pairs", F.explode(both).alias("sequence"))
    shipped = needed.join(member, "sequence").agg(F.sum("bytes")).head()[0] or 0
    turns = max(1, math.ceil(shipped / max(total, SHIPPED)))
    parts = min(20_000, max(1, math.ceil(blocks.count() / turns)))
    path = scratch(spark, "found")
    content = sequences.select("sequence", "nodes", "copies", "vectors")
    with _shuffles_cleaned(spark):
        for turn in range(turns):
            now = needed.where(F.pmod(F.xxhash64("g", "h"), F.lit(turns)) == turn).join(content, "sequence")
            now = now.select("g", "h", "pairs", "sequence", "nodes", "copies", "vectors").repartition(parts, "g", "h").sortWithinPartitions("g", "h")
            now.mapInArrow(_joined(axes, cosine), _FOUND).write.mode("append").parquet(path)
    return spark.read.schema(_FOUND).parquet(path)


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``embeddings`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; others link
    with vectors of their own width. Rows that share a vec_id are vectors of their own
    that belong to one component; a row without a vec_id links nothing, has a null component and is
    kept. Labels and other columns are ignored; an empty table gives no rows.
    """
    epsilon = math.sqrt(2 - 2 * cosine)
    keyed = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).mapInArrow(_keyed, _KEYED)
    keyed = staged(keyed, "vectors")
    spark = keyed.sparkSession
    usable = keyed.where("cls is not null and vec_id is not null")
    first = usable.groupBy("cls").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    # A vec_id may have several vectors, so classes are numbered apart from ids.
    classes = staged(first.withColumn("node", F.monotonically_increasing_id()), "classes")
    axes = spark.sparkContext.broadcast(principal_axes(usable))
    one = usable.join(classes.select("cls", F.col("id").alias("vec_id"), "node", "copies"), ["cls", "vec_id"])
    one = one.dropDuplicates(["node"]).select("node", "copies", "vector")
    placed = staged(one.mapInArrow(_placed(axes, epsilon), f"node long, copies long, vector array<double>, w int, {_CELLS}"), "placed")
    cells = [f"c{k}" for k in range(GRID_AXES)]
    sequences = staged(_ranked(placed, cells).mapInArrow(_sequences(axes), _SEQUENCE), "sequences")

    box = sequences.select("sequence", "w", "first", "last", "low", "high")
    here = box.select("sequence", "w", "low", "high", F.explode(F.sequence("first", "last")).alias("cell"))
    near = box.select("sequence", "w", "low", "high", F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    gap = F.zip_with(
        F.arrays_zip(F.col("p.low").alias("l"), F.col("p.high").alias("h")),
        F.arrays_zip(F.col("q.low").alias("l"), F.col("q.high").alias("h")),
        lambda x, y: F.pow(F.greatest(F.lit(0.0), x["l"] - y["h"], y["l"] - x["h"]), 2),
    )
    touch = (F.col("p.w") == F.col("q.w")) & (F.col("p.cell") == F.col("q.cell")) & (F.col("p.sequence") <= F.col("q.sequence"))
    close = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g) <= (epsilon + SLACK) ** 2
    pairs = here.alias("p").join(near.alias("q"), touch & close)
    back = near.alias("p").join(here.alias("q"), touch & close)
    pairs = pairs.union(back).select(F.col("p.sequence").alias("a"), F.col("q.sequence").alias("b")).distinct()
    pairs = staged(pairs, "sequence-pairs")
    found = _found(sequences, pairs, axes, cosine)

    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    id_of = lambda node, name: classes.select(F.col("node").alias(node), F.col("id").alias(name))
    edges = found.where("node != root").select("node", "root").distinct().join(id_of("node", "u"), "node").join(id_of("root", "v"), "root").select("u", "v")
    own = usable.select("vec_id", "cls").join(classes.select("cls", "id"), "cls").where("vec_id != id").select("vec_id", "id").distinct()
    several = own.groupBy("vec_id").count().where("count > 1").select("vec_id")
    heads = classes.select(F.col("id").alias("vec_id")).groupBy("vec_id").count().where("count > 1").select("vec_id")
    extra = own.join(several.union(heads.select("vec_id")).union(own.join(classes.select(F.col("id").alias("vec_id")), "vec_id").select("vec_id")).distinct(), "vec_id")
    edges = staged(edges.union(extra.select(F.col("vec_id").alias("u"), F.col("id").alias("v"))), "edges")
    comp = components(edges, "vector-stars")
    label = classes.join(counts, "node", "left").join(comp.select(F.col("node").alias("id"), "component"), "id", "left")
    label = label.select("cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    label = staged(label, "vector-labels")
    out = keyed.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("cls")).alias("cls")).join(label, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
