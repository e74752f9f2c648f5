"""What several operators share: tables, staging, word hashes over byte buffers, components."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.session import scratch_path, shared_folder

#: Bytes hashed at once; longer texts are cut at word ends, so memory does not follow the text.
SEGMENT = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_rows(batch: pa.RecordBatch, column: str) -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def text_slices(column: pa.Array, most: int = SEGMENT) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``most`` bytes; a null is empty."""
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        last = min(last, n)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


@functools.cache
def _trim():
    """The C library's call that gives free memory back; does nothing where there is none."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def released(run):
    """A task's function that gives back what its worker holds when it ends, as workers are used again."""

    @functools.wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _powers.cache_clear()
            pa.default_memory_pool().release_unused()
            _trim()(0)

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    """A random value per byte; A-Z have those of a-z."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    return values


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, and where each text's words begin among them.

    ``apart`` marks bytes between words. The hash is a polynomial over random byte values
    modulo 2**64, mixed afterwards, so equal words hash alike wherever they stand.
    """
    if len(data) > 2 * SEGMENT and len(offsets) == 2:
        return _long_text(data, apart)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~apart[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    before[begins] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:] & before[1:]
    ends = np.flatnonzero(inside & ~after)
    up, down = _powers(1 << max(SEGMENT.bit_length(), n.bit_length()))
    sums = np.cumsum(_letters()[data] * up[:n], dtype=np.uint64)
    low = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mix((sums[ends] - low) * down[starts] + (ends - starts + 1).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def _long_text(data: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data):
            rest = np.flatnonzero(apart[data[end : end + SEGMENT]])
            if len(rest):
                end += int(rest[0])
                break
            end = min(len(data), end + SEGMENT)
        piece = data[at:end]
        parts.append(word_hashes(piece, np.array([0, 0, len(piece)]), apart)[0])
        at = end
    hashes = np.concatenate(parts)
    return hashes, np.array([0, len(hashes)])


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """Connected components: ``node, component`` (smallest node) for each node with an edge.

    ``edges`` has two long columns. Each round links every node's neighbours to the smallest
    node near it (large star, then small star), so a component becomes a star in few rounds.
    Every round is written to the shared folder; both sides of its joins are plain tables, so
    Spark may split a hub's rows. No component is ever gathered in one place.
    """
    a, b = edges.columns
    ordered = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = staged(ordered.distinct(), name)
    seen = None
    for _ in range(most_rounds):
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if mark == seen:
            break
        seen = mark
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u != v").distinct(), name)
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), name)
        follows = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = large.join(low, "u").select(follows.alias("u"), F.col("m").alias("v"))
        pairs = staged(small.where("u != v").distinct(), name)
    else:
        raise RuntimeError(f"components of {name} did not settle in {most_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


__all__ = ["components", "mix", "scratch", "separators", "shared_folder", "staged", "table", "text_slices", "word_hashes"]
