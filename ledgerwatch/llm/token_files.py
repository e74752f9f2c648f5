"""Token-ID files: rANS blocks in ascending document order.

A data set is a folder with ``table`` (symbol, share: the one frequency table, as long as the
vocabulary) and ``blocks``. Each file of ``blocks`` holds one range of document ids; each of its rows
is a block of whole documents, about ``BLOCK`` ids, that decodes on its own: file and block number,
ids before it in the file, the documents' ids and lengths, the word stream, checkpoints and a CRC.
Parquet is the container, so Spark's writer commits files and lost tasks are simply run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import rans
from ledgerwatch.llm.common import scratch
from ledgerwatch.llm.tokens import encode, in_runs

BLOCK = 1 << 18
_BLOCKS = pa.schema(
    [
        ("file", pa.int32()),
        ("block", pa.int32()),
        ("before", pa.int64()),
        ("tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("marks", pa.list_(pa.int64())),
        ("states", pa.list_(pa.binary())),
        ("crc", pa.int64()),
    ]
)
_DDL = (
    "file int, block int, before long, tokens long, doc_ids array<long>, lengths array<long>, words binary, "
    "marks array<long>, states array<binary>, crc long"
)


def _tokenized(vocabulary: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.array([end], "<u2").tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in in_runs(texts):
                ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() + last for x in encode(texts[a:b], vocabulary, False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "ids"]
                )

    return run


def _counted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            waiting, held = [], 0
            for x in batch.column(0):
                waiting.append(np.frombuffer(x.as_buffer(), "<u2"))
                held += len(waiting[-1])
                if held > BLOCK:
                    counts += np.bincount(np.concatenate(waiting), minlength=size)
                    waiting, held = [], 0
            if waiting:
                counts += np.bincount(np.concatenate(waiting), minlength=size)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found])], names=["symbol", "n"])

    return run


def _encoded(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.make_table(table.value)
        file = TaskContext.get().partitionId()
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        block = before = held = 0

        def packed() -> pa.RecordBatch:
            out = rans.encode(np.concatenate(ids).astype(np.int64), shared)
            row = {
                "file": file, "block": block, "before": before, "tokens": out.tokens, "doc_ids": docs,
                "lengths": [len(x) for x in ids], "words": out.words, "marks": [m for m, _ in out.marks],
                "states": [s for _, s in out.marks], "crc": out.crc,
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                docs.append(doc)
                ids.append(np.frombuffer(x.as_buffer(), "<u2"))
                held += len(ids[-1])
                if held >= BLOCK:
                    yield packed()
                    block, before, held, docs, ids = block + 1, before + held, 0, [], []
        if docs:
            yield packed()

    return run


def write_tokens(documents: DataFrame, path: str, vocabulary: str, size: int, end: int) -> None:
    """Tokenise ``text`` (null: empty), append id ``end``, write below ``path`` in doc_id order.

    ``size`` is the number of ids, at most 65536. Rows that share a doc_id follow each other, ordered by a
    hash of their ids, and so do those without one, which come first. An empty table gives a data set
    without blocks.
    """
    if size > 1 << 16 or not 0 <= end < size:
        raise ValueError(f"ids are written in 16 bits: {size} ids, end {end}")
    spark = documents.sparkSession
    rows = documents.select("doc_id", "text").mapInArrow(_tokenized(vocabulary, end), "doc_id long, ids binary")
    kept = scratch(spark, "ids")
    rows.write.option("compression", "zstd").parquet(kept)
    rows = spark.read.schema("doc_id long, ids binary").parquet(kept)
    counts = np.zeros(size, np.int64)
    per_task = rows.select("ids").mapInArrow(_counted(size), "symbol int, n long")
    for symbol, n in per_task.groupBy("symbol").agg(F.sum("n")).collect():  # as many rows as the vocabulary at most
        counts[symbol] = n
    share = rans.shares(counts)
    frequencies = [(int(k), int(v)) for k, v in enumerate(share) if v]
    spark.createDataFrame(frequencies, "symbol int, share int").coalesce(1).write.parquet(f"{path}/table")
    table = spark.sparkContext.broadcast(share)
    order = ["doc_id", F.xxhash64("ids")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_encoded(table), _DDL).write.option("compression", "none").parquet(f"{path}/blocks")


def _decoded(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.make_table(table.value)
        for batch in batches:
            for row in batch.to_pylist():
                marks = list(zip(row["marks"], row["states"], strict=True))
                ids = rans.decode(rans.Block(row["tokens"], row["words"], marks, row["crc"]), shared).astype("<u4")
                at = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
                n = len(row["doc_ids"])
                crcs = [zlib.crc32(ids[at[k] : at[k + 1]].tobytes()) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["before"] + at[:-1]),
                        pa.array(np.diff(at)),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["file", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(spark: SparkSession, path: str, size: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    share = np.zeros(size, np.int64)
    for symbol, n in spark.read.schema("symbol int, share int").parquet(f"{path}/table").collect():
        share[symbol] = n
    blocks = spark.read.schema(_DDL).parquet(f"{path}/blocks")
    files = blocks.groupBy("file").agg(F.sum("tokens").alias("n"))  # a row per file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    table = spark.sparkContext.broadcast(share)
    rows = blocks.mapInArrow(_decoded(table), "file int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(files, "file").select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
