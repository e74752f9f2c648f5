"""Vector bin packing of token sequences by the dot-product heuristic.

A document's ids are cut into full sequences; what is left over is an item with three demands:
tokens, segments and loss-bearing tokens. Which tokens bear loss comes from the data: in instruction data
those of the answers, in plain documents all but a piece's first, which nothing precedes. Each task keeps a pool of at most ``POOL`` items. It opens
a sequence, and puts in the item that fits and has the largest dot product with the room left in
all three dimensions, until none fits; then an item is cut so that its first part fills the tokens
left, limits permitting. Only the last sequence of a task, and one closed by the segment or loss
limit, is padded. No rows are shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import released
from ledgerwatch.llm.tokens import encode, in_runs

POOL = 4096
#: Rows worked on at once, and full sequences held before they are handed on.
SLICE, HELD = 1024, 256


class Limits(NamedTuple):
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Item(NamedTuple):
    """Ids of a document from ``start`` on; ``bears`` has one byte per id, 1 where the id bears loss."""

    doc_id: int | None
    start: int
    ids: bytes
    bears: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return self.bears.count(1, 1)  # nothing precedes the first

    def cut(self, at: int) -> tuple[Item, Item]:
        first = self._replace(ids=self.ids[: 4 * at], bears=self.bears[:at])
        return first, self._replace(start=self.start + at, ids=self.ids[4 * at :], bears=self.bears[at:])


def most(bears: bytes, at: int, tokens: int, loss: int) -> int:
    """How many ids from place ``at`` on fit into so many tokens and loss-bearing ones, as one piece."""
    end = min(at + tokens, len(bears))
    if bears.count(1, at + 1, end) > loss:
        end = at + 1 + int(np.flatnonzero(np.frombuffer(bears[at + 1 : end], np.uint8))[loss])
    return end - at


def fill(items: list[Item], limits: Limits, keep_open: bool) -> Iterator[list[Item]]:
    """Sequences from a pool; takes their items out of ``items``.

    With ``keep_open`` it stops when the pool is half empty, so that later items can still join.
    """
    least = len(items) // 2 if keep_open else 0
    lengths = np.array([x.length for x in items], np.int64)
    losses = np.array([x.loss for x in items], np.int64)
    live = np.ones(len(items), bool)
    left = len(items)
    caps = np.array(limits, float)
    while left > least:
        room = np.array(limits, np.int64)
        sequence: list[Item] = []
        while left and room[0] and room[1]:
            fits = live & (lengths <= room[0]) & (losses <= room[2])
            weight = room / caps / caps
            if fits.any():
                value = np.where(fits, lengths * weight[0] + weight[1] + losses * weight[2], -1.0)
                k = int(np.argmax(value))
                sequence.append(items[k])
                room -= (lengths[k], 1, losses[k])
                live[k] = False
                left -= 1
                continue
            k = int(np.argmax(np.where(live, lengths, -1)))
            first, items[k] = items[k].cut(most(items[k].bears, 0, int(room[0]), int(room[2])))
            sequence.append(first)
            lengths[k], losses[k] = items[k].length, items[k].loss
            room -= (first.length, 1, first.loss)
        yield sequence
    items[:] = [x for x, on in zip(items, live, strict=True) if on]


def _bearing(parts: list, end: int, vocabulary: str) -> tuple[bytes, bytes]:
    """Ids of a document's parts, and which of them bear loss; the end id bears loss if the last part does."""
    ids = encode([p["text"] for p in parts], vocabulary, True)
    flags = [bool(p["bears_loss"]) for p in parts]
    bears = b"".join(bytes([flag]) * (len(raw) // 4) for flag, raw in zip(flags, ids, strict=True))
    return b"".join(ids), bears + bytes([flags[-1] if flags else 0])


def _packed(vocabulary: str, end: int, limits: Limits, with_ids: bool, in_parts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if min(limits) < 1:
            raise ValueError("limits start at 1")
        last = np.array([end], "<u4").tobytes()
        next_id = TaskContext.get().partitionId() << 33
        pool: list[Item] = []

        def rows(sequences) -> pa.RecordBatch:
            nonlocal next_id
            out = []
            for sequence in sequences:
                offset = 0
                for x in sequence:
                    row = (x.doc_id, x.start, x.length, zlib.crc32(x.ids), x.doc_tokens, next_id, offset, x.loss)
                    out.append((*row, x.ids) if with_ids else row)
                    offset += x.length
                next_id += 1
            names = [c.split()[0] for c in _schema(with_ids).split(", ")]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            arrays = [pa.array(c, pa.int64()) for c in columns[:8]] + [pa.array(c, pa.binary()) for c in columns[8:]]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def documents(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes, bytes]]:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if in_parts:
                for doc, parts in zip(docs, texts, strict=True):
                    yield doc, *_bearing(parts or [], end, vocabulary)
                return
            for a, b in in_runs(texts):
                for doc, raw in zip(docs[a:b], encode(texts[a:b], vocabulary, True), strict=True):
                    yield doc, raw, b"\1" * (len(raw) // 4 + 1)

        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                whole = []
                for doc, raw, bears in documents(batch.slice(first, SLICE)):
                    ids, at, n = raw + last, 0, len(bears)
                    while at < n:
                        size = most(bears, at, limits.tokens, limits.loss)
                        item = Item(doc, at, ids[4 * at : 4 * (at + size)], bears[at : at + size], n)
                        at += size
                        if at == n and size < limits.tokens:
                            pool.append(item)
                        else:
                            whole.append([item])
                    if len(whole) >= HELD:
                        yield rows(whole)
                        whole = []
                if whole:
                    yield rows(whole)
                if len(pool) >= POOL:
                    yield rows(fill(pool, limits, keep_open=True))
        if pool:
            yield rows(fill(pool, limits, keep_open=False))

    return run


def _schema(with_ids: bool) -> str:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    return ", ".join([f"{c} long" for c in names] + ["ids binary"] * with_ids)


def pack(documents: DataFrame, vocabulary: str, end: int = 0, limits: Limits = Limits(), with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens (and ids,
    little-endian unsigned 32-bit).

    A document's ids are those of its text (null: empty) and ``end``; all but a piece's first bear loss. Each id is in exactly one
    piece. Rows without a doc_id, or sharing one, are documents of their own. Sequence numbers are
    unique, not gapless. An empty table gives no rows; other columns are ignored.
    """
    rows = documents.select(documents["doc_id"].cast("long"), "text")
    return rows.mapInArrow(released(_packed(vocabulary, end, limits, with_ids, False)), _schema(with_ids))


def pack_parts(documents: DataFrame, vocabulary: str, end: int = 0, limits: Limits = Limits(), with_ids: bool = False) -> DataFrame:
    """``pack`` for documents in parts: (doc_id, parts), parts an array of (text, bears_loss).

    A part's ids bear loss as it says (null: no), the end id as the last part does; a document without
    parts is its end id alone.
    """
    parts = F.transform("parts", lambda p: F.struct(p["text"].alias("text"), p["bears_loss"].alias("bears_loss")))
    rows = documents.select(documents["doc_id"].cast("long"), parts.alias("parts"))
    return rows.mapInArrow(released(_packed(vocabulary, end, limits, with_ids, True)), _schema(with_ids))


def conversation_parts(conversations: DataFrame, answers: str = "assistant") -> DataFrame:
    """(doc_id, parts) per conversation, turns in order of turn (null first); the turns of ``answers`` bear loss.

    Rows without a conv_id are left out. A conversation is gathered in one row, as it becomes one document.
    """
    turn = F.struct("turn", "role", "text")
    rows = conversations.where("conv_id is not null").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    bears = lambda t: F.coalesce(t["role"] == answers, F.lit(False))
    return rows.select("doc_id", F.transform("turns", lambda t: F.struct(t["text"].alias("text"), bears(t).alias("bears_loss"))).alias("parts"))
