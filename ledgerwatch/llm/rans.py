"""Static range asymmetric numeral system over token ids: table, block encoder, block decoder.

A block's ids are dealt over ``LANES`` interleaved 64-bit states that share one frequency table
(sum ``TOTAL``) and one stream of 32-bit words. Every ``STEPS`` rounds the states and the place in
the stream are kept, so the parts of a block can be decoded independently; a CRC covers the ids.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

BITS = 20
TOTAL = 1 << BITS
LANES = 512
STEPS = 256
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_BITS = np.uint64(BITS)
_TOP = np.uint64(63 - BITS)


class Table(NamedTuple):
    share: np.ndarray
    below: np.ndarray
    symbol: np.ndarray


class Block(NamedTuple):
    tokens: int
    words: bytes
    marks: list[tuple[int, bytes]]
    crc: int


def shares(counts: np.ndarray) -> np.ndarray:
    """Frequencies scaled to sum ``TOTAL``; every symbol that occurs keeps at least one."""
    counts = np.asarray(counts, np.int64)
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), np.int64)
    if int(seen.sum()) > TOTAL:
        raise ValueError("more symbols than table slots")
    out = np.where(seen, np.maximum(1, (counts.astype(float) * (TOTAL / counts.sum())).astype(np.int64)), 0)
    while (over := int(out.sum()) - TOTAL) != 0:
        if over < 0:
            out[int(np.argmax(counts))] -= over
            break
        room = np.maximum(out - 1, 0)
        cut = np.minimum(room, -(-room * over // max(1, int(room.sum()))))
        excess = np.cumsum(cut) - over
        out -= np.where(excess > 0, np.maximum(0, cut - excess), cut)
    return out


def make_table(share: np.ndarray) -> Table:
    below = np.concatenate([[0], np.cumsum(share)[:-1]])
    symbol = np.repeat(np.arange(len(share), dtype=np.uint32), share)
    return Table(share.astype(np.uint64), below.astype(np.uint64), symbol)


def encode(ids: np.ndarray, table: Table) -> Block:
    n = len(ids)
    if not n:
        return Block(0, b"", [], 0)
    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
    if int(table.share[ids].min()) == 0:
        raise ValueError("an id that the table does not have")
    rounds = -(-n // LANES)
    padded = np.full(rounds * LANES, int(np.argmax(table.share)), np.int64)
    padded[:n] = ids
    padded = padded.reshape(rounds, LANES)
    state = np.full(LANES, _LOW)
    chunks: list[np.ndarray] = [np.zeros(0, np.uint32)] * rounds
    kept: dict[int, bytes] = {}
    share, below = table.share[padded], table.below[padded]
    most = share << _TOP
    for t in range(rounds - 1, -1, -1):
        over = np.flatnonzero(state >= most[t])
        if len(over):
            full = state[over]
            chunks[t] = full.astype("<u4")
            state[over] = full >> _WORD
        whole, rest = np.divmod(state, share[t])
        state = (whole << _BITS) + rest + below[t]
        if t % STEPS == 0:
            kept[t] = state.astype("<u8").tobytes()
    at = np.concatenate([[0], np.cumsum([len(c) for c in chunks])])
    return Block(n, np.concatenate(chunks).astype("<u4").tobytes(), [(int(at[t]), kept[t]) for t in sorted(kept)], crc)


def decode_part(block: Block, part: int, table: Table) -> np.ndarray:
    """The ids from one checkpoint to the next."""
    words = np.frombuffer(block.words, "<u4")
    at, raw = block.marks[part]
    state = np.frombuffer(raw, "<u8").astype(np.uint64)
    rounds = -(-block.tokens // LANES)
    steps = min(STEPS, rounds - part * STEPS)
    out = np.empty((steps, LANES), np.uint32)
    low = np.uint64(TOTAL - 1)
    for t in range(steps):
        slot = state & low
        own = table.symbol[slot]
        out[t] = own
        state = table.share[own] * (state >> _BITS) + slot - table.below[own]
        short = np.flatnonzero(state < _LOW)
        if len(short):
            state[short] = (state[short] << _WORD) | words[at : at + len(short)]
            at += len(short)
    end = block.marks[part + 1] if part + 1 < len(block.marks) else None
    if end is not None and (at != end[0] or state.astype("<u8").tobytes() != end[1]):
        raise ValueError("a part does not end in the next checkpoint's state")
    return out.reshape(-1)[: block.tokens - part * STEPS * LANES]


def decode(block: Block, table: Table) -> np.ndarray:
    if not block.tokens:
        return np.zeros(0, np.uint32)
    ids = np.concatenate([decode_part(block, k, table) for k in range(len(block.marks))])
    if zlib.crc32(ids.astype("<u4").tobytes()) != block.crc:
        raise ValueError("a block does not match its checksum")
    return ids
