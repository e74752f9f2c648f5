"""Prefix trie of conversations over a minimal perfect hash table of prefix digests.

A prefix is known by its digest: four sums, over its turns, of 32 bits of a hash of the turn's place
and content. Sums run along a conversation in ranges, so a conversation of any length is spread. Equal
digests with unequal place, last turn or parent would be a collision; that raises.

Nodes are cut by depth into bands [1, 2), [2, 4), [4, 8), ... and, within a band, into fragments, each the
descendants of one node of the band's first depth. From the deepest band up, shards of whole
fragments are worked out in tasks: a minimal perfect hash gives every digest of the shard a slot, the
stored digest verifies it, counts are scattered into flat arrays, and sums run through the array
of parents' slots in depth order. What a fragment passes to its parent in the band above is summed by
parent first. A band with a fragment of over ``FRAGMENT`` nodes is taken depth by depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import mix, staged
from ledgerwatch.llm.ranks import ranked

#: Nodes of a fragment, and about as many of a shard.
FRAGMENT = 1 << 17
#: Characters of an id list that one row holds.
PIECE = 1 << 14
_LANES = ("l1", "l2", "l3", "l4")
_WORD = 0xFFFFFFFF


class SlotTable:
    """A minimal perfect hash of distinct 128-bit digests: each has its own slot of 0 .. n - 1.

    On each level the digests left are hashed into twice as many places; those alone on theirs stay
    there and the others go to the next level. A digest's slot is its place's rank among the places
    taken. The digest itself is kept at its slot, so a strange one is told apart.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.ranks: list[tuple[int, np.ndarray]] = []
        self.high, self.low = np.zeros(len(high), np.int64), np.zeros(len(low), np.int64)
        first = 0
        while len(high):
            size = 2 * len(high)
            at = self._places(high, low, len(self.ranks), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.where(alone, first - 1 + np.cumsum(alone), -1)
            taken = alone[at]
            slots = rank[at[taken]]
            self.high[slots], self.low[slots] = high[taken], low[taken]
            self.ranks.append((size, rank))
            first += int(alone.sum())
            high, low = high[~taken], low[~taken]
            if len(self.ranks) > 200:
                raise ValueError("a digest is repeated")

    @staticmethod
    def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        salted = low.view(np.uint64) + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix(high.view(np.uint64) ^ mix(salted)) % np.uint64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The digests' slots, -1 for those not in the table."""
        found = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (size, rank) in enumerate(self.ranks):
            slot = rank[self._places(high[left], low[left], level, size)]
            taken = slot >= 0
            found[left[taken]] = slot[taken]
            left = left[~taken]
        known = found >= 0
        known[known] = (self.high[found[known]] == high[known]) & (self.low[found[known]] == low[known])
        return np.where(known, found, -1)


def accumulate(shard: pd.DataFrame) -> pd.DataFrame:
    """n_children, n_leaves, saved_tokens of each node of a shard, from what its band and those below give.

    Rows are distinct nodes: high, low, parent_high, parent_low, depth, saved (the node's own), and
    children, leaves, below, the sums that children in lower bands passed up.
    """
    high, low = shard["high"].to_numpy(np.int64), shard["low"].to_numpy(np.int64)
    table = SlotTable(high, low)
    slot, n = table.slots(high, low), len(shard)
    parent = np.full(n, -1, np.int64)
    parent[slot] = table.slots(shard["parent_high"].to_numpy(np.int64), shard["parent_low"].to_numpy(np.int64))
    depth, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(4))
    depth[slot] = shard["depth"].to_numpy(np.int64)
    children[slot] = shard["children"].to_numpy(np.int64)
    leaves[slot] = shard["leaves"].to_numpy(np.int64)
    saved[slot] = shard["saved"].to_numpy(np.int64) + shard["below"].to_numpy(np.int64)
    parent[parent == np.arange(n)] = -1  # the root, whose digest is that of no turns
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for at in np.split(order, cuts):
        leaves[at] = np.where(children[at] == 0, 1, leaves[at])
        inner = at[parent[at] >= 0]
        np.add.at(children, parent[inner], 1)
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])
    return pd.DataFrame(
        {"high": high, "low": low, "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot]}
    )


def _digest(*lanes: Column) -> list[Column]:
    words = [x.bitwiseAND(F.lit(_WORD)) for x in lanes]
    return [F.shiftleft(words[0], 32).bitwiseOR(words[1]), F.shiftleft(words[2], 32).bitwiseOR(words[3])]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, content (of role and text, null as empty), chars of every turn of a conversation.

    Rows without a conv_id belong to no conversation. Texts are not carried any further.
    """
    role, text = F.coalesce(conversations["role"], F.lit("")), F.coalesce(conversations["text"], F.lit(""))
    content = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].alias("turn"),
        F.unhex(content).alias("content"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )


def rebuilt(conversations: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations after each took its first turns from another.

    ``base`` and ``head`` are columns over ``conv_id``: from which conversation, and how many turns
    (``most`` at most). Gives (conv_id, part, place, content, chars), where ``place`` counts from 0 and ranges
    ``part`` of a conversation follow each other, and (conv_id, n_turns). Turns are in order of turn
    (null first), of equal ones by content.
    """
    order = ["turn", "content", "row"]
    own = ranked(staged(turns(conversations), "trie-turns"), ["conv_id"], order, "trie-order")
    own = staged(own.select("conv_id", "part", "pos", "size", "content", "chars"), "trie-own")
    convs = own.where("pos = 0").select("conv_id", F.col("size").alias("own"), base.alias("base"), head.cast("long").alias("head"))
    lent = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    convs = convs.join(lent, "base", "left").withColumn("taken", F.least("head", F.coalesce("lent", F.lit(0))))
    convs = convs.withColumn("n_turns", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("head")))
    convs = staged(convs, "trie-conversations")
    first = own.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "content", "chars")
    first = convs.select("conv_id", "base", "head").join(first, "base").where("pos < head")
    first = first.select("conv_id", F.lit(-1).alias("part"), F.col("pos").alias("place"), "content", "chars")
    rest = own.join(convs.select("conv_id", "head", "taken"), "conv_id").where("pos >= head")
    rest = rest.select("conv_id", "part", (F.col("taken") + F.col("pos") - F.col("head")).alias("place"), "content", "chars")
    return first.union(rest), convs.select("conv_id", "n_turns")


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, high, low, parent_high, parent_low, turn (a hash), chars of every prefix but the empty one."""
    one, two = F.xxhash64("place", "content"), F.xxhash64("content", "place", F.lit(2))
    halves = [F.shiftrightunsigned(one, 32), one, F.shiftrightunsigned(two, 32), two]
    rows = rows.select("*", one.alias("turn"), *[x.bitwiseAND(F.lit(_WORD)).alias(c) for c, x in zip(_LANES, halves, strict=True)])
    rows = staged(rows, "trie-rebuilt")
    held = rows.groupBy("conv_id", "part").agg(*[F.sum(c).alias(c) for c in _LANES])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("conv_id", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in _LANES])
    inside = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(c).over(inside).alias(f"{c}_inside") for c in _LANES]).join(held, ["conv_id", "part"])
    upto = [F.col(f"{c}_before") + F.col(f"{c}_inside") for c in _LANES]
    high, low = _digest(*upto)
    parent_high, parent_low = _digest(*[x - F.col(c) for x, c in zip(upto, _LANES, strict=True)])
    return rows.select(
        "conv_id", (F.col("place") + 1).alias("depth"), high.alias("high"), low.alias("low"),
        parent_high.alias("parent_high"), parent_low.alias("parent_low"), "turn", "chars",
    )


def band(depth: Column) -> Column:
    """0 for the root, k + 1 for depths 2**k .. 2**(k + 1) - 1."""
    return F.when(depth == 0, 0).otherwise(F.char_length(F.bin(depth))).cast("int")


def nodes_of(found: DataFrame, convs: DataFrame) -> DataFrame:
    """The distinct nodes with members, smallest member, band, and the digest of their fragment's first node."""
    path = Window.partitionBy("conv_id", "band").orderBy("depth")
    found = found.withColumn("band", band(F.col("depth")))
    found = found.select("*", F.first("high").over(path).alias("top_high"), F.first("low").over(path).alias("top_low"))
    same = ["depth", "band", "parent_high", "parent_low", "turn", "chars", "top_high", "top_low"]
    content = F.xxhash64(*same)
    nodes = found.groupBy("high", "low").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.min(c).alias(c) for c in same],
        (F.min(content) != F.max(content)).alias("clash"),
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(
        zero.alias("high"), zero.alias("low"), "n_convs", "conv_id", *[F.lit(0).cast(found.schema[c].dataType).alias(c) for c in same], F.lit(False).alias("clash")
    )
    return nodes.union(root).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).drop("turn")


def _round(nodes: DataFrame, passed: DataFrame | None, top: list[str], shards: int) -> DataFrame:
    """Accumulates the fragments of ``nodes``; ``passed`` is what the bands below sum up per parent."""
    own = nodes.select("high", "low", "parent_high", "parent_low", "depth", "saved", *[F.col(c).alias(f"_{c}") for c in top])
    if passed is None:
        zero = F.lit(0).cast("long")
        own = own.select("*", zero.alias("children"), zero.alias("leaves"), zero.alias("below"))
    else:
        own = own.join(passed, ["high", "low"], "left").fillna(0, ["children", "leaves", "below"])
    own = own.withColumn("shard", F.pmod(F.xxhash64(*[f"_{c}" for c in top]), F.lit(shards))).drop(*[f"_{c}" for c in top])
    schema = "high long, low long, n_children long, n_leaves long, saved_tokens long"
    return staged(own.groupBy("shard").applyInPandas(accumulate, schema), "trie-band")


def totals(nodes: DataFrame, fragment: int = FRAGMENT) -> DataFrame:
    """high, low, n_children, n_leaves, saved_tokens of every node, band by band from the deepest."""
    counted = nodes.groupBy("band", "top_high", "top_low").count().groupBy("band")
    bands = counted.agg(F.max("count").alias("widest"), F.sum("count").alias("rows")).orderBy(F.desc("band")).collect()
    done, passed = [], None
    for x in bands:  # as many as the bits of the greatest depth
        group = nodes.where(F.col("band") == x.band)
        top = ["top_high", "top_low"]
        depths = range((1 << x.band) - 1, (1 << x.band >> 1) - 1, -1)
        if x.widest > fragment and len(depths) > 1:
            cuts, top = [group.where(F.col("depth") == d) for d in depths], ["high", "low"]
        else:
            cuts = [group]
        for cut in cuts:
            out = _round(cut, passed, top, 1 + x.rows // fragment)
            done.append(out)
            upward = cut if len(cuts) > 1 else cut.where(F.col("high").eqNullSafe(F.col("top_high")) & (F.col("low") == F.col("top_low")))
            sums = upward.select("high", "low", "parent_high", "parent_low").join(out, ["high", "low"])
            passed = staged(
                sums.groupBy(F.col("parent_high").alias("high"), F.col("parent_low").alias("low")).agg(
                    F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below")
                ),
                "trie-passed",
            )
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (high, low, conv_id) rows to comma-joined runs of a node's ids, each below about PIECE characters."""
    key, first, ids, held = None, None, [], 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"high": [key[0]], "low": [key[1]], "first": [first], "ids": [",".join(ids)]})

    for batch in batches:
        for high, low, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key is not None and ((high, low) != key or held > PIECE):
                yield row()
                ids, held = [], 0
            if not ids:
                key, first = (high, low), conv
            ids.append(str(conv))
            held += len(ids[-1]) + 1
    if ids:
        yield row()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in order to one SHA-256 per node."""
    key, state = None, None
    names = ["high", "low", "ends_sha256"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()])], names=names)

    for batch in batches:
        for high, low, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (high, low) != key:
                if key is not None:
                    yield row()
                key, state = (high, low), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if key is not None:
        yield row()


def ends_digests(ends: DataFrame) -> DataFrame:
    """high, low, ends_sha256 from (high, low, conv_id): ids ascending, comma-joined. Lists are streamed in runs."""
    order = ["high", "low", "conv_id"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = runs.mapInArrow(_pieces, "high long, low long, first long, ids string")
    runs = staged(runs, "trie-runs").repartition("high", "low").sortWithinPartitions("high", "low", "first")
    return runs.mapInArrow(_hashed, "high long, low long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, base: Column, head: Column, most: int, fragment: int = FRAGMENT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Null roles and texts are empty ones; rows without a conv_id are left out, a conversation
    without turns is a member of the root alone; other columns are ignored; no conversation, no rows.
    """
    rows, convs = rebuilt(conversations, base, head, most)
    found = staged(prefixes(rows), "trie-prefixes")
    nodes = staged(nodes_of(found, convs), "trie-nodes")
    clash = nodes.where("clash").select("high", "low").head()
    if clash:
        raise ValueError(f"two prefixes share the digest {clash.high:x}, {clash.low:x}")
    if nodes.isEmpty():
        columns = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], columns)
    last = found.join(convs, "conv_id").where("depth = n_turns").select("high", "low", "conv_id")
    zero = F.lit(0).cast("long")
    ends = last.union(convs.where("n_turns = 0").select(zero, zero, "conv_id"))
    parents = nodes.select(F.col("high").alias("parent_high"), F.col("low").alias("parent_low"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals(nodes, fragment), ["high", "low"]).join(ends_digests(ends), ["high", "low"], "left")
    out = out.join(parents, ["parent_high", "parent_low"], "left")
    return out.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
