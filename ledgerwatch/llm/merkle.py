"""Merkle manifest of a table: a tree per language, one over the languages, and versions by path copying.

A tree is cut into aligned blocks of 2**height nodes. A block reduces to its root in one task, the
roots are the nodes of the next level of blocks, and so on until a tree is one node. Then the way
down: each block hands its nodes the siblings they need to reach the root, so a node holds its whole
proof and no task sees more than one block.

A changed leaf makes a version of the tree. Versions are persistent: a version copies the leaf's
ancestors only and shares all other nodes with the original. The copies inside the leaf's block are
made from the block's nodes, those above from the siblings that the blocks above handed down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import staged
from ledgerwatch.llm.ranks import ranked

#: Levels of a block.
HEIGHT = 12
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Which side of a node its sibling is on; the last node of an odd level has none.
LEFT, NONE, RIGHT = -1, 0, 1
_TREE = ["known", "lang"]


def hashed(*nodes: str) -> str:
    """Digest of the nodes' digests, concatenated as hex text."""
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels(nodes: list[str], size: int, height: int) -> list[list[str]]:
    """A block's levels from its nodes up to its root.

    A block that is a whole tree of ``size`` nodes ends where one node is left; any other has ``height``
    levels above its nodes, in which a lone node is hashed by itself.
    """
    out = [nodes]
    whole = size <= 1 << height
    while len(out[-1]) > 1 or not (whole or len(out) > height):
        below = out[-1]
        out.append([hashed(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(tree: list[list[str]], at: int) -> Iterator[tuple[str, int]]:
    """(sibling, side) of the node and of each of its ancestors but the last."""
    for level in tree[:-1]:
        other = at ^ 1
        yield (level[other], RIGHT if other > at else LEFT) if other < len(level) else ("", NONE)
        at >>= 1


def copies(leaf: str, path: list[str], sides: list[int]) -> list[str]:
    """The ancestors that a version with this leaf copies, the last of them its root."""
    out = []
    for other, side in zip(path, sides, strict=True):
        leaf = hashed(leaf) if side == NONE else hashed(leaf, other) if side == RIGHT else hashed(other, leaf)
        out.append(leaf)
    return out


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as ``byte count:value``, a null as ``-``."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, known, lang, leaf and, where ``tampered`` holds, ``changed``: the leaf with n_chars + 1."""
    fields = {c: docs[c] for c in FIELDS}
    more = {**fields, "n_chars": fields["n_chars"].cast("decimal(38,0)") + 1}
    return docs.select(
        docs["doc_id"],
        docs["lang"].isNotNull().alias("known"),
        F.coalesce(docs["lang"], F.lit("")).alias("lang"),
        leaf_digest(*fields.values()).alias("leaf"),
        F.when(tampered, leaf_digest(*more.values())).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )


def _roots(nodes: DataFrame, tree: list[str], height: int, name: str) -> DataFrame:
    """tree, pos, size, digest of the roots of the blocks."""

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size = int(block["size"].iloc[0])
        root = levels(block["digest"].tolist(), size, height)[-1][0]
        return pd.DataFrame([(*key, -(-size >> height), root)], columns=[*tree, "pos", "size", "digest"])

    kinds = dict(nodes.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in tree] + ["pos long, size long, digest string"])
    dealt = nodes.select(*tree, "pos", "size", "digest").withColumn("block", F.shiftright("pos", height))
    return staged(dealt.groupBy(*tree, "block").applyInPandas(run, schema), name)


_PATH = "siblings array<string>, sides array<int>"


def _paths(nodes: DataFrame, above: DataFrame, tree: list[str], height: int, carried: dict[str, str]) -> DataFrame:
    """Nodes with their siblings up to the root, those above their block taken from ``above``.

    ``carried`` are columns of ``above`` to hand down, with their types.
    """
    own = [c for c in nodes.columns if c not in ("siblings", "sides")]
    kinds = dict(nodes.dtypes)

    def run(block: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos").reset_index(drop=True)
        tree_levels = levels(block["digest"].tolist(), int(block["size"].iloc[0]), height)
        top = over.iloc[0]
        ways = [list(siblings(tree_levels, k)) for k in range(len(block))]
        block["siblings"] = [[x for x, _ in way] + list(top["siblings"]) for way in ways]
        block["sides"] = [[s for _, s in way] + list(top["sides"]) for way in ways]
        for c in carried:
            block[c] = top[c]
        return block[[*own, "siblings", "sides", *carried]]

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in own], _PATH, *[f"{c} {t}" for c, t in carried.items()]])
    below = nodes.select(*own).withColumn("block", F.shiftright("pos", height)).groupBy(*tree, "block")
    over = above.select(*tree, F.col("pos").alias("block"), "siblings", "sides", *carried).groupBy(*tree, "block")
    return below.cogroup(over).applyInPandas(run, schema)


def _climbed(nodes: DataFrame, tree: list[str], height: int, name: str) -> list[DataFrame]:
    """The nodes and, level by level, the roots of their blocks, until each tree is one node."""
    out = [nodes]
    while True:
        out.append(_roots(out[-1], tree, height, f"merkle-{name}"))
        if out[-1].where("size > 1").isEmpty():
            return out


def manifest(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, changed, subroot, root, siblings, sides, of rows as ``leaves`` gives them.

    Within a language rows are ordered by doc_id (null first), rows that share one by their leaf. A null
    language is a tree of its own, before the others. An empty table gives no rows.
    """
    kept = staged(rows, "merkle-leaves")
    placed = ranked(kept, _TREE, ["doc_id", "leaf", "row"], "merkle-order").withColumnRenamed("leaf", "digest")
    placed = staged(placed.select(*_TREE, "doc_id", "digest", "changed", "pos", "size"), "merkle-nodes")
    trees = _climbed(placed, _TREE, height, "trees")
    subroots = trees[-1].select(F.lit(0).alias("all"), *_TREE, "digest")
    subroots = staged(ranked(subroots, ["all"], _TREE, "merkle-order").drop("part"), "merkle-subroots")
    upper = _climbed(subroots, ["all"], height, "upper")

    none = [F.array().cast("array<string>").alias("siblings"), F.array().cast("array<int>").alias("sides")]
    at = upper[-1].select("*", *none, F.col("digest").alias("root"))
    for nodes in upper[-2::-1]:
        at = _paths(nodes, at, ["all"], height, {"root": "string"})
    at = at.select(*_TREE, F.lit(0).cast("long").alias("pos"), "siblings", "sides", "root", F.col("digest").alias("subroot"))
    for nodes in trees[-2::-1]:
        at = _paths(nodes, staged(at, "merkle-paths"), _TREE, height, {"root": "string", "subroot": "string"})
    return at.withColumnRenamed("digest", "leaf").drop("pos", "size", *_TREE)


def versions(proved: DataFrame) -> DataFrame:
    """``proved`` with ``copied``: the ancestors that the version of a changed leaf copies, up to its root.

    For a leaf without a change they are recomputed from the leaf itself and equal the original ones.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            now = batch["changed"].where(batch["changed"].notna(), batch["leaf"])
            batch["copied"] = [copies(x, p, s) for x, p, s in zip(now, batch["siblings"], batch["sides"], strict=True)]
            yield batch

    schema = ", ".join(f"{c} {t}" for c, t in proved.dtypes) + ", copied array<string>"
    return proved.mapInPandas(run, schema)


def verify(docs: DataFrame, tampered: Column, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``tampered`` marks rows whose n_chars was raised by one after the manifest was made (a null stays).
    Null fields count as such in the leaf; other columns are ignored; see ``manifest`` for order,
    repeated rows and empty tables.
    """
    proved = versions(manifest(leaves(docs, tampered), height))
    now = F.coalesce("changed", "leaf")
    folded = F.when(F.size("copied") > 0, F.element_at("copied", -1)).otherwise(now)
    proof = F.sha2(F.array_join("siblings", ""), 256)
    return proved.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
