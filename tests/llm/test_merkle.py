"""The manifest held against a plain tree; versions, odd rows, blocks of few levels."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import merkle

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc, text, lang, source, n = row
    n = None if n is None else n + more
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)])


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(levels, at):
    for level in levels[:-1]:
        run = level[at - at % 2 : at - at % 2 + 2]
        yield run, at % 2
        at //= 2


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by = {x: sorted([r for r in rows if r[2] == x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in by[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            steps = [*way(trees[x], i), *way(top, k)]
            proof = h(*[d for run, at in steps for j, d in enumerate(run) if j != at])
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = leaf(r, 1 if tampered else 0)
            for run, at in steps:
                now = h(*[now if j == at else d for j, d in enumerate(run)])
            out.append((str(r[0]), leaf(r), trees[x][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out)


def run(spark, rows, height=merkle.HEIGHT):
    docs = spark.createDataFrame(rows, DDL).withColumn("pos", F.lit("clash")).withColumn("size", F.lit(None).cast("string"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.verify(docs.repartition(3), tampered, height).collect()
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got)


def make(n, langs):
    return [(i * 3 - 20, f"text é {i}" if i % 11 else None, langs[i % len(langs)], "s" if i % 5 else None, i if i % 13 else None) for i in range(n)]


@pytest.mark.parametrize(("n", "height"), [(1, 12), (2, 1), (5, 1), (9, 2), (33, 2), (100, 12), (100, 1)])
def test_equals_a_plain_tree(spark, n, height):
    rows = make(n, ["de", None, "en", "", "\U0001f600", "￿"][: 1 + n % 6])
    assert run(spark, rows, height) == plain(rows)


def test_repeated_and_null_ids(spark):
    rows = [(None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (7, "x", "en", "s", 3), (7, "x", "en", "s", 3), (7, "y", "en", "s", 3), (None, None, None, None, None)]
    assert run(spark, rows) == plain(rows)


def test_a_tampered_leaf_is_found_and_copies_only_ancestors(spark):
    rows = make(40, ["de", "en"])
    docs = spark.createDataFrame(rows, DDL)
    got = merkle.versions(merkle.manifest(merkle.leaves(docs, F.col("doc_id") == 1))).collect()
    for r in got:
        assert len(r.copied) == len(r.siblings) == 6
        assert (r.copied[-1] == r.root) == (r.doc_id != 1)
    null_count = [(1, "t", "en", "s", None)]
    assert merkle.verify(spark.createDataFrame(null_count, DDL), F.lit(True)).head().verified


def test_empty_table(spark):
    out = merkle.verify(spark.createDataFrame([], DDL), F.lit(True))
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
