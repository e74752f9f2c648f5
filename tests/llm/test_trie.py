"""The trie held against a plain one over tuples; the slot table; odd rows and narrow fragments."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import trie

DDL = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            content = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, content), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + mine[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    out = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(out[x][5] for x in children[node]) or 1
        saved = sum(out[x][6] for x in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out[node] = (min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, DDL).withColumn("pos", F.lit(1)).withColumn("part", F.lit("x")).repartition(3)
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 6
    got = trie.prefix_trie(docs, conv - conv % 100, head, 5, **more).collect()
    return sorted((tuple(r) for r in got), key=str)


def make(convs, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for c in convs:
        for t in range(int(rng.integers(1, 12))):
            rows.append((int(c), t, "user" if t % 2 == 0 else "assistant", f"say {rng.integers(2)}" * int(rng.integers(1, 3)) if t < 4 else f"é {c % 7} {t}"))
    return rows


@pytest.mark.parametrize("fragment", [trie.FRAGMENT, 3])
def test_equals_a_plain_trie(spark, fragment):
    rows = make([*range(60), *range(100, 130), 205, 350, -5, -250])
    assert run(spark, rows, fragment=fragment) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "a"), (1, 5, "user", None), (1, 5, "user", None), (None, 1, "user", "x"), (0, 2, "a", "b"),
        (0, -1, "ab", ""), (7, 0, "user", "long " * 3000), (8, 0, "user", "long " * 3000), (303, 0, "u", "t"), (304, 0, "u", "t"), (305, 0, "u", "t"), (306, 0, "u", "t"),
    ]
    assert run(spark, rows) == plain(rows)


def test_one_long_conversation_beside_short_ones(spark):
    rows = [(4, t, "user", f"turn {t}") for t in range(700)] + make(range(20, 40))
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 30000):
        high, low = rng.integers(-(2**63), 2**63, (2, n))
        table = trie.SlotTable(high, low)
        assert sorted(table.slots(high, low)) == list(range(n))
        assert (table.slots(high, low + 1) == -1).all()
    with pytest.raises(ValueError):
        trie.SlotTable(np.array([5, 5]), np.array([6, 6]))


def test_id_lists_of_many_pieces(spark, monkeypatch):
    ends = spark.range(0, 30000, 3).select(F.lit(1).cast("long").alias("high"), (F.col("id") % 2).alias("low"), F.col("id").alias("conv_id"))
    got = {r.low: r.ends_sha256 for r in trie.ends_digests(ends).collect()}
    for low in (0, 1):
        ids = ",".join(str(i) for i in range(0, 30000, 3) if i % 2 == low)
        assert got[low] == hashlib.sha256(ids.encode()).hexdigest()
