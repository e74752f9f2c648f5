"""Winnowing held against a plain version; order, copies and odd rows of the comparison."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerwatch.llm import fingerprints as fp


def plain_places(hashes: list[int]) -> list[int]:
    keys = [(h % 2**64) >> 33 for h in hashes]
    ends = range(max(1, len(keys) - fp.W + 1)) if keys else []
    found = set()
    for at in ends:
        window = range(at, min(at + fp.W, len(keys)))
        low = min(keys[i] for i in window)
        found.add(max(i for i in window if keys[i] == low))
    return sorted(found)


def words(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(rf"[^\x20\x09-\x0D]{{1,{fp.LONGEST}}}", lowered)


def fingerprint_rows(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashes = rows.select("doc_id", "text", fp.grams(F.coalesce("text", F.lit(""))).alias("grams"))
    return hashes.withColumn("fingerprint", fp.winnowed(F.col("grams"))).orderBy("doc_id").collect()


def test_windows_keep_the_rightmost_smallest_hash(spark):
    texts = [
        None, "", " \t\n", "one", "one two three four", "a b c d e", "a b c d e f", " ".join(f"w{i}" for i in range(400)),
        "same " * 300, "x y " * 50 + "z" * 1000, "Ünïcode 漢字漢字 😀 " * 40, "z" * 5000,
    ]
    for row in fingerprint_rows(spark, texts):
        n = len(words(row.text or ""))
        assert len(row.grams) == (0 if n == 0 else max(1, n - fp.K + 1))
        assert [x.position for x in row.fingerprint] == plain_places(row.grams)
        assert [x.hash for x in row.fingerprint] == [row.grams[x.position] for x in row.fingerprint]


def test_equal_grams_hash_alike_and_short_texts_differ(spark):
    a, b, c, d, e = fingerprint_rows(spark, ["p q a b c d e r", "x a B c D e y z", "a b", "b a", "a"])
    assert a.grams[2] == b.grams[1] and len(set(a.grams) & set(b.grams)) == 1
    assert len({c.grams[0], d.grams[0], e.grams[0]}) == 3


def test_a_shared_run_shares_a_kept_hash(spark):
    run = [f"k{i}" for i in range(fp.W + fp.K - 1)]
    texts = [" ".join([f"{side}{i}" for i in range(before)] + run + [f"{side}x{i}" for i in range(30)]) for side, before in (("p", 17), ("q", 40), ("r", 3))]
    kept = [{x.hash for x in row.fingerprint} for row in fingerprint_rows(spark, texts)]
    assert kept[0] & kept[1] and kept[1] & kept[2] and kept[0] & kept[2]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=60), min_size=1, max_size=20))
def test_any_text(spark, texts):
    for row in fingerprint_rows(spark, texts):
        assert [x.position for x in row.fingerprint] == plain_places(row.grams)


def plain_compare(rows):
    order = sorted(rows, key=lambda r: r[0])
    out = {}
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        out[doc] = (len(text), text[: len(text) - half] + after[:half], after)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 57])
def test_neighbours_follow_doc_id(spark, n):
    rows = [(i * 7 % 101 - 30, f"text {i} " * (i % 9) + "é😀" * (i % 4)) for i in range(n)]
    want = plain_compare(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("part", F.lit("x"))
    got = {r.doc_id: r for r in fp.compare(docs.repartition(3)).collect()}
    assert got.keys() == want.keys()
    whole = dict(rows)
    for doc, (n_chars, edited, after) in want.items():
        assert got[doc].n_chars == n_chars
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if edited == whole[doc]:
            assert got[doc].near_edited == 1.0 and got[doc].fingerprint == got[doc].edited_fingerprint
        if after == whole[doc]:
            assert got[doc].near_next == 1.0


def test_repeated_and_null_rows(spark):
    rows = [(None, None), (None, "b"), (4, "same text here"), (4, "same text here"), (4, "same text here"), (9, None), (4, "other"), (None, "b")]
    got = fp.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((d is not None, d or 0) for d, _ in rows)
    same = [r for r in got if r.doc_id == 4 and r.n_chars == 14]
    assert len(same) == 3 and sum(r.near_next == 1.0 for r in same) == 2
    again = fp.compare(spark.createDataFrame(rows[::-1], "doc_id long, text string")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(fp, "CHUNK", 7)
    rows = [(1, "a b c d e f g")] * 40 + [(i, f"t{i} u v w x y") for i in range(2, 30)]
    got = fp.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert sum(r.near_next == 1.0 for r in got) == 39


def test_empty_table(spark):
    out = fp.compare(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and out.columns[-1] == "near_next"
