"""Operators against plain versions, on the smallest tables and on odd ones."""

import base64
import gzip
import hashlib
import math
import os
import random
import re
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from checks.compare import bag, oracle_connection  # noqa: E402
from ledgerwatch.llm import (  # noqa: E402
    common, decontaminate, embeddings, html, jaccard, language, packing, privacy, quality, rans, token_files, tokens, warc,
)
from ledgerwatch.llm.oracles import SQL  # noqa: E402
from ledgerwatch.llm.queries import QUERIES  # noqa: E402
from ledgerwatch.session import BATCH  # noqa: E402

SF, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BYTES, WORDS = tokens.vocabulary_path("byte_bpe_50k.json"), tokens.vocabulary_path("word_bpe_49k.json")
LONG = "alpha beta gamma delta epsilon zeta eta theta " * 30_000
ODD = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (5, "One two three four five six seven eight nine ten eleven twelve", "en"), (6, "a b", "de"), (7, "A B", "de"), (8, "12345 !!! ...", None),
    (9, LONG, "en"), (10, LONG + "omega", "en"), (11, "x" * 50_000, None), (12, "mail a.b@c.example.com or 10.0.0.1, +49 (30) 1234-5678", "en"),
    (None, "one two three four five six seven eight nine ten eleven twelve", None), (None, None, None), (6, "a b", "de"),
    (13, "İstanbul É é 中文 \U0001f600 naïve don't", "fr"), (14, "  double  spaces \n\n and lines\r\n", "en"),
]
CLASH = {c: 7 for c in ("component_id", "score", "n", "cls", "copy", "start", "word", "row", "kept", "found", "x", "y", "token", "host", "node")}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, "src", None, *CLASH.values()) for i, t, lang in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASH))


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cursor = oracle_connection(SF).execute(SQL[name])
    want = bag([d[0] for d in cursor.description], cursor.fetchall())
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


# 1: embeddings


@pytest.mark.parametrize("length", [4096, 70])
def test_embeddings_equal_all_pairs(spark, monkeypatch, length):
    monkeypatch.setattr(embeddings, "SEQUENCE", length)
    vectors = [(r.vec_id, r.embedding) for r in common.table(spark, SF, "embeddings").collect()]
    want = plain.cosine_links(vectors)
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op1_embedding_near_dedup"](spark, SF).collect()}
    assert got == want


def test_odd_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=8)
    vectors = [(k, (base + rng.normal(scale=0.25, size=8)).tolist()) for k in range(60)]
    vectors += [(60, None), (61, []), (62, [0.0] * 8), (63, [None] + [1.0] * 7), (64, [math.nan] * 8), (65, [math.inf] + [0.0] * 7)]
    vectors += [(66, vectors[0][1]), (67, vectors[0][1]), (68, [2 * x for x in vectors[0][1]]), (69, [1e-200 * x for x in vectors[0][1]])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<double>, n int, component_id int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    want = plain.cosine_links([(i, [x * 1e200 for x in v] if i == 69 else v) for i, v in vectors])
    assert got == want
    assert embeddings.near_duplicates(df.where("false")).collect() == []
    shared = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    rows = sorted(tuple(r) for r in embeddings.near_duplicates(shared).collect() if r.vec_id)
    assert [r[2] for r in rows] == [1, 1, 1, 1]


@pytest.mark.parametrize(("length", "widths"), [(4096, 16), (30, 2)])
def test_vectors_link_with_those_of_their_width(spark, monkeypatch, length, widths):
    monkeypatch.setattr(embeddings, "SEQUENCE", length)
    monkeypatch.setattr(embeddings, "WIDTHS", widths)
    rng = np.random.default_rng(6)
    vectors = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [3.0, 0.1]), (6, [4.0]), (7, [-4.0]), (8, [0.5])]
    for k, width in enumerate([40] * 60 + [7] * 50 + [20] * 30 + [1] * 5, 10):
        vectors.append((k, (rng.integers(0, 2, width) * 4 + rng.normal(size=width)).tolist()))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    want = {}
    for width in {len(v) for _, v in vectors}:
        want |= plain.cosine_links([(i, v) for i, v in vectors if len(v) == width])
    assert got == want and got[1] == (1, 1) and got[3] == (1, 3)


def test_pairs_of_sequences_are_shipped_in_turns(spark, monkeypatch):
    vectors = [(r.vec_id, r.embedding) for r in common.table(spark, SF, "embeddings").collect()]
    vectors += [(10**6 + k, x[::-1]) for k, x in vectors] + [(2 * 10**6, [1.0, 2.0]), (2 * 10**6 + 1, [1.0, 2.1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(embeddings, "SEQUENCE", 20)
    monkeypatch.setattr(embeddings, "GROUP", 3 * 20 * 64 * 8)
    monkeypatch.setattr(embeddings, "SHIPPED", 1)
    files = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines()
    held, joined = [], embeddings._joined

    def turn(*args):
        held.append(sum(os.path.getsize(f) for f in files() if "shuffle_" in f and os.path.exists(f)))
        return joined(*args)

    monkeypatch.setattr(embeddings, "_joined", turn)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    want = plain.cosine_links(vectors[:-2]) | plain.cosine_links(vectors[-2:])
    assert got == want and got[2 * 10**6] == (1, 2 * 10**6)
    assert len(held) > 2 and max(held) <= held[0]  # nothing of a turn is left when the next begins
    assert spark.conf.get(embeddings._CLEANUP, "false") == "false"


def test_small_sequences_and_leaves_agree(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF", 4)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(30, 6)), 3, axis=0) + rng.normal(scale=0.1, size=(90, 6))
    lead = np.eye(6)[:, :3]
    weight = np.ones(90, np.int64)
    n, _, root = embeddings.join_sequences(x, None, lead, 0.9, weight, weight)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    assert (n == (u @ u.T >= 0.9).sum(1) - 1).all()
    half, other, _ = embeddings.join_sequences(x[:40], x[40:], lead, 0.9, weight[:40], weight[40:])
    across = u[:40] @ u[40:].T >= 0.9
    assert (half == across.sum(1)).all() and (other == across.sum(0)).all()


# 2: language


def test_language_of_held_out_texts(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, SF).collect()}
    rows = [r for r in docs.collect() if r.lang]
    right = [got[r.doc_id].lang_pred == r.lang for r in rows if got[r.doc_id].held_out]
    assert len(right) > 20 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == docs.count()


def test_odd_languages(spark, odd, docs):
    model = language.learn(docs)
    rows = language.predict(odd, model).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r.lang_pred for r in rows if r.doc_id}
    assert [by_id[k] for k in (1, 2, 3, 8)] == ["und"] * 4
    assert language.predict(odd.where("false"), model).collect() == []
    nothing = language.learn(odd.where("false"))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}


def test_unseen_words_back_off():
    known = np.array([1], np.uint64), np.zeros((1, 2))
    model = language.Model(["a", "b"], {0: known})
    assert model.sums(["zzz"])[1].tolist() == [0.0]
    points, starts, ends = language._runs("ab")
    grams, word = language._gram_hashes(*language._padded(points, starts, ends), 3)
    model = language.Model(["a", "b"], {3: (np.sort(grams), np.array([[0.0, -1.0], [0.0, -3.0]]))})
    total, used = model.sums(["ab ab"])
    assert total.tolist() == [[0.0, -4.0]] and used.tolist() == [2.0]


FOREIGN = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由 在尊严和权利上一律平等", "人",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van",
]


def test_unlearned_languages_and_gibberish_go(spark, docs):
    rng = random.Random(7)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(4, 10)))
    bad = [*FOREIGN, *[t * 50 for t in FOREIGN], *[" ".join(word("bcdfghjkmpqvwxz") for _ in range(n)) for n in (3, 30, 3000)]]
    bad += [" ".join(word("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (40, 3000)]
    more = spark.createDataFrame([(10**6 + k, t, 1) for k, t in enumerate(bad)], "doc_id long, text string, n int")
    labelled = docs.select("doc_id", "text", "lang")
    mixed = labelled.union(more.select("doc_id", "text", F.lit(None).cast("string")))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, mixed, SF).collect()}
    assert kept == {r.doc_id for r in labelled.collect()}
    model = language.learn(docs)
    found = language.predict(more, model).collect()
    nothing_known = {(r.lang_pred, r.score) for r in found if r.doc_id in (10**6 + 1, 10**6 + 2)}
    assert nothing_known == {(model.langs[0], 1 / len(model.langs))}


def test_stage_identifies_every_text(spark, docs):
    some = docs.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"), "text")
    more = spark.createDataFrame([(None, None, "the house and the garden were old"), (None, None, "123"), (None, None, None), (-1, "xx", "a")], some.schema)
    mixed = some.union(more)
    pred = {r.doc_id: r.lang_pred for r in language.predict(some, language.learn(mixed)).collect()}
    rows = corpus_pipeline.identify_language(spark, mixed, SF).collect()
    labels = {r.doc_id: r.lang for r in some.collect()}
    assert {(r.doc_id, r.lang) for r in rows if r.doc_id not in (None, -1)} == {(i, x or pred[i]) for i, x in labels.items()}
    assert [(r.lang, r.text[:9]) for r in rows if r.doc_id is None] == [("en", "the house")]
    assert sum(x is None for x in labels.values()) > 50


def plain_language(labelled, text):
    """Words first, then n-grams 5 to 1 of unseen words, over dictionaries."""
    runs = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    grams = lambda w, n: [f",{w},"[k : k + n] for k in range(len(w) + 3 - n)]
    langs = sorted({x for x, _ in labelled})
    counts = {kind: {} for kind in range(6)}
    for lang, known in labelled:
        for w in runs(known):
            for kind in range(6):
                for g in [w] if kind == 0 else grams(w, kind):
                    counts[kind].setdefault(g, dict.fromkeys(langs, 0))[lang] += 1
    sums = {kind: {x: sum(c[x] for c in own.values()) + 0.5 * len(own) for x in langs} for kind, own in counts.items()}
    log = lambda kind, g, x: math.log((counts[kind][g][x] + 0.5) / sums[kind][x])
    total, used = dict.fromkeys(langs, 0.0), 0
    for w in runs(text):
        for kind in (0, 5, 4, 3, 2, 1):
            found = [g for g in ([w] if kind == 0 else grams(w, kind)) if g in counts[kind] and g != ","]
            if found:
                used += 1
                for x in langs:
                    total[x] += sum(log(kind, g, x) for g in found) / len(found)
                break
    scaled = [math.exp((total[x] - max(total.values())) * min(1.0, language.EVIDENCE / max(used, 1))) for x in langs]
    best = max(range(len(langs)), key=lambda k: (scaled[k], -k))
    return langs[best], scaled[best] / sum(scaled)


def test_scores_equal_a_plain_back_off(spark, docs):
    rows = [r for r in docs.collect() if r.lang and r.text]
    some = [(r.lang, r.text[:1500]) for r in rows[:60]] + [("xx", "ça où été naïve Ünï 漢字 漢"), ("xx", "1a2b l'été")]
    labelled = spark.createDataFrame([(k, *x) for k, x in enumerate(some)], "doc_id long, lang string, text string").repartition(3)
    model = language.learn(labelled.select("doc_id", "text", "lang"), words=10**6, grams=10**6)
    texts = [r.text[:700] for r in rows[60:110]] + ["漢字", "été 漢語", "qzxqzx", "a b c", "l'ouïe"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language.predict(asked, model).collect():
        lang, score = plain_language(some, texts[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9, texts[r.doc_id]


def test_every_labelled_row_teaches(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k: "w" + "".join(letters[k // 26**i % 26] for i in range(3))
    rows = [(k, f"shared {word(k)} shared", "xx") for k in range(2500)] + [(None, "alone", "yy"), (7, None, "xx"), (8, "lost", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = language.learn(docs)
    known, logs = model.kinds[0]
    assert model.langs == ["xx", "yy"] and len(known) == 2502
    total = 7500 + 0.5 * 2502
    assert np.isclose(np.sort(logs[:, 0])[-1], math.log(5000.5 / total))
    assert np.isclose(np.sort(logs[:, 0])[1:-1], math.log(1.5 / total)).all()
    likes = language.judged(docs, model, "like").persist()
    found = np.array([r["like"] for r in likes.where("lang is not null and like is not null").collect()])
    middle, low = np.percentile(found, [50, 5])
    want = max(middle - max(language.LEAST_GAP, language.SPREAD * (middle - low)), middle + language.WORST * (model.unseen().max() - middle))
    assert len(found) == 2501 and abs(language.least_likeness(likes, model, "like") - want) < 1e-3
    likes.unpersist()


# 3 and 5: tokens


@pytest.mark.parametrize(("path", "spaced"), [(BYTES, True), (WORDS, False)])
def test_chunks_encode_like_whole_texts(path, spaced):
    rng = random.Random(2)
    parts = ["the", " ", "  ", "\n", "\t", "don't", "É", "İ", "x́", "12", "...", "!!", "a.b,", " ", "\x1c", "<|endoftext|>", "中", " ", "'s", "\U0001f600"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)]
    want = [x[:-1].tobytes() for x in plain.token_ids(texts, path, 0)]
    assert tokens.encode(texts, path, spaced) == want


def packed_right(rows, docs, limits):
    ids = dict(zip([i for i, _ in docs], plain.token_ids([t for _, t in docs], BYTES, 0), strict=True))
    seen = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == plain.crc(ids[r.doc_id][r.start : r.start + r.length])
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in ids.items()}
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(r.length - 1 for r in pieces) <= limits.loss
    return sum(map(len, ids.values())) / len(sequences) / limits.tokens


def test_packing_covers_every_id_once(spark, texts):
    assert packed_right(QUERIES["op3_vector_packing"](spark, SF).collect(), texts, packing.Limits()) > 0.99


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 40), packing.Limits(64, 1, 64), packing.Limits(1, 1, 1)])
def test_packing_keeps_all_limits(spark, odd, limits):
    some = odd.where("doc_id is not null and doc_id not in (6, 9, 10, 11)")
    texts = [(i, t) for i, t, _ in ODD if i is not None and i not in (6, 9, 10, 11)]
    packed_right(packing.pack(some, BYTES, limits=limits).collect(), texts, limits)


def packed_parts(spark, limits):
    """Sequences of conversations: pieces per sequence, each checked against the plain ids and loss mask."""
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    own = {}
    for r in sorted(table.collect(), key=lambda r: (r.conv_id, r.turn)):
        own.setdefault(r.conv_id, []).append((r.text, r.role == "assistant"))
    plain_ids, mask = {}, {}
    for conv, parts in own.items():
        ids = [x[:-1] for x in plain.token_ids([t for t, _ in parts], BYTES, 0)]
        plain_ids[conv] = np.concatenate([*ids, [0]]).astype("<u4")
        mask[conv] = np.concatenate([np.full(len(x), bears) for x, (_, bears) in zip(ids, parts, strict=True)] + [[parts[-1][1]]])
    rows = packing.pack_parts(packing.conversation_parts(table), BYTES, limits=limits, with_ids=True).collect()
    sequences, seen = {}, dict.fromkeys(own, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id]
        seen[r.doc_id] += r.length
        cut = slice(r.start, r.start + r.length)
        assert bytes(r.ids) == plain_ids[r.doc_id][cut].tobytes()
        assert r.loss_tokens == mask[r.doc_id][cut][1:].sum()
        sequences.setdefault(r.sequence_id, []).append(r)
    assert seen == {c: len(x) for c, x in plain_ids.items()}
    used = [(sum(r.length for r in s), len(s), sum(r.loss_tokens for r in s)) for s in sequences.values()]
    assert all(u <= l for x in used for u, l in zip(x, limits, strict=True))
    return [sum(x[k] == limits[k] for x in used) / len(used) for k in range(3)]


def test_each_limit_binds_on_conversations(spark):
    assert packed_parts(spark, packing.Limits(512, 64, 512))[0] > 0.9
    assert packed_parts(spark, packing.Limits(4096, 2, 4096))[1] > 0.9
    tokens_full, _, loss_full = packed_parts(spark, packing.Limits(1024, 64, 200))
    assert loss_full > 0.9 > tokens_full


def test_packing_odd_parts(spark):
    schema = "doc_id long, parts array<struct<text: string, bears_loss: boolean>>, start int"
    rows = [(1, None, 0), (2, [], 0), (3, [(None, True), ("a b", None)], 0), (None, [("x", True)], 0), (4, [("long " * 5000, True), ("", False)], 0)]
    got = packing.pack_parts(spark.createDataFrame(rows, schema), BYTES, limits=packing.Limits(64, 4, 32)).collect()
    assert {r.doc_id: r.doc_tokens for r in got} == {1: 1, 2: 1, 3: 3, None: 2, 4: 5002}
    assert sum(r.length for r in got if r.doc_id == 4) == 5002


def test_packing_odd_tables(spark, odd):
    rows = packing.pack(odd, BYTES, with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length for r in rows)
    assert sum(r.doc_id == 6 for r in rows) == 2 and sum(r.start == 0 for r in rows if r.doc_id is None) == 2
    assert packing.pack(odd.where("false"), BYTES).collect() == []


@pytest.mark.parametrize("n", [0, 1, rans.LANES, rans.LANES * rans.STEPS + 17, 5 * rans.LANES * rans.STEPS])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 999).astype(np.int64)
    counts = np.bincount(ids, minlength=1000)
    table = rans.make_table(rans.shares(counts))
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    for k in range(len(block.marks)):
        own = ids[k * rans.STEPS * rans.LANES : (k + 1) * rans.STEPS * rans.LANES]
        assert (rans.decode_part(block, k, table) == own).all()
    if n > 100_000:
        p = counts[counts > 0] / n
        assert len(block.words) * 8 < 1.03 * n * -(p * np.log2(p)).sum() + 64 * rans.LANES
        spoilt = block._replace(words=block.words[:400] + bytes([block.words[400] ^ 1]) + block.words[401:])
        with pytest.raises((ValueError, IndexError)):
            rans.decode(spoilt, table)


def test_shares_sum_and_keep_rare_symbols():
    for counts in ([1], [10**12, 1, 0, 1], [1] * 70_000, [3] * 1000 + [0, 10**9]):
        out = rans.shares(np.array(counts))
        assert out.sum() == rans.TOTAL and ((out > 0) == (np.array(counts) > 0)).all()


def files_right(rows, docs):
    want, start = [], 0
    for (i, _), ids in zip(docs, plain.token_ids([t for _, t in docs], WORDS, 1), strict=True):
        want.append((i, start, len(ids), plain.crc(ids)))
        start += len(ids)
    return sorted(map(tuple, rows)) == want


def test_token_files_refuse_ids_over_16_bits(spark, odd):
    for size, end in ((1 << 17, 1), (100, 100), (100, -1)):
        with pytest.raises(ValueError, match="16 bits"):
            token_files.write_tokens(odd, "nowhere", WORDS, size, end)


def test_token_files(spark, texts, odd, monkeypatch):
    assert files_right(QUERIES["op5_rans_token_files"](spark, SF).collect(), sorted(texts))
    path = common.scratch(spark, "odd-tokens")
    some = odd.where("doc_id is not null and doc_id != 6")
    token_files.write_tokens(some, path, WORDS, 49408, 1)
    assert files_right(token_files.read_tokens(spark, path, 49408).collect(), [(i, t) for i, t, _ in ODD if i not in (None, 6)])
    path = common.scratch(spark, "all-odd-tokens")
    token_files.write_tokens(odd, path, WORDS, 49408, 1)
    rows = token_files.read_tokens(spark, path, 49408).collect()
    assert len(rows) == len(ODD) and {r.doc_id for r in rows if r.start < 15} >= {None, 1}
    path = common.scratch(spark, "no-tokens")
    token_files.write_tokens(odd.where("false"), path, WORDS, 49408, 1)
    assert token_files.read_tokens(spark, path, 49408).collect() == []


# 4: shingles


def test_word_hashes_cut_like_the_pattern(monkeypatch):
    monkeypatch.setattr(common, "SEGMENT", 64)
    rng = random.Random(4)
    texts = ["".join(rng.choices(["Ab", "é", " ", "\n", "\x0b", "x" * 70, " ", "c"], k=rng.randrange(60))) for _ in range(300)]
    column = pa.array([*texts, None, ""])
    got = []
    for _, data, offsets in common.text_slices(column, 64):
        hashes, at = common.word_hashes(data, offsets, jaccard._APART)
        got += [hashes[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    words = [plain.SPLIT.findall(plain.lowered(t)) for t in [*texts, "", ""]]
    assert [len(x) for x in got] == [len(w) for w in words]
    code = {}
    assert all(code.setdefault(w, h) == h for ws, hs in zip(words, got, strict=True) for w, h in zip(ws, hs, strict=True))
    assert len(set(code.values())) == len(code)


def near_copies(n, seed, base=60):
    """Families of edited copies, one of them large, beside shared passages and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(30)]
    families = [[word() for _ in range(rng.randrange(5, base))] for _ in range(max(2, n // 12))]
    out = []
    for k in range(n):
        words = list(families[0] if k % 3 == 0 else rng.choice(families))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = word()
        if k % 5 == 0:
            words += passage
        out.append((k, " ".join(words)))
    return [*out, *[(n + k, "same few") for k in range(3)], (n + 3, ""), (n + 4, None)]


@pytest.mark.parametrize(("seed", "heads", "pivots"), [(1, 8, 3), (2, 2, 1), (3, 1, 1)])
def test_jaccard_equals_all_pairs(spark, monkeypatch, seed, heads, pivots):
    monkeypatch.setattr(jaccard, "HEADS", heads)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    docs = near_copies(150, seed)
    rows = jaccard.jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain.jaccard(docs)


def test_pair_stream_does_not_depend_on_batches(monkeypatch):
    rng = np.random.default_rng(8)
    n = 400
    rows = sorted((int(t), -int(y), int(c)) for t, y, c in zip(rng.integers(0, 12, n), rng.integers(0, 3, n), rng.integers(0, 60, n), strict=True))
    kind = {c: y for _, y, c in rows}
    rows = sorted({(t, kind[c], c) for t, _, c in rows})
    cols = [np.array([r[0] for r in rows]), np.array([r[2] for r in rows]), np.full(len(rows), 100 << 32), np.array([r[1] for r in rows], np.int32)]

    def run(step):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[k : k + step]) for c in cols], names=["token", "cls", "span", "typ"]) for k in range(0, len(rows), step)]
        out = pa.Table.from_batches(list(jaccard._pairs(iter(batches)))).to_pylist()
        return {(r["a"], r["b"]) for r in out if r["token"] is None}, sorted((r["token"], r["a"]) for r in out if r["token"] is not None)

    whole = run(len(rows))
    assert all(run(step) == whole for step in (1, 3, 7, 50))
    sizes = np.bincount(cols[0])
    assert len(whole[1]) == sum(s for s in sizes if s > jaccard.HEADS)


def test_suffix_filter_excludes_unrelated_sets_of_any_size(spark):
    rng = np.random.default_rng(9)
    classes, unrelated, near = [], [], []
    for n in (60, 300, 1000, 3000, 20_000):
        for _ in range(6):
            x, y = (np.unique(rng.integers(0, 1 << 63, m, dtype=np.uint64) * np.uint64(2)) for m in (n, int(n * 1.2)))
            k = len(classes)
            edge = np.concatenate([x[: -(len(x) // 10)], y[: len(x) // 25]])  # shares about four fifths with x
            classes += [(k + j, jaccard._ranges(np.unique(s))) for j, s in enumerate((x, y, edge))]
            unrelated.append((k, k + 1, n))
            near.append((k, k + 2, len(np.intersect1d(x, edge)) / len(np.union1d(x, edge))))
    table = spark.createDataFrame(classes, "cls long, ranges array<int>")
    pairs = spark.createDataFrame([p[:2] for p in unrelated + near], "a long, b long")
    kept = {(r.a, r.b) for r in jaccard._hopeful(pairs, table, "hopeful").collect()}
    assert all(share >= 0.75 for *_, share in near) and {p[:2] for p in near} <= kept
    assert not [p for p in unrelated if p[2] >= 300 and p[:2] in kept]


def test_clashing_keys_give_way_to_other_bits():
    sets = [np.array([k, k + 1], np.uint64) for k in range(3)]
    keys = [jaccard._class_of(s) for s in sets]
    assert len(set(keys)) == 3 and jaccard._class_of(sets[0][:0]) == (None, None)
    assert jaccard._class_of(sets[1], frozenset({keys[1][0]})) == (keys[1][1], keys[1][1])


@pytest.mark.parametrize("buckets", [1, 64, 1 << 16])
def test_any_table_of_rarities_gives_the_same_links(spark, buckets):
    docs = common.table(spark, SF, "documents")
    want = {r.doc_id: tuple(r) for r in jaccard.jaccard_classes(docs).collect()}
    assert {r.doc_id: tuple(r) for r in jaccard.jaccard_classes(docs, buckets).collect()} == want


def test_jaccard_odd_rows(spark, odd):
    rows = jaccard.jaccard_classes(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id}
    assert by_id == plain.jaccard([(i, t) for i, t, _ in ODD if i])
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert jaccard.jaccard_classes(odd.where("false")).collect() == []
    shared = spark.createDataFrame([(1, "a b c d e f"), (1, "p q r s t u"), (2, "A B C D E F"), (3, "p q r s t u")], "doc_id long, text string")
    assert {r.component_id for r in jaccard.jaccard_classes(shared).collect()} == {1}


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(129, 200), (200, 99), (7, 7), (1, 0)]
    rows = common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    got = dict(map(tuple, rows))
    want = plain.smallest_reachable({x for e in edges for x in e}, edges)
    assert got == want and len(rows) == len(got)
    assert common.components(spark.createDataFrame([], "a long, b long"), "none").collect() == []


# 6: decontamination


def test_odd_decontamination(spark, odd):
    items = [(1, "two THREE four, five"), (2, None), (3, ""), (4, "one two three four five six seven eight nine ten eleven"), (5, "zeta eta theta alpha"), (5, "a b"), (None, "nine ten"), (6, "中文")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    rows = decontaminate.contaminated_words(odd, bench).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert (got[4].n_hit, got[4].n_items) == (11, 2) and got[5].items_sha256 == plain.digest("1,4")
    assert (got[9].n_hit, got[9].n_items) == (4 * 29_999, 1)
    assert not got[1].contaminated and got[1].items_sha256 == plain.digest("") and got[6].n_hit == 2 and got[13].n_hit == 1
    assert sum(r.contaminated for r in rows if r.doc_id is None) == 1
    assert decontaminate.contaminated_words(odd.where("false"), bench).collect() == []
    assert {r.n_hit for r in decontaminate.contaminated_words(odd, bench.where("false")).collect()} == {0}


# 7: quality


def test_quality_of_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, MORE).collect()}
    labels = [r for r in common.table(spark, MORE, "labels").collect() if got[r.doc_id].held_out]
    assert len(labels) > 50 and sum(got[r.doc_id].predicted == r.quality for r in labels) >= 0.97 * len(labels)


def test_odd_quality(spark, odd):
    measured = quality.measure(odd)
    labels = spark.createDataFrame([(4, 1), (9, 0), (10, 0), (10, 0), (12, 1), (None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    for model in (quality.fit(measured, labels), quality.fit(measured, labels.where("false")), quality.fit(measured, labels.where("quality = 1"))):
        rows = quality.score(measured, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(quality.measure(odd.where("false")), quality.Model()).collect() == []


def test_isotonic_pools_violators():
    levels = quality.isotonic(np.arange(5), [1, 1, 2, 1, 1], [0, 1, 0, 1, 1])
    assert levels.tolist() == pytest.approx([0, 1 / 3, 1 / 3, 1, 1])


# 8: pages


def test_pages_give_their_articles(spark):
    pages = {r.page_id: r for r in common.table(spark, SF, "pages").collect()}
    for r in QUERIES["op8_html_extraction"](spark, SF).collect():
        assert r.text == plain.article(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_blocks_of_marked_and_broken_pages():
    main = lambda page: [t for t, place in html.blocks(page) if place == 2]
    page = (
        "<article><h1>T &lt;1&gt;</h1><p>One&nbsp;two<br>three <b>four</b><p>five<div class='x comments'><p>said</div>"
        "<aside>no</aside><!-- <p>no</p> --><script>if (a<b) '</p>'</script><ul><li>a<li>b</ul><form>no</form>six</article><p>out</p>"
    )
    assert main(page) == ["T <1>", "One two three four", "five", "a", "b", "six"]
    assert main("<main role='main'><p id=cookie-notice>no</p>yes<p>open") == ["yes", "open"]
    for odd_page in ("", "<", "<p", "a < b > c", "</p></p>", "<!--", "<script>", "<p title='>'>x", "&", "<article>" * 50 + "x", "<a\x00b>"):
        html.blocks(odd_page)


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("<svg class=x/><p>on", "on"),
        ("<svg><path d='M0'/><p>on</p>", "on"),
        ("<!--><p>on", "on"),
        ("<!---><p>on", "on"),
        ("<!-- <p>off</p> --><p>on", "on"),
        ('<p>see <a title="the hidden gem">this</a>', "see this"),
        ("<p hidden>off</p><p>on", "on"),
        ("<p data-x=it's>hello", "hello"),
        ('<p class="lead share">one</p><p id="reply-rate">two</p><div class="entry-header"><h1>three</h1></div>', "one\ntwo\nthree"),
        ('<p>one</p><div class="comments"><p>off</p></div><section id="comments">off</section>', "one"),
        ("<p>1 < 2 <3 </ a> &lt;b&gt;", "1 < 2 <3 <b>"),
        ("<p>a<b>b<i>c</b>d</i>e<br>f", "abcde f"),
        ("<p>one<p>two<ul><li>three<li>four</ul>five", "one\ntwo\nthree\nfour\nfive"),
        ("<p>on<script>off</script >on<style>off", "onon"),
        ("<p>on <p title='unclosed>off", "on"),
    ],
)
def test_mark_up_keeps_article_text(inside, text):
    assert "\n".join(t for t, place in html.blocks(f"<nav>menu</nav><article>{inside}") if place == 2) == text


@pytest.mark.parametrize("unit", ["<a'", "<a '", '<a b="', "<b>", "<p>", "</x>", "<b hidden>", "<!", "<!--", "</", "<", "<a b=c", "<svg>", "<span hidden></p>", "&amp", "<script>", "<li><b>x"])
def test_hostile_pages_are_read_in_linear_time(unit):
    page = "<article>" + unit * (1_000_000 // len(unit))
    began = time.process_time()
    html.blocks(page)
    assert time.process_time() - began < 20


def plain_open_text(pages):
    """url, blocks per page -> texts: tokens in runs of LONG that stand on enough distinct pages of the host go."""
    streams = [tuple(" ".join(own).split()) for _, own in pages]
    runs = lambda s: [s[k : k + html.LONG] for k in range(len(s) - html.LONG + 1)]
    out = []
    for (host, own), stream in zip(pages, streams, strict=True):
        distinct = {s for (h, _), s in zip(pages, streams, strict=True) if h == host}
        covered = set()
        for k, run in enumerate(runs(stream)):
            n = sum(run in runs(s) for s in distinct)
            if n >= html.PAGES and n >= html.SHARE * len(distinct):
                covered.update(range(k, k + html.LONG))
        at, kept = 0, []
        for block in own:
            words = block.split()
            kept.append(" ".join(w for k, w in enumerate(words, at) if k not in covered))
            at += len(words)
        out.append("\n".join(x for x in kept if x))
    return out


def test_open_pages_equal_a_plain_version(spark):
    rng = random.Random(11)
    notice = [" ".join(f"n{k}x{j}" for j in range(rng.randrange(5, 30))) for k in range(6)]
    pages = []
    for k in range(90):
        own = [rng.choice(notice) for _ in range(rng.randrange(4))] + [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 40))) for _ in range(3)]
        rng.shuffle(own)
        pages.append((f"h{k % 4}", own))
    pages += [pages[0], pages[5], pages[5]]
    rows = [(k, f"http://{h}/{k}", "".join(f"<div>{b}</div>" for b in own)) for k, (h, own) in enumerate(pages)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(len(pages))] == plain_open_text(pages)
    assert sum(got[k] != "\n".join(own) for k, (_, own) in enumerate(pages)) > 30


def test_open_pages_lose_what_their_host_repeats(spark):
    notice = "we use many small words here to fill this long shared line"
    own = lambda k: " ".join(f"{w}{k}" for w in ("only", "this", "page", "has", "these"))
    rows = [(k, f"https://h.example/{k}", f"<body><div>{notice}</div><p>{own(k)}</p><div>{notice}</div></body>") for k in range(4)]
    rows += [(9, "https://other.example/", f"<body><p>{notice}</p></body>"), (10, None, None), (11, "x", ""), (10, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, row int")
    got = [(r.page_id, r.text) for r in html.extract(df).collect()]
    assert sorted(t for i, t in got if i < 4) == [own(k) for k in range(4)]
    assert dict(got)[9] == notice and [t for i, t in got if i >= 10] == ["", "", ""]
    assert html.extract(df.where("false")).collect() == []


def test_copied_pages_and_quotes_stay(spark):
    notice = "we use many small words here to fill this long shared line"
    quote = "to be or not to be that is the question he said"
    own = lambda k: " ".join(f"{w}{k}" for w in ("only", "this", "page", "has", "these"))
    copy = "a page of its own that was stored under many different numbers"
    body = lambda k: f"{own(k)} {quote}" if k < 2 else own(k)
    rows = [(k, f"https://h.example/{k}", f"<body><div>{notice}</div><p>{body(k)}</p></body>") for k in range(9)]
    rows += [(20 + k, f"https://h.example/copy{k}", f"<body><div>{notice}</div><p>{copy}</p></body>") for k in range(6)]
    rows += [(30 + k, f"https://two.example/{k}", f"<body><p>{copy}</p></body>") for k in range(2)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == body(k) for k in range(9))
    assert {got[20 + k] for k in range(6)} | {got[30], got[31]} == {copy}


# 9: archives


def test_odd_archives(spark):
    tricky = "WARC/1.1\r\nWARC-Type: nope\r\n\r\nbody\r\n\r\n\U0001f600\x00WARC/1.1\r\n"
    rows = [(1, "u", tricky), (2, None, tricky), (3, "u\r\nv", None), (4, "u", ""), (5, "w", "long " * 100_000), (None, "n", tricky), (1, "u", tricky)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int")
    path = common.scratch(spark, "odd-warc")
    warc.write_archives(df, path)
    got = sorted(map(tuple, warc.read_archives(spark, path).collect()), key=repr)
    assert len(got) == len(rows)
    kinds = [(r[0], r[5], r[6]) for r in got]
    assert sorted(kinds, key=repr) == sorted(
        [(1, "response", None)] * 2 + [(2, "revisit", 1), (3, "response", None), (4, "revisit", 3), (5, "response", None), (None, "response", None)], key=repr
    )
    assert {r[2] for r in got if r[0] == 1} == {tricky} and {r[3] for r in got if r[0] == 5} == {500_000}
    path = common.scratch(spark, "least")
    warc.write_archives(df, path, least=10**6)
    assert {r.record_type for r in warc.read_archives(spark, path).collect()} == {"response"}
    path = common.scratch(spark, "no-warc")
    warc.write_archives(df.where("false"), path)
    assert warc.read_archives(spark, path).collect() == []


def test_a_page_id_with_several_payloads_keeps_them_all(spark):
    rows = [(3, "AAA"), (4, "AAA"), (5, "AAA"), (5, "BBB unique"), (5, "AAA"), (6, "BBB unique"), (5, "CCC")]
    path = common.scratch(spark, "repeated-warc")
    warc.write_archives(spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string"), path)
    got = sorted((r.page_id, r.payload, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect() if r.payload)
    assert got == [(3, "AAA", "response", None), (5, "BBB unique", "response", None), (5, "CCC", "response", None)]
    revisits = sorted((r.page_id, r.refers_to) for r in warc.read_archives(spark, path).collect() if r.record_type == "revisit")
    assert revisits == [(4, 3), (5, 3), (5, 3), (6, 5)]


def test_records_of_other_writers(spark, tmp_path):
    def record(page, body, more=""):
        digest = base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        head = f"WARC/1.1\r\nWARC-Record-ID: <urn:page:{page}>\r\nContent-Length: {len(body.encode())}\r\nWARC-Type: response\r\n"
        return f"{head}WARC-Target-URI: u\r\nWARC-Payload-Digest: sha1:{digest}\r\n{more}\r\n{body}\r\n\r\n".encode()

    members = [record(1, "é\r\n\r\nWARC/1.1\r\nWARC/1.1\r\n"), record(2, ""), record(3, "x" * 70_000, "X-Other: y\r\n")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, members)))
    got = {r.page_id: r.payload for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {1: "é\r\n\r\nWARC/1.1\r\nWARC/1.1\r\n", 2: "", 3: "x" * 70_000}
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(members[2][:500]))
    with pytest.raises(Exception, match="ends before its length"):
        warc.read_archives(spark, str(tmp_path / "b.warc.gz")).collect()


# 10: personal data


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    parts = ["1", "25", "300", "4539578763621486", "@", ".", "a", "-", " ", "+", "(", "é", "\n", "..", "@b.c", "0", "%"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert privacy.base_spans(text) == plain.base_spans(text)
    assert privacy.base_spans("a" * 300_000 + "@" * 1000 + "1" * 100_000) == []


def test_personal_data_in_all_texts(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op10_information_privacy"](spark, SF).collect()}
    for i, text in texts:
        spans = plain.base_spans(text or "")
        assert got[i].base_sha256 == plain.digest(plain.spans_text(spans))
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == j for _, k, _ in spans) for j in range(4)]


def test_telling_terms_are_found_and_common_ones_left(spark):
    rows = [(k, f"word{chr(97 + k)} today Zyxwv writes jo@ex.example from place{chr(97 + k)} again") for k in range(6)]
    rows += [(100 + k, f"today something else {chr(97 + k % 26)} again writes from here") for k in range(2000)]
    rows += [(5000 + k, "a copy of pqrst with mo@ex.example inside") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in privacy.find(df).collect()}
    assert [rows[0][1][s.start : s.end] for s in found[0].terms] == ["Zyxwv"]
    assert not found[100].terms and not found[5000].terms  # copies are one surrounding
    clean = {r.doc_id: r.text for r in privacy.sanitize(df).collect()}
    assert clean[0] == "worda today [TERM] writes [EMAIL] from placea again" and clean[100] == rows[6][1]


def test_copies_do_not_hide_telling_terms(spark):
    rows = [(10 * k + c, f"word{chr(97 + k)} Zyxwv writes jo@ex.example from place{chr(97 + k)}") for k in range(6) for c in range(3)]
    rows += [(1000 + k, rows[0][1]) for k in range(1000)]
    rows += [(5000 + k, f"something else {chr(97 + k % 26)}{chr(97 + k // 26)}x writes from here") for k in range(200)]
    found = {r.doc_id: r for r in privacy.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert [text[s.start : s.end] for s in found[i].terms] == (["Zyxwv"] if i < 5000 else [])


def test_telling_terms_are_marked_wherever_they_occur(spark):
    far = " ".join(f"filler{chr(97 + k)}" for k in range(20))
    rows = [(k, f"Zyxwv wrote {far} from {chr(97 + k) * 5} to jo@ex.example. Again ZYXWV, zyxwv@home.example, zyxwvs.") for k in range(4)]
    rows += [(10, "A page about Zyxwv alone"), (11, None), (12, "wrote filler from here to there again home")]
    rows += [(100 + k, f"wrote {far} from the {chr(97 + k % 26)}{chr(97 + k // 26)}x to there again") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in privacy.find(df).collect()}
    marked = {i: [text[s.start : s.end] for s in found[i].terms] for i, text in rows if text}
    assert all({"Zyxwv", "ZYXWV"} <= set(marked[k]) <= {"Zyxwv", "ZYXWV", "zyxwvs"} for k in range(4)) and marked[10] == ["Zyxwv"]
    assert not any(t for i, t in marked.items() if i > 10)
    clean = {r.doc_id: r.text for r in privacy.sanitize(df).collect()}
    assert clean[10] == "A page about [TERM] alone" and clean[0].startswith("[TERM] wrote fillera") and clean[11] is None
    assert clean[0].count("[EMAIL]") == 2 and not any("zyxwv " in (t or "").lower() for t in clean.values())


def test_surprise_bounds_the_tail_of_all_draws(spark):
    cases = [(n_te, n_t, n_e, total) for total, n_e, n_t in ((33, 6, 6), (40, 11, 7), (20, 19, 3), (60, 2, 2)) for n_te in range(max(0, n_t - total + n_e), min(n_t, n_e) + 1)]
    for total in (33, 40, 20, 60):
        own = [c for c in cases if c[3] == total]
        df = spark.createDataFrame(own, "n_te long, n_t long, n_e long, total long")
        counts = [F.col(c) for c in ("n_te", "n_t", "n_e")]
        for r in df.withColumn("s", privacy.surprise(*counts, total)).collect():
            tail = sum(math.comb(r.n_e, k) * math.comb(total - r.n_e, r.n_t - k) for k in range(r.n_te, min(r.n_t, r.n_e) + 1)) / math.comb(total, r.n_t)
            assert tail <= math.exp(-r.s) + 1e-12
            assert (r.s > 0) == (r.n_te * total > r.n_t * r.n_e)
    assert privacy.least_count(1000, math.log(1e-5)) == 2 and privacy.least_count(10, math.log(1e-5)) == 10


def plain_telling(texts):
    """Terms over both thresholds, from dictionaries: (entity, term) pairs."""
    letters = lambda t: {w.lower() for w in re.findall(r"[^\W\d_]+", t)}
    held, owners, has = {}, {}, {}
    for k, text in enumerate(sorted(set(texts))):
        mails = re.findall(r"[a-z.]+@[a-z.]+[a-z]", text)
        ips = re.findall(r"\d+\.\d+\.\d+\.\d+", text)
        own = {f"email:{m}" for m in mails} | {f"domain:{m.split('@')[1]}" for m in mails}
        own |= {f"ip:{i}" for i in ips} | {f"network:{'.'.join(i.split('.')[:2])}" for i in ips}
        for x in own:
            owners.setdefault(x, set()).add(k)
        for x in [*mails, *ips]:
            text = text.replace(x, " 0 ")
        for w in letters(text):
            has.setdefault(w, set()).add(k)
        if own:
            held[k] = len(own) * len(letters(text))
    total, limit = len(set(texts)), math.log(privacy.LEVEL / max(1, sum(held.values())))
    out = set()
    for e, mine in owners.items():
        for t, places in has.items():
            p, q = len(mine & places) / len(places), len(mine) / total
            if p < privacy.CERTAINTY or p <= q or q == 1:
                continue
            kl = p * math.log(p / q) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0)
            if len(places) * kl >= -limit:
                out.add((e, t))
    return out


def test_telling_pairs_equal_a_plain_count(spark):
    rng = random.Random(4)
    names = ["Li", "Wu", "Ångström", "Zyxwv", "x" * 60, "Quorra"]
    mails = ["li@acme.example", "wu@acme.example", "ann@other.example"]
    texts = []
    for k in range(500):
        own = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(12)] + ["the", "and"]
        if k < 40:
            own += [rng.choice(names[:2]), rng.choice(mails[:2])]
        elif k < 60:
            own += [names[2], f"10.7.{k}.{k}"] + ([names[4]] if k % 2 else [])
        elif k < 70:
            own += [mails[2], names[3] if k % 2 else names[5]]
        elif k < 75:
            own += [names[3]]
        rng.shuffle(own)
        texts.append(" ".join(own))
    texts += texts[:30] * 3 + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, _ = privacy.telling_terms(df, privacy.scan(df))
    got = {(r.entity, r.term): r.bits for r in found.collect()}
    want = plain_telling([t or "" for t in texts if t is not None] + ["\0"])  # a null text counts as one
    assert set(got) == want and {("domain:acme.example", "li"), ("network:10.7", "ångström"), ("network:10.7", "x" * 60)} <= want
    assert all(b > 1 for b in got.values())


def test_odd_personal_data(spark, odd):
    rows = privacy.summary(privacy.find(odd)).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert (got[12].n_email, got[12].n_ip, got[12].n_phone) == (1, 1, 1) and got[1].spans == ""
    assert privacy.find(odd.where("false")).collect() == []
    clean = privacy.sanitize(odd)
    assert clean.columns == odd.columns and clean.count() == len(ODD)
    assert not any(plain.base_spans(r.text or "") for r in clean.collect())


# pipeline


def test_pipeline_decides_like_the_plain_versions(spark, docs):
    rows = {r.doc_id: r for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language_id"](spark, docs, SF)
    kept = {r.doc_id for r in known.collect()}
    assert kept == {i for i, r in rows.items() if any(map(str.isalpha, r.text or ""))}
    single = stage["near_duplicates"](spark, known, SF)
    ids = {r.doc_id for r in single.collect()}
    want = plain.jaccard([(i, rows[i].text) for i in kept])
    assert ids == {i for i, (_, c) in want.items() if c == i} and single.columns == docs.columns
    clean = stage["decontamination"](spark, single, SF)
    assert clean.columns == docs.columns and 0 < clean.count() < single.count()
    assert not any(r.contaminated for r in decontaminate.contaminated_words(clean, common.table(spark, SF, "benchmark")).collect())
    private = stage["personal_data"](spark, clean, SF)
    final = private.collect()
    assert private.columns == docs.columns and not any(plain.base_spans(r.text) for r in final)
    packed = corpus_pipeline.run(spark, SF)
    assert packed_right(packed.collect(), [(r.doc_id, r.text) for r in final], packing.Limits()) > 0.9


def test_pipeline_stages_take_odd_rows(spark, odd):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() <= len(ODD)
        assert stage(spark, odd.where("false"), SF).collect() == []
    near = corpus_pipeline.drop_near_duplicates(spark, odd, SF).collect()
    assert sum(r.doc_id == 6 for r in near) == 1 and sum(r.doc_id is None for r in near) == 2
    assert corpus_pipeline.pack_sequences(spark, odd, SF).count() > 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_hand_small_batches_to_workers(spark, stage):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    session = spark.newSession()
    rows = session.range(40).selectExpr("id doc_id", "repeat('word and ', 25000) text", "'en' lang").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    largest = lambda: max(r.n for r in rows.mapInArrow(sizes, "n long").collect())
    stage(session, rows.where("false"), SF)
    assert largest() < BATCH + 300_000  # all 9 MB in one before
    session.conf.set(limit, "300k")
    stage(session, rows.where("false"), SF)
    assert largest() < 600_000


def test_tallies_are_small_and_exact():
    texts = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([" ".join(f"w{k}" for k in range(3000)), "a b c d e " * 500]), pa.array([5, 6])], names=["d", "t", "c"]
    )
    tallies = [b for b in jaccard._tally(1 << 20)(iter([texts])) if b.column(6).null_count == 0]
    assert sum(b.column(7).nbytes for b in tallies) < 1 << 17  # 8 MB as plain numbers
    parts = pa.Table.from_batches(tallies).select([6, 7])
    twice = next(jaccard._summed(iter(parts.to_batches() * 2)))
    counts = np.zeros(1 << 20, np.int64)
    for part, raw in zip(*[c.to_pylist() for c in twice.columns]):
        counts[part * jaccard._CHUNK : (part + 1) * jaccard._CHUNK] = np.frombuffer(raw, np.int64)
    want = np.bincount(jaccard._top_bits(np.concatenate(list(jaccard.shingle_sets(texts.column(1)))), 1 << 20), minlength=1 << 20)
    assert (counts == 2 * want).all()


def test_merged_words_equal_the_library():
    path = tokens.vocabulary_path("word_bpe_49k.json")
    cache = tokens._Chunks(path)
    rng = random.Random(3)
    words = [w for w in cache.merged.whole if w.isalpha() and w.isascii() and w == w.lower()][::40]
    words += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz\u00e9\u00e8\u00fc\u00f1\u00df", k=rng.randrange(1, 14))) for _ in range(3000)]
    chunks = [w + rng.choice(["", "", ".", ",", "!!", "?"]) for w in words] + ["\u00c9t\u00e9", "I'll", "a\x00b", "\u0130x", "x" * 500]
    text = " ".join(chunks)
    assert tokens.encode([text, None, ""], path, False) == [cache.whole(text), b"", b""]
    cache.merged = None
    assert b"".join(map(cache.__getitem__, chunks)) == cache.whole(text)


def test_texts_of_latin_words_are_merged_in_one_call(monkeypatch):
    path = tokens.vocabulary_path("word_bpe_49k.json")
    cache = tokens._Chunks(path)
    monkeypatch.setattr(tokens, "_worker_cache", lambda _: cache)
    calls = []
    merge = type(cache.merged.ranked).encode_ordinary
    monkeypatch.setattr(type(cache.merged.ranked), "encode_ordinary", lambda self, text: calls.append(text) or merge(self, text))
    rng = random.Random(4)
    parts = ["the", "Wonder", "zxqvb", "\u00c9t\u00e9", "stra\u00dfe", "A", "."]
    chunk = lambda: "".join(rng.choices(parts[:6], k=rng.randrange(1, 3))) + rng.choice(["", "", ".", "!?", ","])
    odd = ["a.b", ".x", "1,2", "", "'s", "\t", "a\x00b", "<|endoftext|>", "x-y."]
    texts = [rng.choice([" ", "\n", "  "]).join(rng.choice(odd) if rng.random() < 0.1 else chunk() for _ in range(rng.randrange(9))) for _ in range(2000)]
    texts += ["\u4e2d the", "e\u0301", "\u0130x", "\xb5 m", "\u023a", "", None, " ", "."]
    want = [x[:-1].tobytes() for x in plain.token_ids(texts, path, 0)]
    assert tokens.encode(texts, path, False) == want
    assert len(calls) < 20  # one per new word before
    cache.unlike[[cache.merged.ranked.encode_single_token(b"the\x00")]] = True  # as if the library spelled it otherwise
    assert tokens.encode(texts, path, False) == want
