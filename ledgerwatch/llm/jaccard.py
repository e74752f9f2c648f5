"""N-gram Jaccard join: links documents whose word 5-gram sets have a Jaccard index of 0.75 or more.

Documents become sets of 64-bit shingle hashes (NumPy inside Arrow batches). Equal sets fall into
one class first, so exact copies are never compared. Then:

1. *Rarity.* Shingles are counted in a table of ``buckets`` counters, a parameter to raise with the corpus,
   summed over tasks. A prefix filter is right under any order that all documents share; counts put
   shared passages last.
2. *Prefixes.* A set of n shingles emits its n - ceil(0.75 n) + 1 rarest, with size and position.
   Two similar sets share at least one of them.
3. *Candidates.* Postings are sorted by shingle and streamed. A group of at most ``HEADS`` sets gives
   all its pairs that pass the length and positional filters. In a larger one the first ``PIVOTS``,
   which have the commonest shingles, are paired with all others: a row per member, not per pair.
4. *Verification.* A suffix filter first: the hash space is halved again and again, until a part holds about
   ``PART`` shingles of a set, and two sets share at most the smaller count in each part, which excludes
   most pairs before any text is read again, long ones too. Then each distinct pair once, by exact intersection.
5. *The rest of large groups.* Groups whose members are not all connected by then are joined with
   themselves for pairs across components that pass the filters, and those not seen yet are
   verified too. Pairs inside a component can no longer change the result; no other pair is left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import components, mix, released, separators, staged, text_slices, word_hashes

WORDS = 5
HEADS, PIVOTS = 8, 3
BUCKETS = 1 << 20
_CHUNK = 1 << 12
#: Shingles counted at once, and candidate pairs held before they are handed on.
HELD = 1 << 18
_APART = separators((0x20, 0x20), (0x09, 0x0D))
_PLACE = np.random.default_rng(5).integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TALLY = "doc_id long, n int, cls long, other long, copy long, ranges array<int>, part int, counts binary"
#: Shingles per part of the hash space and least number of parts in the suffix filter.
PART, RANGES = 8, 64
_POST = "token long, cls long, span long, typ int"
_FOUND = "token long, a long, b long, span long, typ int"


def _top_bits(hashes: np.ndarray, places: int) -> np.ndarray:
    """Which of ``places`` (a power of two) equal parts of the hash space each hash is in."""
    return (hashes >> np.uint64(64 - places.bit_length() + 1)).astype(np.int64) if places > 1 else np.zeros(len(hashes), np.int64)


def _ranges(shingles: np.ndarray) -> list[int] | None:
    if not len(shingles):
        return None
    places = max(RANGES, 1 << (len(shingles) // PART).bit_length())
    return np.bincount(_top_bits(shingles, places), minlength=places).tolist()


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingles: of five words, or of all words if there are fewer."""
    for _, data, offsets in text_slices(column):
        hashes, at = word_hashes(data, offsets, _APART)
        grams = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
        for j in range(WORDS):
            grams += hashes[j : j + len(grams)] * _PLACE[j]
        grams = mix(grams)
        for low, high in zip(at[:-1], at[1:], strict=True):
            n = int(high - low)
            if n >= WORDS:
                yield np.unique(grams[low : high - WORDS + 1])
            elif n:
                yield mix((hashes[low:high] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)


def _class_of(shingles: np.ndarray, clashing: frozenset = frozenset()) -> tuple[int | None, int | None]:
    """The key of a set, and other 64 bits of it, which are the key where unequal sets clash in the first."""
    if not len(shingles):
        return None, None
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    cls, other = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
    return (other if cls in clashing else cls), other


def _small(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each, compressed: mostly small, a table per task is a fraction of its plain size."""
    kind = np.min_scalar_type(int(counts.max()))
    return bytes([kind.itemsize]) + zlib.compress(counts.astype(kind).tobytes(), 1)


def _plain(raw: memoryview) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[1:]), f"<u{raw[0]}").astype(np.int64)


def _tally(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        names = [c.split()[0] for c in _TALLY.split(", ")]
        for batch in batches:
            sizes, classes, others, ranges, waiting, held = [], [], [], [], [], 0
            for shingles in shingle_sets(batch.column(1)):
                sizes.append(len(shingles))
                cls, other = _class_of(shingles)
                classes.append(cls)
                others.append(other)
                ranges.append(_ranges(shingles))
                waiting.append(_top_bits(shingles, buckets))
                held += len(shingles)
                if held > HELD:
                    counts += np.bincount(np.concatenate(waiting), minlength=buckets)
                    waiting, held = [], 0
            if waiting:
                counts += np.bincount(np.concatenate(waiting), minlength=buckets)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()), pa.array(others, pa.int64()),
                    batch.column(2), pa.array(ranges, pa.list_(pa.int32())), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
        chunk = min(_CHUNK, buckets)
        parts = [k for k in range(buckets // chunk) if counts[k * chunk : (k + 1) * chunk].any()]
        m = len(parts)
        raw = [_small(counts[k * chunk : (k + 1) * chunk]) for k in parts]
        empty = [pa.nulls(m, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(parts, pa.int32()), pa.array(raw, pa.binary())], names=names)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            more = _plain(memoryview(raw.as_buffer()))
            if part in sums:
                sums[part] += more
            else:
                sums[part] = more
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["part", "counts"]
    )


def _rarity(tally: DataFrame, buckets: int) -> np.ndarray:
    """Shingles per bucket over all documents: so many numbers, whatever the corpus size."""
    parts = tally.where("part is not null").select("part", "counts").repartition("part").mapInArrow(released(_summed), "part int, counts binary")
    out, chunk = np.zeros(buckets, np.int64), min(_CHUNK, buckets)
    for part, raw in parts.toLocalIterator():
        out[part * chunk : (part + 1) * chunk] = np.frombuffer(raw, np.int64)
    return out


def _postings(counts, clashing: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        weight = np.log2(order + 1.0)
        done: set[int] = set()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for shingles in shingle_sets(batch.column(0)):
                cls, _ = _class_of(shingles, clashing)
                if cls is None or cls in done:
                    continue
                if len(done) > 200_000:  # forgetting only repeats postings, which the next step skips
                    done.clear()
                done.add(cls)
                n = len(shingles)
                bucket = _top_bits(shingles, len(order))
                p = n - (3 * n + 3) // 4 + 1
                first = np.lexsort((shingles, order[bucket]))[:p]
                out[0].append(shingles[first].view(np.int64))
                out[1].append(np.full(p, cls, np.int64))
                out[2].append((n << 32) + np.arange(p, dtype=np.int64))
                out[3].append(np.full(p, int(weight[bucket].mean() * 1000), np.int32))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["token", "cls", "span", "typ"])

    return run


def _fits(span_a: np.ndarray, span_b: np.ndarray) -> np.ndarray:
    """Length and positional filters."""
    na, nb = span_a >> 32, span_b >> 32
    overlap = 1 + np.minimum(na - (span_a & 0xFFFFFFFF), nb - (span_b & 0xFFFFFFFF)) - 1
    return (4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)) & (7 * overlap >= 3 * (na + nb))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (token null), and the members of large groups (b null), of a sorted stream.

    State between batches: the first ``HEADS`` members of the open group, its size, its last class.
    """
    head = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    size, last, found, held = 0, None, [], 0

    def packed() -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found), axis=0)
        n = len(pairs)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())],
            names=["token", "a", "b", "span", "typ"],
        )

    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        token, cls = cols[0], cols[1]
        if not len(token):
            continue
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        fresh[0] = last != (token[0], cls[0])
        last = (token[-1], cls[-1])
        old = len(head[0])
        cols = [np.concatenate([h, c[fresh]]) for h, c in zip(head, cols, strict=True)]
        token, cls, span, typ = cols
        n = len(token)
        if n == old:
            continue
        first = np.ones(n, bool)
        first[1:] = token[1:] != token[:-1]
        group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank = np.arange(n) - group
        if old:
            rank[old:][token[old:] == token[0]] += size - old
        new = np.arange(n) >= old
        for j in range(HEADS):
            i = np.flatnonzero(new & (rank > j) & ((rank < HEADS) | (j < PIVOTS)))
            a = group[i] + j
            ok = _fits(span[i], span[a])
            i, a = i[ok], a[ok]
            if len(i):
                found.append(np.stack([np.minimum(cls[i], cls[a]), np.maximum(cls[i], cls[a])], 1))
                held += len(i)
        starts = np.flatnonzero(first)
        top = np.append(starts[1:], n) - 1
        large = np.repeat(rank[top] >= HEADS, top - starts + 1)
        before = np.zeros(n, bool)
        before[:old] = size > HEADS  # the heads of a group that was large already are out
        put = np.flatnonzero(large & ~before)
        if len(put):
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[put]), pa.array(cls[put]), pa.nulls(len(put), pa.int64()), pa.array(span[put]), pa.array(typ[put])],
                names=["token", "a", "b", "span", "typ"],
            )
        open_ = starts[-1]
        size = int(rank[-1]) + 1
        head = [c[open_ : open_ + HEADS] for c in cols]
        if held > HELD:
            yield packed()
            found, held = [], 0
    if found:
        yield packed()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each wanted class."""

    def packed(rows) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(x) for _, x in rows])]).astype(np.int32)
        flat = np.concatenate([x for _, x in rows]) if rows else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))],
            names=["cls", "shingles"],
        )

    last = None
    for batch in batches:
        wanted, out, held = batch.column(0).to_pylist(), [], 0
        for cls, shingles in zip(wanted, shingle_sets(batch.column(1)), strict=True):
            if cls != last:  # repeated rows come sorted from the join
                out.append((cls, shingles))
                held += len(shingles)
            last = cls
            if held > 1 << 20:
                yield packed(out)
                out, held = [], 0
        yield packed(out)


def _hopeful(pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """The suffix filter: two sets share at most the smaller count of each part of the hash space.

    Sets of similar size are cut into as many parts, or one into twice as many; then neighbours are added up.
    """
    side = lambda c, to: classes.select(F.col("cls").alias(c), F.col("ranges").alias(to)).hint("merge")
    total = lambda counts: F.aggregate(counts, F.lit(0), lambda s, x: s + x)
    halved = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 1, F.lit(2)), lambda i: F.get(c, i) + F.get(c, i + 1))
    ra, rb = F.col("ra"), F.col("rb")
    ra, rb = F.when(F.size(ra) > F.size(rb), halved(ra)).otherwise(ra), F.when(F.size(rb) > F.size(ra), halved(rb)).otherwise(rb)
    shared = total(F.zip_with(ra, rb, lambda x, y: F.least(x, y)))
    found = pairs.join(side("a", "ra"), "a").join(side("b", "rb"), "b")
    return staged(found.where(7 * shared >= 3 * (total(F.col("ra")) + total(F.col("rb")))).select("a", "b"), name)


def _verified(documents: DataFrame, classes: DataFrame, pairs: DataFrame, name: str, few: bool = False) -> DataFrame:
    """The pairs (a, b) whose sets are similar, decided by the sets of one text per class.

    Texts are shuffled to their classes at every size alike, once for all pairs. ``few``: the classes
    are expected to be few, and Spark may send them to the texts if their size on disk allows.
    """
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    chosen = staged(classes.join(wanted, "cls").select("cls", F.col("node").alias("doc_id"), "copy"), name)
    texts = documents.withColumn("copy", _copy()).join(chosen if few else chosen.hint("merge"), ["doc_id", "copy"]).select("cls", "text")
    sets = staged(texts.mapInArrow(released(_sets), "cls long, shingles array<long>"), name)
    side = lambda c, to: sets.select(F.col("cls").alias(c), F.col("shingles").alias(to)).hint("merge")
    both = pairs.join(side("b", "y"), "b").join(side("a", "x"), "a")
    ok = 7 * F.size(F.array_intersect("x", "y")) >= 3 * (F.size("x") + F.size("y"))
    return staged(both.where(ok).select("a", "b").distinct(), name)


def _copy():
    """Tells texts under one doc_id apart."""
    return F.xxhash64("text")


def jaccard_classes(documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id.

    Texts that are null or without words have no shingles, are linked with nothing and are their own
    component. Rows that share a doc_id are one document with several texts. A row without a
    doc_id links nothing and has a null component. An empty table gives no rows; further columns
    are ignored. Shingle hashes have 64 bits, sets are told apart by 128. ``buckets``, a power of two, is the
    size of the table of rarities.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tally = staged(documents.withColumn("copy", _copy()).mapInArrow(released(_tally(buckets)), _TALLY), "tally")
    members = tally.where("part is null").select("doc_id", "n", "cls", "other", "copy", "ranges")
    clashing = members.where("cls is not null").groupBy("cls").agg(F.min("other").alias("lo"), F.max("other").alias("hi"))
    # unequal sets of one 64-bit key: a handful even among 10**11 texts
    clashing = frozenset(r["cls"] for r in clashing.where("lo != hi").select("cls").collect())
    if clashing:
        members = members.withColumn("cls", F.when(F.col("cls").isin(list(clashing)), F.col("other")).otherwise(F.col("cls")))
    known = members.where("cls is not null and doc_id is not null")
    classes = staged(known.groupBy("cls").agg(F.min(F.struct("doc_id", "copy", "ranges")).alias("first")).select("cls", F.col("first.doc_id").alias("node"), "first.copy", "first.ranges"), "classes")
    rarity = _rarity(tally, buckets)
    counts = documents.sparkSession.sparkContext.broadcast(rarity)
    posts = documents.where("doc_id is not null").select("text").mapInArrow(released(_postings(counts, clashing)), _POST)
    ordered = posts.repartition("token").sortWithinPartitions("token", F.desc("typ"), "cls")
    found = staged(ordered.mapInArrow(released(_pairs), _FOUND), "found")
    pairs = staged(found.where("token is null").select("a", "b").distinct(), "pairs")
    members_of = found.where("token is not null").select("token", F.col("a").alias("cls"), "span")
    links = _verified(documents, classes, _hopeful(pairs, classes, "hopeful"), "links")

    node = lambda c, n: classes.select(F.col("cls").alias(c), F.col("node").alias(n))
    as_nodes = lambda e: e.join(node("a", "u"), "a").join(node("b", "v"), "b").select("u", "v")
    own = known.groupBy("doc_id").agg(F.min("cls").alias("c1"), F.max("cls").alias("c2")).where("c1 != c2")
    shared = known.join(own.select("doc_id"), "doc_id").join(classes.select("cls", "node"), "cls")
    shared = shared.where("doc_id != node").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    edges = staged(as_nodes(links).union(shared).distinct(), "edges")
    comp = staged(components(edges, "stars"), "components")

    label = classes.join(comp, classes["node"] == comp["node"], "left").select(
        "cls", F.coalesce("component", classes["node"]).alias("label")
    )
    big = staged(members_of.join(label, "cls"), "large")
    open_ = big.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("token")
    rest = staged(big.join(open_, "token"), "open")
    if rest.head(1):
        x, y = rest.alias("x"), rest.alias("y")
        n = lambda t: F.shiftright(f"{t}.span", 32)
        left = lambda t: n(t) - F.col(f"{t}.span").bitwiseAND(F.lit(0xFFFFFFFF))
        fit = (4 * F.least(n("x"), n("y")) >= 3 * F.greatest(n("x"), n("y"))) & (7 * F.least(left("x"), left("y")) >= 3 * (n("x") + n("y")))
        cross = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.cls") < F.col("y.cls")) & (F.col("x.label") != F.col("y.label")) & fit)
        cross = cross.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct()
        cross = _hopeful(cross.join(pairs, ["a", "b"], "left_anti"), classes, "cross")
        if cross.head(1):
            more = staged(as_nodes(_verified(documents, classes, cross, "links-rest", few=True)), "more")
            if more.head(1):
                comp = staged(components(edges.union(more), "stars-rest"), "components-rest")

    final = classes.join(comp, classes["node"] == comp["node"], "left").select(
        "cls", F.coalesce("component", classes["node"]).alias("component_id")
    )
    final = staged(final, "labels")
    members = members.withColumn("cls", F.when(F.col("doc_id").isNotNull(), F.col("cls")))
    return members.join(final, "cls", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
