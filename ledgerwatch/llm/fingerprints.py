"""Document fingerprints by winnowing, in DataFrame operations only.

A text's words (runs other than white space, A-Z in lower case, cut after ``LONGEST`` code points) are
hashed; hashes of pairs, then of fours, roll up to those of every K words. Of each run of W such
hashes the smallest is kept, of equal ones the rightmost, with its position: two texts that share
W + K - 1 words in a row share a kept hash. Order among hashes is that of their upper 31 bits, which
leaves room for the position in the same long.

Texts move once: each row goes to the part of the id order that holds it, and the first row of a
part goes to the part before it as well, so that every row meets its successor. Parts are found from
keys alone. Rows that are equal and very common are carried as one row with a count.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import staged

K, W, LONGEST = 5, 8, 32
#: Equal rows above one in so many are carried once; at most so many keys are broadcast.
SHARE = 1000
#: Copies of a common row that one row stands for while they are dealt out.
CHUNK = 4096
_KEY = {"known": "boolean", "id": "bigint", "h1": "bigint", "h2": "bigint"}
_ROW = ("doc_id", "text", "fingerprint")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _from(values: Column, first: int) -> Column:
    return F.slice(values, first, F.size(values))


def grams(text: Column) -> Column:
    """Hashes of every K words in order; of all words together if they are fewer; of none, empty."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(low, F.lit(rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}"), F.lit(0))

    def joined(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def rolled(one: Column) -> Column:
        four = _bound(
            F.zip_with(one, _from(one, 2), joined), lambda two: F.zip_with(two, _from(two, 3), joined)
        )
        return F.slice(F.zip_with(four, _from(one, K), joined), 1, F.greatest(F.lit(1), F.size(one) - (K - 1)))

    return _bound(F.transform(words, lambda w: F.xxhash64(w)), rolled)


def _halved(reach: int) -> Callable[[Column], Column]:
    return lambda low: F.zip_with(low, _from(low, 1 + reach), lambda a, b: F.least(a, b))


def winnowed(hashes: Column) -> Column:
    """The kept hashes of a text in order: array of (hash, position)."""

    def kept(h: Column) -> Column:
        low = F.transform(h, lambda x, i: F.shiftleft(F.shiftrightunsigned(x, 33), 32) + (F.lit(4294967295) - i))
        reach = 1
        while reach < W:  # smallest of 1, 2, 4, ... keys from each place on
            low = _bound(low, _halved(reach))
            reach *= 2
        places = F.array_distinct(F.slice(low, 1, F.greatest(F.lit(1), F.size(h) - (W - 1))))

        def row(key: Column) -> Column:
            at = (F.lit(4294967295) - key.bitwiseAND(F.lit(4294967295))).cast("int")
            return F.struct(F.get(h, at).alias("hash"), at.alias("position"))

        return F.transform(places, row)

    return _bound(hashes, kept)


def as_text(fingerprint: Column) -> Column:
    """``hash:position`` by position, comma-joined; hashes in hex."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.hex(x["hash"]), F.lit(":"), x["position"].cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the distinct hashes of two fingerprints; 1 if both are empty."""
    one, two = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    both, either = F.size(F.array_intersect(one, two)), F.size(F.array_union(one, two))
    return F.when(either == 0, 1.0).otherwise(both / either).cast("double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` and ``fingerprint``: array of (hash, position); a null text has none."""
    return docs.withColumn("fingerprint", winnowed(grams(F.coalesce("text", F.lit("")))))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit(""))
    known = docs["doc_id"].isNotNull()
    key = F.struct(
        known.alias("known"), F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"),
    )
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), key.alias("key"))


def _ranges(counts: DataFrame) -> Column | None:
    """First keys of the ranges that hold about as many keys each, as a literal array of arrays."""
    parts = 4 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select("key").repartitionByRange(parts, "key")
    first = dealt.groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).collect()  # a row per range
    first = sorted(tuple(r.key) for r in first)
    if not first:
        return None
    step = max(1, int(len(first) ** 0.5))
    rows = [[dict(zip(_KEY, x, strict=True)) for x in first[i : i + step]] for i in range(0, len(first), step)]
    fields = ", ".join(f"{c}: {t}" for c, t in _KEY.items())
    return F.from_json(F.lit(json.dumps(rows)), f"array<array<struct<{fields}>>>")


def _place(key: Column, ranges: Column) -> Column:
    """(row, column) in ``ranges`` of the last key that is not above this one."""
    row = F.size(F.filter(ranges, lambda r: F.get(r, F.lit(0)) <= key)) - 1
    return _bound(row, lambda r: F.struct(r.alias("row"), (F.size(F.filter(F.get(ranges, r), lambda x: x <= key)) - 1).alias("column")))


def chained(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint of every row; next is the row after it.

    Rows are in order of doc_id, and the first follows the last. Null texts are empty. Rows without a
    doc_id come first; rows that share one are ordered by a hash of their text, and equal rows follow
    each other. A lone row follows itself. An empty table gives no rows; other columns are left out.
    """
    keyed = _keyed(docs)
    counts = staged(keyed.groupBy("key").agg(F.count("*").alias("copies")), "fingerprint-keys")
    limit = (counts.agg(F.sum("copies")).head()[0] or 0) // SHARE
    ranges = _ranges(counts)
    if ranges is None:
        return fingerprints(keyed).select(*_ROW, F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))

    common = F.broadcast(counts.where((F.col("copies") > 1) & (F.col("copies") > limit)))  # fewer than SHARE keys
    marked = keyed.join(common, "key", "left")
    many = marked.where("copies is not null").groupBy("key").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "copies")])
    rows = marked.where("copies is null").drop("copies").unionByName(many.drop("copies"))

    step, last = F.size(F.get(ranges, F.lit(0))), F.size(F.flatten(ranges)) - 1
    dealt = rows.withColumn("at", _place(F.col("key"), ranges)).withColumn("part", F.col("at.row") * step + F.col("at.column"))
    begins = F.col("key") == F.get(F.get(ranges, F.col("at.row")), F.col("at.column"))
    before = F.when(F.col("part") == 0, last).otherwise(F.col("part") - 1)
    own = F.struct(F.lit(False).alias("guest"), F.col("part"))
    guest = F.struct(F.lit(True).alias("guest"), before.alias("part"))
    dealt = dealt.withColumn("to", F.explode(F.when(begins, F.array(own, guest)).otherwise(F.array(own))))
    dealt = fingerprints(dealt.select("key", "doc_id", "text", "to.guest", "to.part").repartition("part"))
    ordered = Window.partitionBy("part").orderBy("guest", "key")
    after = [F.lead(c).over(ordered).alias(f"next_{c}") for c in ("text", "fingerprint")]
    followed = dealt.select("guest", *_ROW, *after).where("not guest").drop("guest")

    # the copies before the last one of a common row are followed by the row itself
    chunks = F.sequence(F.lit(2), F.col("copies"), F.lit(CHUNK))
    chunked = many.withColumn("chunk", F.explode(chunks)).repartition("key", "chunk")
    upto = F.least(F.col("chunk") + (CHUNK - 1), F.col("copies"))
    copies = fingerprints(chunked).withColumn("copy", F.explode(F.sequence("chunk", upto)))
    return followed.unionByName(copies.select(*_ROW, *[F.col(c).alias(f"next_{c}") for c in ("text", "fingerprint")]))


def edited(text: Column, next_text: Column) -> Column:
    """The text with the last half of its code points replaced by the first ones of the next text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(next_text, F.lit(1), half))


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row and of its edited text, and likenesses of neighbours.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; see
    ``chained`` for order, nulls, repeated rows and empty tables.
    """
    rows = chained(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_fingerprint", winnowed(grams(F.col("edited"))))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
