"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item's windows are sets of positioned tokens that a document must contain whole. For full
containment the necessary prefix of a set is its single rarest token, so:

1. count, over all documents, the tokens that occur in some window;
2. take each window's rarest token as its anchor (windows with a token that no document has
   cannot occur and go);
3. join document tokens with anchors; a window whose place would reach outside the document is
   dropped by its offset and length;
4. group what is left by document and compare the whole window with the document's words there.

Token rows are joined with the windows' vocabulary and anchors, which are written first: Spark
broadcasts them if their size on disk is under ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles otherwise. Counts combine in the map tasks, so a token that fills a third of all text
costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import staged

WINDOW = 10
_APART = [chr(c) for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90)]
_FROM = "".join(chr(c) for c in range(65, 91)) + "".join(c for c in _APART if c != "\0")
_TO = "".join(chr(c) for c in range(97, 123)) + " " * (len(_APART) - 1)


def words(text: Column) -> Column:
    """Words of a text: A-Z lowered, cut at every other ASCII character that is no digit or letter."""
    plain = F.translate(F.replace(F.coalesce(text, F.lit("")), F.lit("\0"), F.lit(" ")), _FROM, _TO)
    return F.array_remove(F.split(plain, " "), "")


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, window: runs of ``size`` words; a shorter item that has words is one window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))
    return items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("window")).distinct()


def contaminated_words(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words, and neither have items with null texts. Rows that share a doc_id,
    or have none, are judged each on its own text. Items without an id count no item but their
    windows hit. Empty tables give no rows, or rows without hits.
    """
    return judge(documents, benchmark, size).drop("copy")


def judge(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """As ``contaminated_words``, with ``copy``, a hash of the text."""
    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    named = staged(
        item_windows(benchmark, size).select("item_id", "window", F.xxhash64("window").alias("wid")), "windows"
    )
    windows = named.select("wid", "window").distinct()
    vocabulary = staged(windows.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    # counted in the map tasks before words meet, so that a common word is a row per task
    counts = documents.select(F.explode(words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counts = counts.join(vocabulary, "word", "left_semi")
    places = windows.select("wid", "window", F.posexplode("window").alias("at", "word"))
    anchors = staged(
        places.join(counts, "word", "left")
        .groupBy("wid", "window")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("rarest"))
        .where("rarest.n > 0")
        .select("wid", "window", F.size("window").alias("len"), "rarest.word", "rarest.at"),
        "anchors",
    )
    token = documents.select("doc_id", "copy", words(F.col("text")).alias("w")).select(
        "doc_id", "copy", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word")
    )
    candidates = staged(
        token.join(anchors, "word")
        .withColumn("start", F.col("pos") - F.col("at"))
        .where("start >= 0 and start + len <= n")
        .groupBy("doc_id", "copy")  # a group is one text, whether or not it has an id of its own
        .agg(F.collect_set(F.struct("start", "wid", "window")).alias("found")),
        "candidates",
    )
    here = documents.alias("d").join(candidates.alias("c"), F.expr("d.doc_id <=> c.doc_id and d.copy = c.copy"), "left")
    here = here.select("d.doc_id", "d.copy", words(F.col("text")).alias("w"), F.coalesce("found", F.expr("cast(array() as array<struct<start:int,wid:bigint,window:array<string>>>)")).alias("found"))
    hits = F.filter("found", lambda c: F.slice("w", c["start"] + 1, F.size(c["window"])) == c["window"])
    here = here.select("doc_id", "copy", F.size("w").cast("long").alias("n_words"), hits.alias("hits"))
    covered = F.flatten(F.transform("hits", lambda c: F.sequence(c["start"], c["start"] + F.size(c["window"]) - 1)))
    judged = staged(
        here.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "copy",
            "n_words",
            F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
            F.array_distinct(F.transform("hits", lambda c: c["wid"])).alias("wids"),
        ),
        "judged",
    )
    items = (
        judged.select("row", F.explode("wids").alias("wid"))
        .join(named.select("wid", F.col("item_id").cast("string").alias("item")).distinct(), "wid")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    none = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return judged.join(items, "row", "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(none).cast("long").alias("n_items"),
        F.sha2(F.array_join(none, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "copy",
    )
