"""The corpus pipeline: language ID, near duplicates, decontamination, personal data, packing.

Every stage but the last returns the columns of the documents it was given. Rows without a doc_id pass
the filters that compare documents and are judged by the others on their own text.

All stages share their executors, whose memory adds up over them: each bounds the session's Arrow batches, which
hold whole texts, by bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import decontaminate, jaccard, language, packing, privacy
from ledgerwatch.llm.common import staged, table
from ledgerwatch.llm.tokens import vocabulary_path
from ledgerwatch.session import small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def _same_columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[rows[f"`{c}`"] for c in docs.columns])


@_in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifies the language of every text and keeps documents written in a learned one.

    A null or letterless text, which has none (``und``), is rejected. So is a text of which no word and no trigram
    is known, or whose words are less like those of every learned language than a limit learned from the labelled
    documents allows, whatever its length. The documents that stay without a label in ``lang`` get the language
    identified there; labels stay. Learns words, n-grams and the limit from all documents that have a label;
    if none has, nothing can be identified and all with letters are kept. An empty table stays empty.
    """
    model = language.learn(docs)
    if not model.langs:
        return docs.where(F.coalesce("text", F.lit("")).rlike(r"\p{L}"))
    like, pred = (name + "_" * max(map(len, docs.columns)) for name in ("_like", "_pred"))  # no columns of ``docs``
    found = staged(language.judged(docs, model, like, pred), "languages")
    written = (F.col(pred) != language.UNKNOWN) & (F.col(like) >= language.least_likeness(found, model, like))
    return _same_columns(found.where(written).withColumn("lang", F.coalesce("lang", pred)), docs)


@_in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates.

    Null texts, and those without words, are near nothing and stay; an empty table stays empty. Of rows that share a doc_id one stays, that with the smallest text hash. Rows without a doc_id stay.
    """
    classes = jaccard.jaccard_classes(docs).where("doc_id = component_id").groupBy("doc_id")
    kept = staged(classes.agg((F.count("*") > 1).alias("_several")), "representatives")
    known = docs.where("doc_id is not null").join(kept, "doc_id")
    alone = _same_columns(known.where("not _several"), docs)
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = known.where("_several").groupBy("doc_id").agg(F.min_by(columns, F.xxhash64("text")).alias("_row"))
    several = first.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
    return alone.union(several).union(docs.where("doc_id is null"))


@_in_small_batches
def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs; each row goes by its own text.

    Null and empty texts hold no window and stay; without benchmark items, or documents, nothing changes.
    """
    judged = decontaminate.judge(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    hit = staged(judged.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).distinct(), "contaminated")
    left = docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_copy"]), "left_anti")
    return _same_columns(left, docs)


@_in_small_batches
def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and disclosing terms in ``text`` by tags; no row goes.

    Null texts stay null, other columns keep their values, an empty table stays empty.
    """
    return privacy.sanitize(docs)


@_in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in training sequences, with their token ids.

    A null or empty text is its end token alone; an empty table gives no pieces.
    """
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", remove_personal_data),
    ("packing", pack_sequences),
]
#: Tokens and a learned language model are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
