"""One query per operator: applies it to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm.common import scratch, table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.language import learn, predict, remainder

    documents = table(spark, sf_dir, "documents")
    model = learn(documents.where(remainder("doc_id", 4) != 2))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return predict(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.packing import pack
    from ledgerwatch.llm.tokens import vocabulary_path

    return pack(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.jaccard import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents"))


def op5_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.token_files import read_tokens, write_tokens
    from ledgerwatch.llm.tokens import vocabulary_path

    path, size = scratch(spark, "token-files"), 49408
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary_path("word_bpe_49k.json"), size, end=1)
    return read_tokens(spark, path, size)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.decontaminate import contaminated_words

    return contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.language import remainder
    from ledgerwatch.llm.quality import fit, measure, score

    measured = measure(table(spark, sf_dir, "documents"))
    model = fit(measured, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    predicted = (F.col("score") >= 0.3).cast("int")
    return score(measured, model).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.warc import read_archives, write_archives

    path = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_information_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.privacy import find, summary

    return summary(find(table(spark, sf_dir, "documents")))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.fingerprints import compare

    return compare(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.language import remainder
    from ledgerwatch.llm.merkle import verify

    return verify(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerwatch.llm.language import remainder
    from ledgerwatch.llm.trie import prefix_trie

    conv_id = F.col("conv_id").cast("long")
    return prefix_trie(table(spark, sf_dir, "conversations"), conv_id - conv_id % 100, remainder("conv_id", 6), 5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup, op2_language_id, op3_vector_packing, op4_ngram_jaccard_join, op5_rans_token_files,
        op6_benchmark_decontamination, op7_quality_classifier, op8_html_extraction, op9_warc_revisits, op10_information_privacy,
        op11_winnowing, op12_merkle_manifest, op13_prefix_trie,
    )
}
