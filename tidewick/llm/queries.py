"""Registered queries of the subpackage: name -> query over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewick.llm import (bpe, classifier, decontamination, licenses, negatives, oracle, packing, phrases, rules, secrets,
                          sharding, simhash, spelling, suffixes)
from tidewick.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text without the 20-word runs that occurred before."""
    return phrases.repeated_phrases(documents(spark, sf_dir), window=20).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that nearly hold items of the benchmark."""
    return decontamination.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        "doc_id", "item_id", "edits", F.round("similarity", 6).alias("similarity"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    return rules.judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "n_words", *rules.COUNTS[1:], "base_failed", "kept")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_copies(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op5_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 of equal row counts."""
    return sharding.shards(documents(spark, sf_dir), count=40).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text without the 400-byte strings that are found more than once."""
    return suffixes.repeated_bytes(documents(spark, sf_dir), depth=400).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    docs = documents(spark, sf_dir)
    model = classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.score(docs.select("doc_id", "text"), model).select(
        "doc_id", classifier.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document.

    Documents have no paths: a document lies in source/lang/<doc_id div 100>, one with licence lines
    speaks for that directory, or for source/lang if its doc_id is divisible by 3.
    """
    docs = documents(spark, sf_dir)
    speaks = F.col("text").rlike(licenses.LINE)
    top = F.concat_ws("/", "source", "lang")
    block = F.concat_ws("/", top, F.expr("doc_id div 100"))
    path = F.concat_ws("/", F.when(speaks & (F.col("doc_id") % 3 == 0), top).otherwise(block),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text", speaks.alias("speaks"))
    return licenses.scan(files, licenses.templates(spark)).select(
        F.col("file").alias("doc_id"), "path", "licence", F.round("cosine", 6).alias("cosine"), "inherited_from", "origin")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.packed_sequences(documents(spark, sf_dir), tokenizer_path())


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digests of the ids of every text, and of the text they decode to."""
    path = tokenizer_path()
    return bpe.decode(bpe.encode(documents(spark, sf_dir), path), path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts with their most frequent near word and the root of their spelling."""
    return spelling.variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives near the positives of every hundredth vector."""
    return negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_substring_dedup, op2_benchmark_decontamination, op3_quality_rules, op4_simhash_near_dedup, op5_feistel_sharding, op6_suffix_array_dedup,
    op7_secret_scan, op8_quality_classifier, op9_license_scan, op10_best_fit_packing, op11_bpe,
    op12_spelling_variants, op13_hard_negatives)}
ORACLE: dict[str, str] = {"op9_license_scan": oracle.license_scan(), "op13_hard_negatives": oracle.HARD_NEGATIVES}
