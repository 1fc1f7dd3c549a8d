"""Registered queries of the operators: each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (decontam, fingerprint, huffman, licenses, lines, lm, merkle, neardup, packing, pii,
                        quality, repair, warc)
from strata.session import scratch_path


def tokenizer_path() -> str:
    """The vocabulary file that the contracts name."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as Huffman-coded files and read back."""
    folder = scratch_path(spark, "huffman")
    manifest = huffman.write(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return huffman.read(spark, folder, manifest)


def op2_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram log probabilities of every document from the n-gram trie."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and signature rules in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_pii_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans in every document."""
    return pii.find(table(spark, sf_dir, "documents"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back through the index."""
    return warc.archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows that occur in the documents."""
    return decontam.digest(decontam.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document with its source's posteriors."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of every document and its edited text."""
    return fingerprint.edited_report(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share, dropped from all but one."""
    return lines.digests(lines.dedup_lines(table(spark, sf_dir, "documents"), scratch_path(spark, "lines")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, audited and repaired with the least edits."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of every document, checked after tampering."""
    return merkle.verified(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_huffman, op2_ngram_trie, op3_license_scan, op4_pii_segments, op5_warc_index, op6_ffd_packing,
    op7_chosen_path, op8_decontamination, op9_quality_bayes, op10_order_minhash, op11_line_dedup, op12_conversation_repair,
    op13_merkle_manifest)}
