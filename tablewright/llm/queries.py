"""The registered queries of the text operators: each applies one operator,
with production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import bm25_wand, curve_packing, factor_machine, histogram_shards, katz, lemp_negatives, licence_scan, oracles, partenum_join, pii_disclosure, prefix_trie, quality_rules, secret_scan, token_index
from tablewright.llm.common import table


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = factor_machine.train(docs, table(spark, sf_dir, "labels"))
    return factor_machine.score(docs, machine).select(
        "doc_id", factor_machine.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    return secret_scan.scan(docs, model).select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        F.col("secrets.base").alias("base_sha256"), "secrets.spans")


def op8_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards.shard(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_licence_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.licence_scan(table(spark, sf_dir, "documents"))


QUERIES = {
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op7_secret_scans": op7_secret_scans,
    "op8_histogram_shards": op8_histogram_shards,
    "op9_licence_scans": op9_licence_scans,
}
ORACLE_SQL: dict[str, str] = {"op4_quality_rules": oracles.OP4, "op8_histogram_shards": oracles.OP8}


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_wand.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES |= {"op2_curve_packing": op2_curve_packing, "op5_bm25_decontamination": op5_bm25_decontamination}


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum_join.jaccard_components(table(spark, sf_dir, "documents"), percent=85, n=4).select(
        "doc_id", "n_shingles", "component_id")


QUERIES["op6_jaccard_join"] = op6_jaccard_join


def op1_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard")


QUERIES["op1_token_index"] = op1_token_index


def op10_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


QUERIES["op10_katz_scores"] = op10_katz_scores


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES["op13_hard_negatives"] = op13_hard_negatives
ORACLE_SQL["op13_hard_negatives"] = oracles.OP13


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.scan(table(spark, sf_dir, "documents"))


QUERIES["op12_pii"] = op12_pii


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES["op11_prefix_trie"] = op11_prefix_trie
ORACLE_SQL["op11_prefix_trie"] = oracles.OP11
