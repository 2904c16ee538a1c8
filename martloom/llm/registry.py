"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    archives,
    code_search,
    exact_search,
    languages,
    mixing,
    near_dups,
    oracles,
    part_codes,
    pieces,
    quality,
    sanitise,
    shingle_join,
    spellings,
    token_shards,
)
from martloom.llm.common import crc_remainder, table


def op1_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder("doc_id", 5) == 0
    model = languages.learned(docs.where(~held_out))
    return languages.identified(docs, model, F.col("doc_id"), held_out.alias("held_out"))


def op2_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_shards.written(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_shards.document_digests(files)


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.found(table(spark, sf_dir, "documents"))


def op4_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op5_preference_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_remainder("doc_id", 4) == 2
    model = quality.learned(docs, labels.where(~held_out))
    found = quality.scored(docs, model, F.col("doc_id"), held_out.alias("held_out"))
    passed = (F.col("score") >= quality.AT_THRESHOLD).cast("int")
    return found.withColumn("predicted", passed)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op7_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op8_apportioned_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_multi_index_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.read_archives(archives.written(table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_trie_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.spelling_variants(table(spark, sf_dir, "documents"))


def op12_combination_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.joined(table(spark, sf_dir, "documents"))


def op13_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.compressed(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_codes": op1_language_codes,
        "op2_wavelet_shards": op2_wavelet_shards,
        "op3_disclosure": op3_disclosure,
        "op4_minhash_components": op4_minhash_components,
        "op5_preference_ranking": op5_preference_ranking,
        "op6_exact_top_k": op6_exact_top_k,
        "op7_piece_spans": op7_piece_spans,
        "op8_apportioned_mix": op8_apportioned_mix,
        "op9_multi_index_codes": op9_multi_index_codes,
        "op10_warc_zstd": op10_warc_zstd,
        "op11_trie_pairs": op11_trie_pairs,
        "op12_combination_prefixes": op12_combination_prefixes,
        "op13_part_codes": op13_part_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_top_k": oracles.OP6,
        "op8_apportioned_mix": oracles.OP8,
        "op10_warc_zstd": oracles.OP10,
        "op12_combination_prefixes": oracles.OP12,
        "op13_part_codes": oracles.OP13,
    }
