"""The opN queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, html_extract, jaccard_join, langid, mixing, piece_bpe, quality, sharding, spotsigs, substring,
               token_align, token_counts, vector_codes)
from .common import table

N_SHARDS = 24
TOKEN_LIMIT = 512


def vocabulary() -> str:
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def pieces() -> str:
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op3_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = sharding.interleave(table(spark, sf_dir, "documents"), N_SHARDS)
    return x.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return x.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept")


def op5_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "size", "source_size", "target", "taken")


def op7_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary())
    return x.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    x = langid.predict_languages(table(spark, sf_dir, "documents"), ~held_out)
    return x.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = spotsigs.fingerprints(table(spark, sf_dir, "documents"))
    return x.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        spotsigs.fingerprint("sigs").alias("fingerprint"),
        spotsigs.fingerprint("edited_sigs").alias("edited_fingerprint"),
        spotsigs.likeness("sigs", "edited_sigs").alias("near_edited"),
        spotsigs.likeness("sigs", "next_sigs").alias("near_next"))


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_documents(table(spark, sf_dir, "documents"), vocabulary(), pieces())


def op12_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), pieces())


def op13_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_chosen_path_join, op2_bpe_round_trip, op3_stratified_sharding, op4_quality_rules, op5_line_blocks,
    op6_sainte_lague_mix, op7_fm_index_dedup, op8_token_counts, op9_cross_parsing, op10_spotsigs,
    op11_pair_bitmaps, op12_merge_rounds, op13_gnat_codes)}
