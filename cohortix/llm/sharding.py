"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_bucket, running_sums, size_buckets, text_of, unit_hash


def interleave(df: DataFrame, n_shards: int, seed: int = 42, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Deal all rows into ``n_shards`` shards that all have the mixture of the sources.

    Rows are ranked in a seeded order within their source; row r of a source
    with n rows gets the fraction (r - 0.5) / n. The rows sorted by fraction
    are cut into ``n_shards`` runs whose row counts are at most one apart, so
    every shard holds n / ``n_shards`` rows of each source, within two.

    Returns doc_id, source, size (UTF-8 bytes + 8), text_crc32, shard, slot
    (gapless from 0 in each shard), position (in the whole order).

    Null text: no bytes, crc32 of the empty text. Null source: a source of
    its own, after the others. The seeded order takes id and text, so rows
    with null or repeated ids spread like others; equal rows are interchangeable. Empty table: no
    rows. Other columns are not read.

    Scale: both rankings run inside buckets of about sqrt(n) rows, so neither
    a hot source nor the whole table is sorted by one task; only ids, sizes
    and checksums are shuffled, twice.
    """
    n = df.count()
    buckets = size_buckets(n)
    base = df.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.col(source_col).isNull().alias("_none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_src"),
        (F.octet_length(text_of(text_col)) + 8).cast("bigint").alias("size"),
        F.crc32(text_of(text_col)).alias("text_crc32"),
        unit_hash(F.lit(seed), F.col(id_col), F.md5(text_of(text_col))).alias("_h"),
        F.lit(1).alias("_one"),
    ).withColumn("_b", hash_bucket(F.col("_h"), buckets))
    ties = [F.col("_h"), F.col("text_crc32"), F.col("size")]
    ranked = running_sums(base, ["_none", "_src"], "_b", ties, {"_rank": "_one"}, {"_n": "_one"})
    placed = ranked.withColumn(
        "_f", (2 * F.col("_rank") + 1) / (2 * F.col("_n")).cast("double")
    ).withColumn("_g", F.floor(F.col("_f") * F.lit(int(buckets))).cast("bigint"))
    order = [F.col("_f"), F.col("_none"), F.col("_src"), *ties]
    out = running_sums(placed, [], "_g", order, {"position": "_one"})
    out = out.withColumn("shard", F.expr(f"position * {int(n_shards)}L div {max(int(n), 1)}L"))
    start = F.expr(f"(shard * {max(int(n), 1)}L + {int(n_shards) - 1}L) div {int(n_shards)}L")
    return out.select(
        "doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
        (F.col("position") - start).alias("slot"), "position")
