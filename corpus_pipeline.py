"""Training-data pipeline over ``documents``: five stages, each a Parquet table for the next.

Quality rules drop what they reject; of near copies one document stays;
words of passages that an earlier document has go; sources are mixed to
target weights; and the texts become token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm import bpe, jaccard_join, mixing, quality, substring
from cohortix.llm.common import stored, table
from cohortix.llm.queries import vocabulary

#: A stage in SQL would need the operators' hashes and the tokenizer: tested against brute force instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language.

    Null, empty and blank texts go (they have no words); a null language is a
    stratum of its own; repeated rows are judged alike; null ids stay. An
    empty table gives no rows, and without labels only the base rules act.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the least id (then the least
    hash of its text).

    Rows equal in id and text are one. Texts without a word are in no class
    and stay, as do rows with a null id unless they are near copies of others,
    which then go first. An empty table gives no rows.
    """
    return jaccard_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows of earlier documents.

    A text that loses words is written with single spaces; one that loses
    all of them goes. The others stay as they are; a null text becomes the empty one.
    Null ids come after all others; rows with equal ids leave each other's
    words. An empty table gives no rows.
    """
    x = substring.remove_repeats(docs, keep=("lang", "source"))
    x = x.where("n_removed = 0 or kept != ''")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return x.select("doc_id", text.alias("text"), "rest.lang", "rest.source").withColumn(
        "n_chars", F.char_length("text").cast("bigint"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them.

    A null source is one of its own; texts without a word are not taken; rows
    equal in id and text share their rounds. An empty table gives no rows.
    """
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every row, and the digests of ids and decoded text.

    A null text is the empty one, with no ids; every row is encoded, repeated
    ones too. An empty table gives no rows.
    """
    return bpe.digests(docs, vocabulary(), keep=["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
