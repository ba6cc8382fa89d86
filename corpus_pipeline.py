"""A corpus pipeline in five stages: rules, exact copies, near copies, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and all that the stage before kept; what it
returns is written to the shared folder and read again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.llm import exact_dedup, mixing, quality_rules, sentencepiece, simhash
from quire.session import materialize, prepare_session


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a learned one go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of four-word shingles, at 4 or fewer differing bits, the smallest doc_id stays."""
    return simhash.drop_near_copies(docs, words=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns, ``ids``, ``n_tokens`` and whether the ids give the text again."""
    out = sentencepiece.tokenized(docs.select("doc_id", "text", "lang", "source", "n_chars"), sentencepiece.load_pieces())
    return out.select(
        "doc_id", "text", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", token_stage),
]

# Learned rules, 64-bit hashes and a vocabulary: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    prepare_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
