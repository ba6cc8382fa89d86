"""One query for each operator, over its whole table; ``quire.llm.oracles`` has the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.llm import cotraining, exact_dedup, license_notices, line_dedup, log_bilinear, mixing, pair_bitmaps
from quire.llm import phrase_index, quality_rules, ranked_search, sentencepiece, sharding, simhash
from quire.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(prepare_session(spark), folder)

    QUERIES[fn.__name__] = run
    return fn


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def _benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")


@registered
def op1_line_dedup(spark, folder):
    out = line_dedup.line_dedup(_documents(spark, folder), min_chars=40, min_docs=5)
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@registered
def op2_sentencepiece(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "text")
    out = sentencepiece.tokenized(docs, sentencepiece.load_pieces())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        "ids",
    )


@registered
def op3_simhash_golay(spark, folder):
    return simhash.near_dedup(_documents(spark, folder), words=4)


@registered
def op4_exact_dedup_bloom(spark, folder):
    return exact_dedup.exact_dedup(_documents(spark, folder)).drop("may_repeat")


@registered
def op5_mixing_systematic(spark, folder):
    out = mixing.mix_report(_documents(spark, folder))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@registered
def op6_hilbert_shards(spark, folder):
    return sharding.hilbert_shards(_documents(spark, folder), shards=16)


@registered
def op7_log_bilinear(spark, folder):
    return log_bilinear.lm_scores(_documents(spark, folder))


@registered
def op8_cotraining(spark, folder):
    docs = _documents(spark, folder)
    return cotraining.score_quality(docs, cotraining.fit_quality(docs, _labels(spark, folder)))


@registered
def op9_decision_list(spark, folder):
    out = quality_rules.quality_report(_documents(spark, folder), _labels(spark, folder))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@registered
def op10_license_notices(spark, folder):
    out = license_notices.scan_licenses(_documents(spark, folder))
    notices = F.transform("spans", lambda s: s["label"])
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", notices)), ",").alias("labels"),
        "score",
        "spans",
    )


@registered
def op11_phrase_index(spark, folder):
    out = phrase_index.contamination(_documents(spark, folder), _benchmark(spark, folder), size=10, slack=2)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


@registered
def op12_ranked_search(spark, folder):
    return ranked_search.rank_documents(_documents(spark, folder), _benchmark(spark, folder), k=20)


@registered
def op13_pair_bitmaps(spark, folder):
    return pair_bitmaps.align_tokenizers(_documents(spark, folder))
