"""Fusing ranked lists, fetching chunks for hits, and reranking them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quire import fixed_values as fixed
from quire.functions import text as tx
from quire.operators import topk

# Hits are joined by broadcast up to this many rows (ids and ranks only).
BROADCAST_HITS = 500_000


def reciprocal_rank_fusion(
    vector_hits: DataFrame,
    bm25_hits: DataFrame,
    k: int = fixed.RRF_K,
    top_k: int = fixed.HYBRID_TOP_K,
    id_col: str = "chunk_id",
) -> DataFrame:
    """Sum of 1/(k + rank) over both lists, best ``top_k`` per query.

    Equal sums go to the better vector rank, then to the smaller id.
    """
    none = F.lit(None).cast("int")
    both = vector_hits.select("query_id", id_col, F.col("rank").alias("v"), none.alias("b")).unionByName(
        bm25_hits.select("query_id", id_col, none.alias("v"), F.col("rank").alias("b"))
    )
    merged = both.groupBy("query_id", id_col).agg(F.max("v").alias("vector_rank"), F.max("b").alias("bm25_rank"))
    share = lambda rank: F.coalesce(F.lit(1.0) / (k + F.col(rank)), F.lit(0.0))
    scored = merged.withColumn("rrf_score", share("vector_rank") + share("bm25_rank"))
    return topk.rank_per_query(
        scored, top_k, [F.desc("rrf_score"), F.asc_nulls_last("vector_rank"), F.asc(id_col)]
    )


def attach_chunks(hits: DataFrame, chunks: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """Add the chunk columns to the hits.

    ``hits`` must be cheap to count (a stored table).  Up to the bound they are
    sent to the chunks, so the corpus is not shuffled; beyond it Spark chooses.
    """
    few = hits.count() <= BROADCAST_HITS
    return chunks.join(F.broadcast(hits) if few else hits, id_col, "inner")


def term_coverage(query: Column, text: Column) -> Column:
    """Share of the distinct query words that occur in the text."""
    asked = F.array_distinct(tx.tokens(query))
    met = F.size(F.array_intersect(asked, tx.tokens(text)))
    return F.when(F.size(asked) > 0, F.round(met / F.size(asked), 6)).otherwise(F.lit(0.0))


PairScorer = Callable[[], Callable[[pd.Series, pd.Series], np.ndarray]]


def rerank(
    candidates: DataFrame,
    top_k: int = fixed.RERANK_TOP_K,
    scorer: PairScorer | None = None,
    id_col: str = "chunk_id",
) -> DataFrame:
    """Score (query, text) pairs and keep the best ``top_k`` per query.

    ``candidates`` has ``query_id, query_text, <id>, text, rank``.  ``scorer``
    is a factory, called once per task, of (queries, texts) -> scores; without
    one the pairs are scored by ``term_coverage``.  Equal scores keep the order
    the candidates came in.
    """
    if scorer is None:
        score = term_coverage(F.col("query_text"), F.col("text"))
    else:

        @F.pandas_udf(T.DoubleType())
        def score_pairs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            predict = scorer()
            for queries, texts in batches:
                yield pd.Series(np.asarray(predict(queries, texts), dtype=float))

        score = score_pairs("query_text", "text")
    scored = candidates.withColumn("rerank_score", score).withColumnRenamed("rank", "candidate_rank")
    return topk.rank_per_query(scored, top_k, [F.desc("rerank_score"), F.asc("candidate_rank"), F.asc(id_col)])
