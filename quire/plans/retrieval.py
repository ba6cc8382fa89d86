"""Hybrid search and question answering over a whole table of queries."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from quire import fixed_values as fixed
from quire.operators import answering, bm25, dense, layers, ranking
from quire.operators import merge as mg
from quire.operators.chunking import chunk_documents
from quire.session import materialize, scratch_path
from quire.sources.tables import StoredTable


@dataclass(frozen=True)
class SearchIndex:
    """Chunks with their vectors, and the BM25 index over them."""

    chunks: DataFrame  # chunk_id, text, file_name, category, document_id, embedding
    bm25: bm25.Bm25Index
    cells: DataFrame | None = None  # chunk_id, embedding, cell: a folder per cell
    centres: np.ndarray | None = None


def build_search_index(chunks: DataFrame, encoder=None, n_cells: int | None = None) -> SearchIndex:
    """Embed and store the chunks once, then count terms from the stored table.

    With ``n_cells`` the vectors are also laid out by cell, for searches that
    read some cells only.
    """
    stored = materialize(dense.embed(chunks, "text", encoder), "chunks")
    index = SearchIndex(stored, bm25.build_index(stored))
    if n_cells is None:
        return index
    centres = dense.fit_cells(stored, n_cells)
    celled = dense.assign_cells(stored.select("chunk_id", "embedding"), centres)
    return replace(index, cells=dense.store_cells(celled, scratch_path(stored.sparkSession, "cells")), centres=centres)


def index_silver(silver: DataFrame, encoder=None, n_cells: int | None = None) -> SearchIndex:
    return build_search_index(chunk_documents(layers.retrievable_rows(silver)), encoder, n_cells)


def hybrid_search(
    index: SearchIndex,
    queries: DataFrame,
    top_k: int = fixed.HYBRID_TOP_K,
    pad_to_k: bool = False,
    encoder=None,
    n_probe: int | None = None,
) -> DataFrame:
    """Dense and BM25 lists of ``top_k`` each, fused to ``top_k`` per query.

    ``queries`` has ``query_id`` and ``text``.  With ``n_probe`` the dense list
    comes from the cells next to each query; all cells give the exact list.  The
    result is stored, so what follows reads a small table.
    """
    asked = dense.embed(queries.select("query_id", "text"), "text", encoder)
    if n_probe is None:
        vector_hits = dense.dense_topk(index.chunks, asked, top_k)
    elif index.cells is None:
        raise ValueError("the index has no cells: build it with n_cells")
    else:
        vector_hits = dense.approx_dense_topk(index.cells, asked, index.centres, n_probe, top_k)
    bm25_hits = bm25.bm25_topk(index.bm25, queries, top_k, pad_to_k)
    return materialize(ranking.reciprocal_rank_fusion(vector_hits, bm25_hits, top_k=top_k), "hits")


def search_and_rerank(
    index: SearchIndex,
    queries: DataFrame,
    hits: DataFrame,
    top_k: int = fixed.RERANK_TOP_K,
    scorer=None,
) -> DataFrame:
    """The fused hits with their chunks and query texts, reranked."""
    asked = queries.select("query_id", F.col("text").alias("query_text"))
    candidates = ranking.attach_chunks(hits, index.chunks.drop("embedding")).join(asked, "query_id")
    return ranking.rerank(candidates, top_k, scorer)


def answer_queries(
    index: SearchIndex,
    queries: DataFrame,
    encoder=None,
    scorer=None,
    generator=None,
    hybrid_top_k: int = fixed.HYBRID_TOP_K,
    rerank_top_k: int = fixed.RERANK_TOP_K,
    pad_to_k: bool = False,
    n_probe: int | None = None,
) -> DataFrame:
    """Answer every query: search, rerank, build context, generate."""
    hits = hybrid_search(index, queries, hybrid_top_k, pad_to_k, encoder, n_probe)
    reranked = search_and_rerank(index, queries, hits, rerank_top_k, scorer)
    contexts = answering.build_context(reranked, ("category", "document_id", "rerank_score"))
    answers = answering.generate_answers(queries, contexts, generator)
    counts = hits.groupBy("query_id").agg(F.count("*").alias("hybrid_candidate_count"))
    return answers.join(counts, "query_id", "left").withColumn(
        "hybrid_candidate_count", F.coalesce("hybrid_candidate_count", F.lit(0))
    )


# --- the stored vector table -------------------------------------------------


def vector_table(spark: SparkSession, path: str, buckets: int = 64) -> StoredTable:
    """Chunk vectors, kept in buckets of the file name they belong to."""
    return StoredTable(spark, path, key="file_name", buckets=buckets)


def upsert_vectors(table: StoredTable, embedded: DataFrame, drop_stale: bool = True, files: DataFrame | None = None) -> dict:
    """Store embedded chunks; running it again changes nothing.

    One row of each ``chunk_id`` is stored.  All chunks of a touched file are
    replaced, so a shortened document leaves none behind.  ``files`` (``file_name``) names
    all files that were embedded: those without chunks, emptied documents, lose theirs.
    ``drop_stale=False`` replaces chunk by chunk and keeps chunks the new version no longer has.
    """
    embedded = embedded.dropDuplicates(["chunk_id"])
    if not table.exists():
        table.rebuild(embedded)
        return {"rows_before": 0, "rows_after": table.count()}
    before = table.count()
    fresh = materialize(embedded, "vectors")
    if not drop_stale:
        stale = mg.insert_only(fresh, table.read(), "chunk_id")
        kept = stale.join(fresh.select("file_name").distinct(), "file_name", "left_semi")
        fresh = materialize(fresh.unionByName(kept.select(fresh.columns)), "vectors")
    table.merge(fresh, update_existing=True)
    if files is not None and drop_stale:
        table.delete_keys(files.select("file_name").join(fresh.select("file_name").distinct(), "file_name", "left_anti"))
    return {"rows_before": before, "rows_after": table.count()}
