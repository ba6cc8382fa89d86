"""Document lakehouse and retrieval operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the query, so the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from quire.operators.answering import build_context, build_messages, generate_answers  # noqa: E402
from quire.operators.bm25 import bm25_topk, build_index, store_postings  # noqa: E402
from quire.operators.chunking import chunk_documents  # noqa: E402
from quire.operators.contract import DOCUMENT_CONTRACT, Contract, Field, route, validate  # noqa: E402
from quire.operators.dense import approx_dense_topk, assign_cells, dense_topk, embed, fit_cells  # noqa: E402
from quire.operators.expectations import SILVER_SUITE, check_expectations  # noqa: E402
from quire.operators.layers import BRONZE_SCHEMA, SILVER_SCHEMA, to_gold, to_silver  # noqa: E402
from quire.operators.lineage import LineageLog, lineage_summary  # noqa: E402
from quire.operators.merge import delete_where, latest_revision, merge_insert_only, merge_upsert  # noqa: E402
from quire.operators.ranking import reciprocal_rank_fusion, rerank  # noqa: E402
from quire.operators.schema_guard import SchemaViolation, enforce_schema  # noqa: E402
from quire.plans.lakehouse import Lakehouse, PipelineHalted, build_gold, load_bronze, run_pipeline, update_silver  # noqa: E402
from quire.plans.retrieval import SearchIndex, answer_queries, build_search_index, hybrid_search, index_silver  # noqa: E402
from quire.plans.search_store import SearchStore  # noqa: E402
from quire.session import build_session, prepare_session  # noqa: E402
from quire.sources.landing import extract_text, list_files, read_and_extract, upload_events  # noqa: E402
from quire.sources.tables import StoredTable  # noqa: E402
from quire.sources.topics import encode_events, read_manifest, stream_topic_files, stream_topic_kafka  # noqa: E402
from quire.streaming.ingest import accepted_events, rejected_events, run_ingestion, run_summary  # noqa: E402

__all__ = [
    "BRONZE_SCHEMA", "DOCUMENT_CONTRACT", "SILVER_SCHEMA", "SILVER_SUITE",
    "Contract", "Field", "Lakehouse", "LineageLog", "PipelineHalted", "SchemaViolation", "SearchIndex", "SearchStore", "StoredTable",
    "accepted_events", "answer_queries", "approx_dense_topk", "assign_cells", "bm25_topk", "build_context", "build_gold",
    "build_index", "build_messages", "build_search_index", "build_session", "check_expectations", "chunk_documents",
    "delete_where", "dense_topk", "embed", "encode_events", "enforce_schema", "extract_text", "fit_cells",
    "generate_answers", "hybrid_search", "index_silver", "latest_revision", "lineage_summary", "list_files", "load_bronze",
    "merge_insert_only", "merge_upsert", "prepare_session", "read_and_extract", "read_manifest", "reciprocal_rank_fusion",
    "rejected_events", "rerank", "route", "run_ingestion", "run_pipeline", "run_summary", "store_postings",
    "stream_topic_files", "stream_topic_kafka", "to_gold", "to_silver", "update_silver", "upload_events", "validate",
]
