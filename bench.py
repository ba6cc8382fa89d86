"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma
separated) other queries than the headline ones.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quire.plans.registered import QUERIES  # noqa: E402
from quire.session import build_session  # noqa: E402

HEADLINE = [
    "a1_gold_rollup",
    "a1_rollup_lineitem",
    "a6_term_dictionary",
    "v_contract_outcomes",
    "a3_rejection_breakdown",
    "t3_stream_ingest",
    "m1_merge_insert_only",
    "m2_merge_upsert",
    "m2_stored_merge",
    "w2_latest_per_key",
    "u3_revise_once",
    "o3_topk_per_group",
    "x2_clean_text",
    "x6_word_count",
    "x9_chunks",
    "s10_compaction",
    "s13_extract_text",
    "q_silver_suite",
    "q_lineitem_suite",
    "l2_lineage_summary",
    "d2_dense_topk",
    "d4_bm25_topk",
    "d4_bm25_user_turns",
    "d6_hybrid_search",
    "d10_answers",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "quire-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starting the session and its Python workers is not part of any query.
    spark.range(0, 1000, 1, int(cpus) if cpus.isdigit() else 8).mapInArrow(lambda batches: batches, "id long").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
