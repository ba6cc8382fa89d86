"""One key with most of the rows: results stay whole, the work is split."""

import json
from collections import Counter

from pyspark.sql import functions as F

from quire.operators import bm25, contract as ct, topk
from quire.operators import layers
from quire.session import scratch_path
from quire.sources.tables import StoredTable
from tests.test_contract import BASE

SMALL_PARTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


def with_conf(spark, conf, fn):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_file_path_is_split(spark):
    template = json.dumps(dict(BASE, file_path="PATH", uploaded_by="WHO"))
    path = F.when(F.col("id") % 3 == 0, F.lit("/in/hot")).otherwise(F.concat(F.lit("/in/"), F.col("id").cast("string")))
    events = spark.range(0, 30_000, 1, 8).select(
        F.replace(F.replace(F.lit(template), F.lit("PATH"), path), F.lit("WHO"), F.sha2(F.col("id").cast("string"), 256)).alias("value")
    )
    files = spark.createDataFrame([("/in/hot",)] + [(f"/in/{i}",) for i in range(0, 3000)], "path string")

    def run():
        out = ct.validate(events, ct.DOCUMENT_CONTRACT, files).select("value", "reason_code")
        codes = Counter(r["reason_code"] for r in out.collect())
        return codes, out._jdf.queryExecution().executedPlan().toString()

    codes, plan = with_conf(spark, SMALL_PARTS, run)
    # 10,000 hot events, and 2,000 of the others, name a file that exists.
    assert codes == {None: 12_000, "file_missing": 18_000}
    assert "skew=true" in plan


def test_a_hot_key_does_not_make_one_huge_file(spark):
    table = StoredTable(spark, scratch_path(spark, "hot"), key="k", buckets=4)
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.uuid().alias("v")
    )
    with_conf(spark, SMALL_PARTS, lambda: table.rebuild(rows))
    assert table.count() == 60_000
    hot = table.read().filter("k = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 1


def test_a_word_in_every_document(spark):
    texts = spark.range(0, 5_000, 1, 8).select(
        F.format_string("c%05d", "id").alias("chunk_id"), F.concat(F.lit("the the w"), F.col("id").cast("string")).alias("text")
    )
    index = bm25.build_index(texts)
    weights = {r["term"]: r["df"] for r in index.dictionary().filter("term = 'the'").collect()}
    assert weights == {"the": 5_000}
    queries = spark.createDataFrame([(1, "the w42"), (2, "the")], "query_id long, text string")
    hits = sorted((r["query_id"], r["rank"], r["chunk_id"]) for r in bm25.bm25_topk(index, queries, 3).collect())
    assert hits == [
        (1, 1, "c00042"), (1, 2, "c00000"), (1, 3, "c00001"), (2, 1, "c00000"), (2, 2, "c00001"), (2, 3, "c00002"),
    ]


def test_a_category_with_nearly_all_rows(spark):
    df = spark.range(0, 50_000, 1, 8).select(
        F.when(F.col("id") < 49_990, "big").otherwise("small").alias("g"),
        (F.col("id") % 10).alias("m"), (F.col("id") % 7).alias("a"), F.col("id").alias("t"),
    )
    out = layers.rollup(df, "g", "m", "a", "t", ("n", "total", "mean", "actors", "last"))
    assert {tuple(r) for r in out.collect()} == {("big", 49_990, 224_955, 4.5, 7, 49_989), ("small", 10, 45, 4.5, 7, 49_999)}


def test_rows_are_dealt_to_as_many_tasks_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS_PER_TASK", 100)
    rows = spark.range(0, 5_000, 1, 2).select((F.col("id") % 700).alias("g"), "id")
    dealt = topk.dealt(rows, "g")
    assert dealt.rdd.getNumPartitions() == 50 and dealt.count() == 5_000
    counted = dealt.groupBy("g", "id").agg(F.count("*").alias("n"))
    plan = topk.rank_per_query(counted, 2, [F.asc("id")], "g")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
