import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from quire.operators import layers, merge as mg
from quire.operators.schema_guard import SchemaViolation, column_problems, enforce_schema, null_violations
from quire.session import scratch_path
from quire.sources.tables import BUCKET, PRINT, StoredTable, file_sizes, files_after_packing, path_exists

SCHEMA = T.StructType(
    [T.StructField("k", T.StringType(), False), T.StructField("v", T.IntegerType()), T.StructField("t", T.StringType())]
)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, None) for k, v in rows], T.StructType([T.StructField(f.name, f.dataType) for f in SCHEMA]))


def content(table):
    return sorted((r["k"], r["v"]) for r in table.read().collect())


@pytest.fixture(params=["bucketed", "plain"])
def table(request, spark):
    path = scratch_path(spark, "table")
    if request.param == "bucketed":
        return StoredTable(spark, path, SCHEMA, key="k", buckets=4)
    return PlainTable(spark, path, SCHEMA, key="k")


class PlainTable(StoredTable):
    """A keyed table kept without buckets: merges rewrite it whole."""

    @property
    def _bucketed(self):
        return False

    def _stored(self):
        return super()._stored().drop(BUCKET, PRINT)


def test_merge_arithmetic_and_reruns(spark, table):
    first = table.merge(frame(spark, [("a", 1), ("b", 2), ("c", 3)]), update_existing=False)
    assert (first["rows_before"], first["rows_inserted"], first["rows_after"]) == (0, 3, 3)

    again = table.merge(frame(spark, [("a", 9), ("d", 4)]), update_existing=False)
    assert again == {
        "rows_before": 3, "rows_incoming": 2, "rows_inserted": 1, "rows_updated": 0, "rows_unchanged": 0, "rows_after": 4,
    }
    assert content(table) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]

    for inserted, updated in ((1, 1), (0, 0)):  # the second time, both rows are stored already
        out = table.merge(frame(spark, [("a", 9), ("e", 5)]), update_existing=True)
        assert (out["rows_inserted"], out["rows_updated"], out["rows_after"]) == (inserted, updated, 5)
        assert out["rows_unchanged"] == 2 - inserted - updated
        assert content(table) == [("a", 9), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    assert table.merge(frame(spark, []), update_existing=True)["rows_after"] == 5


def test_delete_and_compact(spark, table):
    table.rebuild(frame(spark, [(f"k{i}", i) for i in range(20)]))
    for i in range(20, 26):
        table.append(frame(spark, [(f"k{i}", i), (f"n{i}", None)]))
    before = content_any(table)
    table.compact()
    assert content_any(table) == before
    assert table.delete_where(F.col("v") >= 3) == 23
    assert content_any(table) == sorted([("k0", 0), ("k1", 1), ("k2", 2)] + [(f"n{i}", None) for i in range(20, 26)])
    assert table.delete_where(F.col("v") > 100) == 0
    assert table.delete_where(F.lit(True)) == 9
    assert table.count() == 0


def content_any(table):
    return sorted(((r["k"], r["v"]) for r in table.read().collect()), key=str)


def test_compaction_reduces_files(spark):
    table = StoredTable(spark, scratch_path(spark, "files"), SCHEMA, key="k", buckets=2)
    for i in range(4):
        (table.rebuild if i == 0 else table.append)(frame(spark, [(f"{i}{j}", j) for j in range(20)]))
    files = lambda: len(table.read().inputFiles())
    many = files()
    table.compact()
    assert files() == 2 < many
    assert table.count() == 80


def test_guard_refuses_bad_appends(spark, table):
    table.rebuild(frame(spark, [("a", 1)]))
    with pytest.raises(SchemaViolation, match="undeclared column extra double"):
        table.append(frame(spark, [("b", 2)]).withColumn("extra", F.lit(1.0)))
    with pytest.raises(SchemaViolation, match="missing column t"):
        table.append(frame(spark, [("b", 2)]).drop("t"))
    with pytest.raises(SchemaViolation, match="column v is string"):
        table.append(frame(spark, [("b", 2)]).withColumn("v", F.lit("x")))
    with pytest.raises(PySparkException, match="NULL in not-null column k"):
        table.append(frame(spark, [("b", 2), (None, 3)]))
    assert content(table) == [("a", 1)]


def test_schema_problems_and_null_counts(spark):
    assert column_problems(SCHEMA, SCHEMA) == []
    nulls = null_violations(frame(spark, [("a", 1), (None, 2)]), SCHEMA)
    assert [tuple(r) for r in nulls.collect()] == [("k", 1)]
    assert enforce_schema(frame(spark, [("a", 1)]).select("t", "v", "k"), SCHEMA).columns == ["k", "v", "t"]


def test_missing_table_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        StoredTable(spark, scratch_path(spark, "none")).read()


def uploads(spark):
    rows = [
        ("a.txt", "1", "2024-01-01T00:00:00Z"), ("a.txt", "2", "2024-01-01T02:00:00+03:00"), ("a.txt", "3", "2023-12-31T23:30:00Z"),
        ("b.txt", "4", "2024-01-01T00:00:00Z"), ("b.txt", "5", "2024-01-01T00:00:00Z"), ("c.txt", "6", "x"),
    ]
    return spark.createDataFrame(rows, "file_name string, document_id string, upload_timestamp string")


def test_latest_revision_compares_instants(spark):
    got = {r["file_name"]: r["document_id"] for r in mg.latest_revision(uploads(spark)).collect()}
    assert got == {"a.txt": "1", "b.txt": "5", "c.txt": "6"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = uploads(spark).select("file_name", F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("n"))
    plan = mg.latest_per_key(df, "file_name", [F.desc("n")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")


def test_frames_match_stored_merges(spark):
    target, source = frame(spark, [("a", 1), ("b", 2)]), frame(spark, [("b", 9), ("c", 3)])
    assert sorted((r[0], r[1]) for r in mg.merge_insert_only(target, source, "k").collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted((r[0], r[1]) for r in mg.merge_upsert(target, source, "k").collect()) == [("a", 1), ("b", 9), ("c", 3)]
    assert tuple(mg.merge_metrics(target, source, "k", True).first()) == (2, 2, 1, 1, 3)
    assert tuple(mg.merge_metrics(target, source, "k", False).first()) == (2, 2, 1, 0, 3)
    empty = frame(spark, [])
    assert tuple(mg.merge_metrics(empty, empty, "k", True).first()) == (0, 0, 0, 0, 0)


def test_silver_and_gold_schemas(spark, sf):
    from quire.plans import registered

    silver = registered._silver(spark, sf)
    assert column_problems(silver.schema, layers.SILVER_SCHEMA) == []
    assert layers.to_gold(silver).columns == [
        "category", "document_count", "total_word_count", "avg_word_count", "distinct_uploaders", "last_updated_at",
    ]
    assert not path_exists(spark, scratch_path(spark, "never"))


def test_failed_rebuild_leaves_the_table(spark):
    for key in (None, "k"):
        table = StoredTable(spark, scratch_path(spark, "table"), key=key)
        table.rebuild(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
        broken = spark.range(3).select(F.lit("c").alias("k"), F.expr("if(id = 2, raise_error('no'), 1)").cast("int").alias("v"))
        with pytest.raises(Exception, match="no"):
            table.rebuild(broken)
        assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 2)]


def written(table):
    return {f: os.path.getmtime(f.removeprefix("file:")) for f in file_sizes(table.spark, table._folder)}


def test_unchanged_rows_are_not_written_again(spark):
    table = StoredTable(spark, scratch_path(spark, "table"), SCHEMA, key="k", buckets=8)
    rows = [(f"k{i}", i) for i in range(200)]
    table.rebuild(frame(spark, rows))
    before = written(table)
    out = table.merge(frame(spark, [(k, v + 1000 if k in ("k3", "k7") else v) for k, v in rows] + [("new", 1)]), update_existing=True)
    assert (out["rows_inserted"], out["rows_updated"], out["rows_unchanged"], out["rows_after"]) == (1, 2, 198, 201)
    after = written(table)
    kept = [f for f, t in before.items() if after.get(f) == t]
    assert len(before) - 3 <= len(kept) < len(before)  # three keys lie in three buckets at most
    assert content(table) == sorted([(k, v + 1000 if k in ("k3", "k7") else v) for k, v in rows] + [("new", 1)])
    # NULLs tell rows apart as well.
    assert table.merge(frame(spark, [("k5", None)]), update_existing=True)["rows_updated"] == 1
    assert table.merge(frame(spark, [("k5", None)]), update_existing=True)["rows_unchanged"] == 1


def test_compaction_goes_by_the_sizes_of_files(spark):
    """One bucket ten times the others gets files of the wanted size; a bucket that is fine keeps its files."""
    table = StoredTable(spark, scratch_path(spark, "files"), key="k", buckets=4)
    bucket = F.pmod(F.xxhash64("k"), F.lit(4))
    keys = spark.range(200).select(F.col("id").cast("string").alias("k")).withColumn("b", bucket)
    by = {r["b"]: r["k"] for r in keys.groupBy("b").agg(F.min("k").alias("k")).collect()}
    text = F.sha2(F.col("id").cast("string"), 512)
    rows = lambda b, n: spark.range(0, n, 1, 1).select(F.lit(by[b]).alias("k"), text.alias("t"))
    table.rebuild(rows(0, 20_000))
    for i in range(4):
        table.append(rows(1, 400).withColumn("t", F.concat("t", F.lit(str(i)))))
    table.append(rows(2, 2_000))
    sizes = lambda: {b: sorted(s for f, s in file_sizes(spark, table._folder).items() if f"={b}/" in f) for b in range(3)}
    target, before, n = sizes()[2][0], written(table), table.count()
    table.compact(target)
    after = sizes()
    assert len(after[0]) >= 8 and max(after[0]) < 2 * target and len(after[1]) == 1
    assert [f for f, t in before.items() if written(table).get(f) == t] == [f for f in before if "=2/" in f]
    assert table.count() == n
    again = written(table)
    table.compact(target)
    assert written(table) == again
    assert files_after_packing([5, 5, 4, 3, 3], 10) == 2 and files_after_packing([12, 9, 9], 10) == 3


def test_readers_of_the_version_before_go_on(spark):
    table = StoredTable(spark, scratch_path(spark, "table"), SCHEMA)
    table.rebuild(frame(spark, [("a", 1)]))
    earlier = table.read()
    table.rebuild(frame(spark, [("b", 2)]))
    assert earlier.first()["k"] == "a" and content(table) == [("b", 2)]
    table.rebuild(frame(spark, [("c", 3)]))
    assert content(table) == [("c", 3)] and table._versions() == [2, 3]


@pytest.mark.parametrize("text_of", [0, 5_000])
def test_texts_stay_where_they_are_when_revisions_are_chosen(spark, text_of):
    """Whether few rows lose or most of them do, texts are not below an Exchange."""
    stored = StoredTable(spark, scratch_path(spark, "uploads"))
    number = F.col("id") if text_of == 0 else F.col("id") % 7
    stored.rebuild(
        spark.range(0, 3_000, 1, 4).select(
            F.concat(F.lit("f"), number.cast("string")).alias("file_name"), F.format_string("%05d", "id").alias("document_id"),
            F.lit("2024-01-01T00:00:00Z").alias("upload_timestamp"), F.repeat(F.lit("x"), 50).alias("raw_text"),
        ).union(spark.createDataFrame([("f1", "99999", "2023-01-01T00:00:00Z", "old")], "a string, b string, c string, d string"))
    )
    got = mg.latest_stored_revision(stored.read())
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = [line for line in plan.split("\n") if "Scan parquet" in line and "raw_text" in line]
    exchanges = [line for line in plan.split("\n") if "Exchange" in line]
    assert below and all("Broadcast" in line for line in exchanges)
    expected = {tuple(r) for r in mg.latest_revision(stored.read()).collect()}
    assert {tuple(r) for r in got.collect()} == expected and len(expected) == (3_000 if text_of == 0 else 7)


def test_keys_are_deleted_with_all_their_rows(spark, table):
    table.rebuild(frame(spark, [("a", 1), ("a", 2), ("b", 3), ("c", 4)]))
    keys = spark.createDataFrame([("a",), ("zz",), ("c",)], "k string")
    assert table.delete_keys(keys) == 3 and content(table) == [("b", 3)]
    assert table.delete_keys(keys) == 0
    assert table.delete_keys(spark.createDataFrame([("b",)], "k string")) == 1 and table.count() == 0
